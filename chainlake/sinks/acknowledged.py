"""Records sent over a transport until each is acknowledged.

The transport is passed in by name, so the client library is the user's choice. Before a job
starts the connection is checked. A task sends its records in bounded batches and sends again,
without end, what was not acknowledged. A block is marked as done by the driver once every
task has all its acknowledgements; a lost task sends again, so records may come twice.
"""

from __future__ import annotations

import importlib
import io
import json
import logging
import time
import uuid
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.streaming import DataStreamWriter

from ..files import delete_folder, filesystem, read_json, write_whole

log = logging.getLogger(__name__)

# Records and bytes of a batch, seconds before sending again and for the check.
BATCH_RECORDS = 25_000
BATCH_BYTES = 25_000 * 1024
RESEND_AFTER = 0.1
CHECK_SECONDS = 10

BLOCK = ("workchain", "shard", "seqno")
RECORD = ("key", "value", "partition", "event_ms")
NOTES = pa.schema([*((name, pa.int64()) for name in BLOCK), ("records", pa.int64())])


class Transport(Protocol):
    """What a client has to offer; it is made once on the driver and once in each task."""

    def __init__(self, options: Mapping[str, str]): ...

    def check(self, seconds: float) -> None:
        """Raise unless the other side answers in time."""

    def send(self, records: Sequence[dict]) -> Sequence[bool]:
        """Send ``key, value, partition, event_ms`` and tell which were acknowledged."""

    def close(self) -> None: ...


class FolderTransport:
    """Keeps records in a folder: a file for each batch, whole or not at all."""

    def __init__(self, options: Mapping[str, str]):
        self.folder = options["topic"]

    def check(self, seconds: float) -> None:
        files, place = filesystem(self.folder)
        files.create_dir(place, recursive=True)

    def send(self, records: Sequence[dict]) -> list[bool]:
        kinds = {"key": pa.binary(), "value": pa.binary(), "partition": pa.int32(), "event_ms": pa.int64()}
        table = pa.table({n: pa.array([r[n] for r in records], k) for n, k in kinds.items()})
        buffer = io.BytesIO()
        pq.write_table(table, buffer)
        write_whole(f"{self.folder}/{uuid.uuid4().hex}.parquet", buffer.getvalue())
        return [True] * len(records)

    def close(self) -> None:
        pass


def transport_of(options: Mapping[str, str]) -> Transport:
    module, name = options["transport"].split(":")
    return getattr(importlib.import_module(module), name)(options)


def batches_of(records: Iterator[tuple[tuple, dict]]) -> Iterator[list[tuple[tuple, dict]]]:
    """Records together as the fixed bounds allow; a larger one is sent alone."""
    some, size = [], 0
    for block, record in records:
        own = len(record["key"] or b"") + len(record["value"] or b"")
        if some and (len(some) == BATCH_RECORDS or size + own > BATCH_BYTES):
            yield some
            some, size = [], 0
        some.append((block, record))
        size += own
    if some:
        yield some


def send_all(transport: Transport, records: list[dict]) -> None:
    """Send until every record is acknowledged; a failing call acknowledges none."""
    left = records
    while left:
        try:
            done = transport.send(left)
        except Exception as error:
            log.warning("%d records to be sent again: %s", len(left), error)
            done = [False] * len(left)
        left = [record for record, ok in zip(left, done, strict=True) if not ok]
        if left:
            time.sleep(RESEND_AFTER)


@dataclass
class Acknowledged(WriterCommitMessage):
    """Where a task noted its blocks."""

    notes: str


class Sender:
    """Sends the rows of a task; shared by the writers for tables and for streams."""

    def __init__(self, options: dict):
        self.options, self.path = dict(options), options["path"].rstrip("/")
        self.job = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        transport = transport_of(self.options)
        try:
            transport.check(CHECK_SECONDS)
        finally:
            transport.close()

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Acknowledged:
        done: Counter = Counter()
        transport = transport_of(self.options)

        def rows() -> Iterator[tuple[tuple, dict]]:
            for batch in iterator:
                for row in batch.to_pylist():
                    yield tuple(row[n] for n in BLOCK), {n: row[n] for n in RECORD}

        try:
            for some in batches_of(rows()):
                send_all(transport, [record for _, record in some])
                done.update(block for block, _ in some)
        finally:
            transport.close()
        columns = list(zip(*(block for block in done))) or [[], [], []]
        table = pa.table({**dict(zip(BLOCK, map(list, columns))), "records": list(done.values())}, NOTES)
        buffer = io.BytesIO()
        pq.write_table(table, buffer)
        context = TaskContext.get()
        notes = f"{self.path}/notes/{self.job}/{context.partitionId() if context else 0}-{uuid.uuid4().hex[:8]}.parquet"
        write_whole(notes, buffer.getvalue())
        return Acknowledged(notes)

    def mark(self, name: str, messages: list[Acknowledged | None]) -> None:
        notes = [m.notes for m in messages if m is not None]
        write_whole(f"{self.path}/done/{name}.json", json.dumps({"notes": notes}).encode())


class TableSender(Sender, DataSourceArrowWriter):
    """For a table: all its blocks are done together."""

    def commit(self, messages: list[Acknowledged | None]) -> None:
        self.mark(self.job, messages)

    def abort(self, messages: list[Acknowledged | None]) -> None:
        delete_folder(f"{self.path}/notes/{self.job}")


class StreamSender(Sender, DataSourceStreamArrowWriter):
    """For a stream: a micro-batch that is repeated marks its blocks again, in the same place."""

    def commit(self, messages: list[Acknowledged | None], batchId: int) -> None:
        self.mark(f"batch-{batchId:020d}", messages)

    def abort(self, messages: list[Acknowledged | None], batchId: int) -> None:
        pass  # what was sent stays sent; the batch comes again


class AcknowledgedRecords(DataSource):
    """The sink ``chainlake_acknowledged``."""

    @classmethod
    def name(cls) -> str:
        return "chainlake_acknowledged"

    def schema(self) -> str:
        return "workchain int, shard long, seqno long, key binary, value binary, partition int, event_ms long"

    def writer(self, schema, overwrite: bool) -> TableSender:
        return TableSender(self.options)

    def streamWriter(self, schema, overwrite: bool) -> StreamSender:
        return StreamSender(self.options)


def acknowledged(
    records: DataFrame, path: str, transport: str, options: Mapping[str, str] | None = None, checkpoint: str | None = None
) -> DataFrameWriter | DataStreamWriter:
    """Writer for sink records that still have the ``workchain, shard, seqno`` of their block.

    Call ``save()`` on a batch, ``start()`` on a stream. ``path`` keeps the marks of blocks that
    are done, ``transport`` names the class (``module:Class``), which gets ``options``. The time
    of a record is a field of its own. The driver gets one name for each task.
    """
    records.sparkSession.dataSource.register(AcknowledgedRecords)
    rows = records.select(*(F.col(n).cast("long").alias(n) for n in BLOCK), *RECORD)
    settings = {**(options or {}), "transport": transport, "path": path}
    if not records.isStreaming:
        return rows.write.format(AcknowledgedRecords.name()).mode("append").options(**settings)
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint folder")
    writer = rows.writeStream.format(AcknowledgedRecords.name()).options(**settings)
    return writer.option("checkpointLocation", checkpoint)


def done_blocks(spark: SparkSession, path: str) -> DataFrame:
    """``workchain, shard, seqno, records`` of the blocks all of whose records were acknowledged."""
    notes = [name for entry in read_json(f"{path}/done") for name in entry["notes"]]
    schema = "workchain long, shard long, seqno long, records long"
    if not notes:
        return spark.createDataFrame([], schema)
    noted = spark.read.schema(schema).parquet(*notes)
    return noted.groupBy(*BLOCK).agg(F.sum("records").alias("records"))
