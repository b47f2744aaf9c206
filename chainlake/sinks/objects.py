"""Objects written part by part, and seen only when all parts are there.

Tasks put parts into the store under names of their own attempt and note the tag that the
store gave for each. A task's notes are a file; Spark hands its place to the driver, and the
one file that the driver writes at the end makes all of them count. Until then, and if the
job fails, nothing of it is seen; what lost attempts left is deleted.
"""

from __future__ import annotations

import hashlib
import importlib
import io
import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..files import delete_folder, filesystem, folders_in, read_json, write_whole

NOTES = pa.schema(
    [("object_id", pa.int64()), ("part_no", pa.int64()), ("length", pa.int64()), ("md5", pa.string()), ("file", pa.string())]
)


class FolderStore:
    """Keeps each part as a file; its tag is the MD5 of what was written."""

    def __init__(self, folder: str):
        self.folder = folder
        self.files, self.place = filesystem(folder)
        self.files.create_dir(self.place, recursive=True)

    def put(self, name: str, data: bytes) -> tuple[str, str]:
        """Store a part; returns its tag and its place."""
        with self.files.open_output_stream(f"{self.place}/{name}") as out:
            out.write(data)
        return hashlib.md5(data).hexdigest(), f"{self.folder}/{name}"


@dataclass
class Staged(WriterCommitMessage):
    """Where a task's parts and notes lie, and how many parts there are."""

    folder: str
    parts: int


class PartsWriter(DataSourceArrowWriter):
    """Two-phase commit: parts by tasks, one file by the driver."""

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.store = options.get("store", f"{FolderStore.__module__}:{FolderStore.__name__}")
        self.job = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def open_store(self, folder: str):
        module, name = self.store.split(":")
        return getattr(importlib.import_module(module), name)(folder)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        context = TaskContext.get()
        attempt = f"{context.partitionId()}-{context.taskAttemptId()}" if context else "0"
        folder = f"{self.path}/staged/{self.job}/{attempt}-{uuid.uuid4().hex[:8]}"
        notes: dict[str, list] = {name: [] for name in NOTES.names}
        try:
            store = self.open_store(folder)
            for batch in iterator:
                ids, numbers, data = (batch.column(batch.schema.names.index(n)) for n in ("object_id", "part_no", "data"))
                for object_id, number, part in zip(ids.to_pylist(), numbers.to_pylist(), data):
                    raw = part.as_py() or b""
                    tag, place = store.put(f"{object_id}-{number}", raw)
                    for column, value in zip(notes.values(), (object_id, number, len(raw), tag.strip('"'), place)):
                        column.append(value)
            buffer = io.BytesIO()
            pq.write_table(pa.table(notes, NOTES), buffer)
            write_whole(f"{folder}/notes.parquet", buffer.getvalue())
        except BaseException:
            delete_folder(folder)
            raise
        return Staged(folder, len(notes["part_no"]))

    def commit(self, messages: list[Staged | None]) -> None:
        kept = [m.folder for m in messages if m is not None]
        for name in folders_in(f"{self.path}/staged/{self.job}"):
            if f"{self.path}/staged/{self.job}/{name}" not in kept:
                delete_folder(f"{self.path}/staged/{self.job}/{name}")
        entry = {"job": self.job, "overwrite": self.overwrite, "folders": kept}
        write_whole(f"{self.path}/commits/{self.job}.json", json.dumps(entry).encode())

    def abort(self, messages: list[Staged | None]) -> None:
        delete_folder(f"{self.path}/staged/{self.job}")


class ObjectParts(DataSource):
    """The sink ``chainlake_parts``."""

    @classmethod
    def name(cls) -> str:
        return "chainlake_parts"

    def schema(self) -> str:
        return "object_id long, part_no long, data binary"

    def writer(self, schema, overwrite: bool) -> PartsWriter:
        return PartsWriter(self.options, overwrite)


def parts(df: DataFrame, path: str, mode: str = "append", store: str | None = None) -> None:
    """Write ``object_id, part_no, data`` as the parts of objects under ``path``.

    Objects of the job are seen together or not at all. An object that is written again
    takes the place of the old one; ``overwrite`` takes that of all. ``store`` names a class
    (``module:Class``) in place of :class:`FolderStore`. A part is a row, so it is bounded by
    the part size; the driver gets one name for each task.
    """
    df.sparkSession.dataSource.register(ObjectParts)
    writer = df.select("object_id", F.col("part_no").cast("long").alias("part_no"), "data").write
    options = {"store": store} if store else {}
    writer.format(ObjectParts.name()).mode(mode).options(**options).save(path)


def committed_parts(spark: SparkSession, path: str) -> DataFrame:
    """``object_id, part_no, length, md5, file`` of all objects that are to be seen.

    The tags are those that the store reported; the bytes aren't read.
    """
    commits = read_json(f"{path}/commits")
    last = max((i for i, c in enumerate(commits) if c["overwrite"]), default=0)
    notes = [f"{folder}/notes.parquet" for c in commits[last:] for folder in c["folders"]]
    schema = "object_id long, part_no long, length long, md5 string, file string"
    if not notes:
        return spark.createDataFrame([], schema)
    job = F.regexp_extract("_metadata.file_path", r"/staged/([^/]+)/", 1)
    noted = spark.read.schema(schema).parquet(*notes).select("*", job.alias("_job"))
    newest = noted.groupBy("object_id").agg(F.max("_job").alias("_job"))
    return noted.join(newest, ["object_id", "_job"], "left_semi").drop("_job")


def read_parts(manifest: DataFrame) -> DataFrame:
    """``object_id, part_no, offset, data`` of committed parts, read from the store.

    Each part is read by the task its row is in; one that isn't as long or hasn't the tag
    noted fails the job. ``offset`` is the place of the part in its object if all parts but
    the last have one length.
    """
    full = manifest.groupBy("object_id").agg(F.max("length").alias("_full"))
    placed = manifest.join(full, "object_id").withColumn("offset", F.col("part_no") * F.col("_full"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["object_id", "part_no", "offset", "data"]
        for batch in batches:
            for row in batch.to_pylist():
                files, place = filesystem(row["file"])
                with files.open_input_stream(place) as source:
                    data = source.read()
                if len(data) != row["length"] or hashlib.md5(data).hexdigest() != row["md5"]:
                    raise OSError(f"{row['file']} isn't what was written")
                columns = [[row["object_id"]], [row["part_no"]], [row["offset"]], [data]]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.binary()])], names)

    return placed.mapInArrow(run, "object_id long, part_no long, offset long, data binary")


def drop_uncommitted(path: str, older_than: float = 7 * 86_400) -> int:
    """Delete what jobs left that never ended; returns how many there were.

    A failed job deletes its own parts, but a task that was still running then, or a lost
    driver, may leave some. They are never seen. Jobs that began less than ``older_than``
    seconds ago may still be running and are left alone.
    """
    committed = {c["job"] for c in read_json(f"{path}/commits")}
    before = time.time_ns() - int(older_than * 1e9)
    lost = [j for j in folders_in(f"{path}/staged") if j not in committed and int(j.split("-")[0]) < before]
    for job in lost:
        delete_folder(f"{path}/staged/{job}")
    return len(lost)
