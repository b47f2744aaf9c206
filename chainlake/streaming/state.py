"""Latest state per key, kept up to date by a stream of changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.common import columns
from ..operators.state import latest_state
from ..sinks.files import MAX_RECORDS_PER_FILE

#: Batches after which the log is folded into a snapshot.
COMPACT_EVERY = 100


def follow_state(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    key: str | Sequence[str] = "account",
    order: str | Sequence[str] = "seqno",
    available_now: bool = True,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Fold each micro-batch to its latest rows and log them under ``path``.

    The log holds at most one row per key and batch, under the number of the
    batch, so a repeated batch replaces itself. No state is kept between batches;
    :func:`read_state` folds the log. After every ``compact_every`` batches the log
    is folded into a snapshot, and reading takes the newest snapshot and what came
    after it, so that it does not get slower with the age of the log.
    """

    def write(batch: DataFrame, number: int) -> None:
        # The folder that append_batch would write, without a look at each row's partition.
        writer = latest_state(batch, key, order).write.mode("overwrite")
        writer.option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).parquet(f"{path}/log/batch_id={number}")
        if compact_every and (number + 1) % compact_every == 0:
            compact_state(batch.sparkSession, path, number, key, order)

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_state(
    spark: SparkSession,
    path: str,
    key: str | Sequence[str] = "account",
    order: str | Sequence[str] = "seqno",
) -> DataFrame:
    """State at the end of the log written by :func:`follow_state`."""
    log = spark.read.parquet(f"{path}/log")
    newest = _newest_snapshot(spark, path)
    if newest is None:
        return latest_state(log.drop("batch_id"), key, order)
    rest = log.filter(F.col("batch_id") > newest).drop("batch_id")
    snapshot = spark.read.schema(rest.schema).parquet(f"{path}/snapshot-{newest}")
    return latest_state(snapshot.unionByName(rest), key, order)


def compact_state(
    spark: SparkSession,
    path: str,
    number: int,
    key: str | Sequence[str] = "account",
    order: str | Sequence[str] = "seqno",
) -> None:
    """Write the state after batch ``number`` as a snapshot; the log stays."""
    read_state(spark, path, key, order).write.mode("overwrite").parquet(f"{path}/snapshot-{number}")
    done = spark.createDataFrame([(number,)], "number long").coalesce(1)
    done.write.mode("append").parquet(f"{path}/snapshots")


def _newest_snapshot(spark: SparkSession, path: str) -> int | None:
    """Number of the last snapshot that was written to its end."""
    try:
        return spark.read.schema("number long").parquet(f"{path}/snapshots").agg(F.max("number")).first()[0]
    except AnalysisException:
        return None


def follow_state_store(
    changes: DataFrame,
    checkpoint: str,
    key: str | Sequence[str] = "account",
    order: str | Sequence[str] = "seqno",
    available_now: bool = True,
) -> StreamingQuery:
    """Keep the latest row per key in Spark's state store, and nothing else.

    State is bounded by the keys; every task keeps one row per key of a batch before it
    is shuffled. There is no log to fold: :func:`read_state_store` reads the state
    itself, also of a query that has stopped. The checkpoint is the table.
    """
    key, order = columns(key), columns(order)
    others = [name for name in changes.columns if name not in (*key, *order)]
    last = F.max_by(F.struct(*order, *others), F.struct(*order)).alias("last")
    newest = changes.groupBy(*key).agg(last)
    writer = newest.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_state_store(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The latest row per key as of the last batch, or an earlier one that is still kept."""
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    stored = reader.load(checkpoint)
    row = stored.schema["value"].dataType.fields[0].name
    return stored.select("key.*", f"value.`{row}`.*")
