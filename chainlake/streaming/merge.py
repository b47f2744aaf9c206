"""Sources of a stream in order of priority, with a time limit for the better one.

A row of the first source is taken at once. One of a lower source is held, in case the
better source still brings its key, until the limit has passed in event time; then it is
taken. A key that was taken from one source is not taken from another again.

What waits and which keys were taken lies in tables beside the query's checkpoint, and each
batch is settled by one shuffle of plain columns: no code runs for single keys.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import seconds_of
from ..operators.common import columns
from ..sinks.files import append_batch

#: Batches after which the keys that are known are written anew, without those forgotten.
COMPACT_EVERY = 100

#: What a row is to the batch that settles it.
CAME, HELD, KNOWN = range(3)

#: Columns beside the rows' own: event time, the end of the wait, until when a key that was
#: taken is known, whether a row is taken, and whether it is the one to name its key as known.
MARKS = T.StructType(
    [
        *(T.StructField(name, T.LongType()) for name in ("ms__", "due__", "until__")),
        *(T.StructField(name, T.BooleanType()) for name in ("taken__", "names__")),
    ]
)


class Ledger:
    """Tables of a merge, one folder per batch, so that a repeated batch replaces its own."""

    def __init__(self, checkpoint: str, key: Sequence[str], fields: Sequence[T.StructField]):
        self.checkpoint = checkpoint
        self.settled = T.StructType([T.StructField("priority", T.IntegerType()), *fields, *MARKS.fields])
        wanted = (*key, "priority", "until__")
        self.known = T.StructType([f for f in self.settled.fields if f.name in wanted])

    def settled_by(self, number: int) -> str:
        return f"{self.checkpoint}/merge/settled/{number}"

    def known_by(self, number: int) -> str:
        return f"{self.checkpoint}/merge/known/{number}"

    def kept_at(self, number: int) -> str:
        return f"{self.checkpoint}/merge/kept/{number}"

    def waiting(self, spark: SparkSession, number: int) -> DataFrame:
        """What waits after a batch."""
        return spark.read.schema(self.settled).parquet(self.settled_by(number)).filter(~F.col("taken__"))

    def known_after(self, spark: SparkSession, number: int, now: int) -> DataFrame:
        """Keys that are known after a batch whose watermark is ``now``, and their source.

        What a batch takes is known to the next one in any case.
        """
        newest = number // COMPACT_EVERY * COMPACT_EVERY - 1  # of the batches before that wrote them anew
        places = [self.known_by(n) for n in range(newest + 1, number)] + [self.kept_at(newest)] * (newest >= 0)
        own = spark.read.schema(self.known).parquet(self.known_by(number))
        if not places:
            return own
        older = spark.read.schema(self.known).parquet(*places)
        return older.filter(F.col("until__").isNull() | (F.col("until__") > now)).unionByName(own)

    def tidy(self, spark: SparkSession, number: int, now: int) -> None:
        """Write the known keys anew now and then, and delete what no later or repeated batch reads."""
        if (number + 1) % COMPACT_EVERY == 0:
            self.known_after(spark, number, now).write.mode("overwrite").parquet(self.kept_at(number))
        unread = [self.settled_by(number - 2)] if number > 1 else []
        if number > COMPACT_EVERY and number % COMPACT_EVERY == 1:
            unread += [self.known_by(n) for n in range(number - 1 - COMPACT_EVERY, number - 1)]
            unread += [self.kept_at(number - 2 - COMPACT_EVERY)]
        for folder in unread:
            place = spark._jvm.org.apache.hadoop.fs.Path(folder)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def watermarks(spark: SparkSession, checkpoint: str, number: int) -> tuple[int, int]:
    """Milliseconds of a batch's watermark and of the one before it, as the checkpoint notes them.

    Rows are late by the one before, as they are for Spark's own operators.
    """
    wanted = [n for n in (number, number - 1) if n >= 0]
    lines = spark.read.text([f"{checkpoint}/offsets/{n}" for n in wanted]).filter(F.col("value").contains('"batchWatermarkMs"'))
    found = {int(n): json.loads(v)["batchWatermarkMs"] for n, v in lines.select("_metadata.file_name", "value").collect()}
    return found[number], found.get(number - 1, 0)


def settle(came: DataFrame, held: DataFrame, known: DataFrame, key: Sequence[str], wait: int, remember: int, now: int) -> DataFrame:
    """Rows that are taken or go on waiting after a batch with the watermark ``now``.

    Of ``held`` come the rows that wait and of ``known`` the keys that were taken. All rows of a
    key are seen together; most keys have one or two.
    """
    every = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [df.withColumn("kind__", F.lit(kind)) for kind, df in ((CAME, came), (HELD, held), (KNOWN, known))],
    )
    of_key = Window.partitionBy(*(F.col(f"`{n}`") for n in key))

    def least(kinds: Sequence[int], value: str):
        return F.min(F.when(F.col("kind__").isin(*kinds), F.col(value))).over(of_key)

    # The best row comes first, and one sort serves both windows.
    placed = every.withColumn("place__", F.row_number().over(of_key.orderBy(F.col("kind__") == KNOWN, "priority")))
    seen = placed.withColumns(
        {
            "known__": least([KNOWN], "priority"),
            "first__": F.coalesce(least([CAME], "priority") == 0, F.lit(False)),
            "best__": least([CAME, HELD], "priority"),
            "due__": F.coalesce(least([HELD], "due__"), F.greatest(least([CAME], "ms__") + wait * 1000, F.lit(now + 1))),
        }
    )
    is_known, over = F.col("known__").isNotNull(), F.col("due__") <= now
    from_ = F.coalesce("known__", F.when(F.col("first__"), 0), "best__")
    chosen = seen.filter((F.col("kind__") != KNOWN) & (F.col("priority") == from_))
    return chosen.withColumns(
        {
            "taken__": is_known | F.col("first__") | over,
            "names__": ~is_known & (F.col("first__") | over) & (F.col("place__") == 1),
            "until__": F.when(~F.col("first__"), F.col("due__") + remember * 1000),
        }
    )


def follow_merged(
    sources: Sequence[DataFrame],
    path: str,
    checkpoint: str,
    key: str | Sequence[str] = "seqno",
    time: str = "ts",
    wait: str | int = "1 minute",
    lateness: str | int = 0,
    remember: str | int = "1 day",
    available_now: bool = True,
) -> StreamingQuery:
    """Append the merged sources (the first has the highest priority) to ``path``.

    Rows are those that :func:`~chainlake.sources.merge_sources` gives for all that came, in
    whatever order it came, as long as a better source brings a key within ``wait`` of the
    worse one's ``time``. Rows of one source that share a key all stay. The watermark is the
    newest ``time`` less ``lateness``. A key from a lower source is remembered for
    ``remember`` after it was taken, one from the first for good. Kept beside the checkpoint are
    the rows of the best source per key that waits, and a number per key that was taken; a batch
    reads both.
    """
    if not sources:
        raise ValueError("at least one source is needed")
    key, wait, remember = columns(key), seconds_of(wait), seconds_of(remember)
    ranked = [df.withColumn("priority", F.lit(i)) for i, df in enumerate(sources)]
    union = reduce(DataFrame.unionByName, ranked)
    late = union.withColumn("at__", F.col(time).cast("timestamp")).withWatermark("at__", f"{seconds_of(lateness) if lateness else 0} seconds")
    rest = [n for n in union.columns if n != "priority"]
    rows = late.select("priority", F.coalesce(F.unix_millis("at__"), F.lit(0)).alias("ms__"), *(f"`{n}`" for n in rest), "at__")
    ledger = Ledger(checkpoint, key, [union.schema[n] for n in rest])
    # An aggregate of no rows: with it Spark runs a batch without rows when the watermark has moved.
    # It reads the sources' times a second time, and nothing else of them.
    none = late.filter(F.col("at__") < F.timestamp_micros(F.lit(-(2**62)))).groupBy("at__").agg(F.count(F.lit(1)).alias("n__"))

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        now, before = watermarks(spark, checkpoint, number)
        came = batch.filter("priority is not null and (at__ is null or unix_micros(at__) > %d)" % (before * 1000)).drop("at__", "n__")
        held = known = came.limit(0).withColumns({n: F.lit(None).cast("long") for n in ("due__", "until__")})
        if number:
            held = ledger.waiting(spark, number - 1)
            known = ledger.known_after(spark, number - 1, before)
        chosen = settle(
            came,
            held.select("priority", *(f"`{n}`" for n in rest), "due__"),
            known.select("priority", *(f"`{n}`" for n in key)),
            key, wait, remember, now,
        )
        chosen.select(*(f"`{n}`" for n in ledger.settled.names)).write.mode("overwrite").parquet(ledger.settled_by(number))
        written = spark.read.schema(ledger.settled).parquet(ledger.settled_by(number))
        append_batch(written.filter("taken__").drop(*MARKS.names), path, number)
        written.filter("names__").select(*(f"`{n}`" for n in ledger.known.names)).write.mode("overwrite").parquet(ledger.known_by(number))
        ledger.tidy(spark, number, now)

    writer = rows.unionByName(none, allowMissingColumns=True).writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_waiting(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows that are still held for a better source."""
    done = spark.read.text(f"{checkpoint}/commits").select(F.max(F.col("_metadata.file_name").cast("long"))).first()[0]
    settled = spark.read.parquet(f"{checkpoint}/merge/settled/{done}")
    return settled.filter(~F.col("taken__")).drop(*MARKS.names)
