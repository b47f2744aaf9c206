"""Block tables as a batch or as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schemas import block_schema


def read_blocks(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    max_files_per_trigger: int | None = None,
    transaction_fields: Sequence[str] | None = None,
) -> DataFrame:
    """Blocks stored under ``path``, one row per block.

    The schema is given and never inferred. Field pruning does not reach through
    two levels of arrays, so name the ``transaction_fields`` a query needs to
    leave the others on disk. As a stream, progress lives in the query's
    checkpoint and ``max_files_per_trigger`` bounds a micro-batch.
    """
    schema = block_schema(transaction_fields)
    if not stream:
        return spark.read.schema(schema).parquet(path)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)
