"""Archives laid out as one folder per archive id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..schemas import BLOCK


def read_archives(
    spark: SparkSession,
    path: str,
    ids: Sequence[int] | DataFrame | None = None,
    schema: StructType = BLOCK,
    stream: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Contents of the archives under ``path`` with their ``archive_id``.

    A list of ``ids`` becomes a partition filter, so other archives are not
    listed or opened. A DataFrame with an ``archive_id`` column does the same
    for lists too long for a query, through dynamic partition pruning.
    """
    content = [field for field in schema.fields if field.name != "archive_id"]
    full = StructType([*content, StructField("archive_id", LongType())])
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    archives = reader.schema(full).parquet(path)
    if ids is None:
        return archives
    if isinstance(ids, DataFrame):
        return archives.join(ids.select("archive_id"), "archive_id", "left_semi")
    return archives.filter(F.col("archive_id").isin(*ids))


def read_opaque_archives(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Archive files in a format of their own: ``path, length, content``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    return files.option("recursiveFileLookup", "true").load(path).select(
        "path", "length", "content"
    )
