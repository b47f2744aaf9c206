"""Digests of object parts and their check against a manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.tags import EMPTY_ETAG, etag_matches, quoted_etag
from .common import columns, whole

#: Part digests joined in the first step of the composite tag.
DIGEST_FAN_IN = 1024


def part_md5(parts: DataFrame, key: str | Sequence[str] = "object_id") -> DataFrame:
    """``key, part_no, length, md5`` of each part; no shuffle."""
    return parts.select(
        *columns(key),
        "part_no",
        F.octet_length("data").cast("long").alias("length"),
        F.md5("data").alias("md5"),
    )


def composite_etag(
    digests: DataFrame,
    key: str | Sequence[str] = "object_id",
    objects: DataFrame | None = None,
    fan_in: int = DIGEST_FAN_IN,
    strict: bool = True,
) -> DataFrame:
    """``key, etag, parts, size``: MD5 over the raw part digests in part order.

    Digests are joined in two steps, runs of ``fan_in`` parts first, so the last
    group of an object holds one short text per run. ``objects`` adds the
    objects that have no parts; their tag is the MD5 of nothing. A missing or
    repeated part, and one that is shorter than others without being the last,
    fail the job; without ``strict`` the tag of such an object is null.
    """
    key = columns(key)
    runs = digests.groupBy(*key, whole(F.col("part_no"), F.lit(fan_in)).alias("_run")).agg(
        F.expr("listagg(md5, '') WITHIN GROUP (ORDER BY part_no)").alias("_hex"),
        F.count(F.lit(1)).alias("parts"),
        F.sum("length").alias("size"),
        F.max("part_no").alias("_last"),
        F.max("length").alias("_full"),
        F.max_by("length", "part_no").alias("_rest"),
    )
    etags = (
        runs.groupBy(*key)
        .agg(
            F.expr("md5(unhex(listagg(_hex, '') WITHIN GROUP (ORDER BY _run)))").alias("etag"),
            F.sum("parts").alias("parts"),
            F.sum("size").alias("size"),
            F.max("_last").alias("_last"),
            F.max("_full").alias("_full"),
            F.max_by("_rest", "_last").alias("_rest"),
        )
    )
    complete = (F.col("parts") == F.col("_last") + 1) & (
        F.col("size") == F.col("_full") * F.col("_last") + F.col("_rest")
    )
    name = F.concat_ws(":", *key)
    lacking = F.raise_error(F.concat(F.lit("parts missing or cut short in object "), name)).cast("string")
    etag = F.when(complete, F.col("etag"))
    etag = (etag.otherwise(lacking) if strict else etag).alias("etag")
    etags = etags.select(*key, etag, "parts", "size")
    if objects is None:
        return etags
    zero = F.lit(0).cast("long")
    return objects.select(*key).join(etags, key, "left").select(
        *key,
        F.when(F.col("parts").isNull(), F.lit(EMPTY_ETAG)).otherwise(F.col("etag")).alias("etag"),
        F.coalesce("parts", zero).alias("parts"),
        F.coalesce("size", zero).alias("size"),
    )


def manifest_of(etags: DataFrame, key: str | Sequence[str] = "object_id") -> DataFrame:
    """Manifest rows a store would report for objects with these tags."""
    return etags.select(*columns(key), quoted_etag("etag", "parts").alias("e_tag"))


def verify(
    etags: DataFrame, manifest: DataFrame, key: str | Sequence[str] = "object_id"
) -> DataFrame:
    """Add ``e_tag`` and ``verified``; absent or null tags are not verified."""
    key = columns(key)
    reported = manifest.select(*key, "e_tag", F.lit(True).alias("_listed"))
    return (
        etags.join(reported, key, "left")
        .withColumn("present", F.coalesce("_listed", F.lit(False)))
        .withColumn("verified", etag_matches(F.col("e_tag"), F.col("etag")))
        .drop("_listed")
    )


def pending(
    catalog: DataFrame,
    manifest: DataFrame,
    key: str | Sequence[str] = "object_id",
    max_attempts: int | None = None,
) -> DataFrame:
    """Objects whose upload is still to be done or to be repeated.

    ``catalog`` holds the expected ``etag`` and, optionally, ``size`` and
    ``attempts``. The result adds ``reason``: ``absent``, ``no_tag`` or
    ``mismatch``. An object of unknown size is an error and not a retry, so it
    is left out here (see :func:`unsized`). With ``max_attempts`` the objects
    tried that often are left out as well.
    """
    rows = verify(catalog, manifest, key).filter(~F.col("verified"))
    if "size" in catalog.columns:
        rows = rows.filter(F.col("size").isNotNull())
    if max_attempts is not None:
        rows = rows.filter(F.col("attempts") < max_attempts)
    reason = (
        F.when(~F.col("present"), F.lit("absent"))
        .when(F.col("e_tag").isNull(), F.lit("no_tag"))
        .otherwise(F.lit("mismatch"))
    )
    return rows.withColumn("reason", reason).drop("present", "verified", "e_tag")


def unsized(catalog: DataFrame) -> DataFrame:
    """Objects that cannot be shipped because their size is unknown."""
    return catalog.filter(F.col("size").isNull())
