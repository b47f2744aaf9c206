"""Entity tags as object stores report them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tag of an object without parts: the MD5 of no bytes.
EMPTY_ETAG = "d41d8cd98f00b204e9800998ecf8427e"


def etag_matches(reported: Column | str, expected: Column | str) -> Column:
    """True if the reported tag, without quotes, starts with the expected hex.

    Multi-part uploads carry a ``-<parts>`` suffix, hence *starts with*. A
    missing tag is a mismatch, never null.
    """
    bare = F.trim(reported, F.lit('"'))
    return F.coalesce(F.startswith(bare, expected), F.lit(False))


def quoted_etag(etag: Column | str, parts: Column | str) -> Column:
    """The tag in the form a store reports it: quoted, with the part count."""
    etag = F.col(etag) if isinstance(etag, str) else etag
    parts = F.col(parts) if isinstance(parts, str) else parts
    return F.concat(F.lit('"'), etag, F.lit("-"), parts.cast("string"), F.lit('"'))
