"""Column expressions; all of them compile to built-in Catalyst expressions."""

from .keys import content_key, event_ms, event_time, is_masterchain, partition_of
from .tags import EMPTY_ETAG, etag_matches, quoted_etag
from .times import bucket_start, seconds_of, utc_timestamp

__all__ = [
    "EMPTY_ETAG",
    "bucket_start",
    "content_key",
    "etag_matches",
    "event_ms",
    "event_time",
    "is_masterchain",
    "partition_of",
    "quoted_etag",
    "seconds_of",
    "utc_timestamp",
]
