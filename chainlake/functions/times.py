"""Time helpers of the metric queries."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Seconds per unit.
UNITS = {
    "s": 1,
    "sec": 1,
    "second": 1,
    "m": 60,
    "min": 60,
    "minute": 60,
    "h": 3600,
    "hr": 3600,
    "hour": 3600,
    "d": 86400,
    "day": 86400,
    "w": 604800,
    "week": 604800,
}

# Zone names that mean UTC.
UTC_NAMES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


def seconds_of(duration: str | int) -> int:
    """Whole seconds of ``10``, ``"10 seconds"``, ``"1h 30m"`` and the like."""
    if isinstance(duration, int) and not isinstance(duration, bool):
        seconds = duration
    elif isinstance(duration, str):
        seconds = 0
        for count, unit in re.findall(r"(\d*)\s*(\D*)", duration.strip())[:-1]:
            name = unit.strip()
            name = name if name in UNITS else name.removesuffix("s")
            if not count or name not in UNITS:
                raise ValueError(f"not a duration: {duration!r}")
            seconds += int(count) * UNITS[name]
    else:
        raise TypeError("a duration is a number of seconds or a text")
    if seconds <= 0:
        raise ValueError(f"a duration must be positive: {duration!r}")
    return seconds


def bucket_start(ts: Column | str, duration: str | int) -> Column:
    """Start of the tumbling bucket a timestamp falls in, as epoch seconds.

    Plain long arithmetic, so it stays inside generated code and can be a
    grouping key next to labels; the same alignment as ``F.window``.
    """
    seconds = F.lit(seconds_of(duration)).cast("long")
    epoch = F.unix_seconds(ts)
    return epoch - F.pmod(epoch, seconds)


def utc_timestamp(ts: Column | str) -> Column:
    """A zone-less timestamp read as UTC, whatever the session's zone is.

    In a UTC session this is a plain cast, which is several times cheaper.
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    zone = SparkSession.active().conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        ts = F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts)
    return ts.cast("timestamp")
