"""Time conversions that do not depend on the session time zone.

The driver tables store ``ts`` as ``TIMESTAMP_NTZ``.  Casting NTZ to an
instant goes through the session time zone, so milliseconds are computed with
``timestampdiff`` against the NTZ epoch instead, which Spark evaluates in UTC
for NTZ operands.
"""
from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

_UNITS = {
    "ms": 1_000, "millisecond": 1_000, "milliseconds": 1_000,
    "s": 1_000_000, "second": 1_000_000, "seconds": 1_000_000,
    "minute": 60_000_000, "minutes": 60_000_000,
    "hour": 3_600_000_000, "hours": 3_600_000_000,
    "day": 86_400_000_000, "days": 86_400_000_000,
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a TIMESTAMP_NTZ column."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), _col(ts))


def epoch_millis(ts) -> Column:
    """Milliseconds since the epoch, truncated (the reference's ``times``)."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH_NTZ), _col(ts))


def event_time(ts) -> Column:
    """NTZ wall clock -> TIMESTAMP instant with the same UTC reading.

    Streaming watermarks need TIMESTAMP (not NTZ).  Going through epoch
    microseconds keeps window alignment identical to the NTZ batch plans
    whatever the session time zone is.
    """
    return F.timestamp_micros(epoch_micros(ts))


def millis_of(df, col: str) -> Column:
    """Epoch milliseconds of a time column of ``df``, whatever its type:
    TIMESTAMP_NTZ (driver tables), TIMESTAMP (streams) or epoch-ms numbers."""
    from pyspark.sql import types as T
    dt = df.schema[col].dataType
    if isinstance(dt, T.TimestampNTZType):
        return epoch_millis(col)
    if isinstance(dt, T.TimestampType):
        return F.unix_millis(F.col(col))
    return F.col(col).cast("long")


def to_micros(duration: str | int) -> int:
    """'2 hours' / '5 seconds' / 1500 (ms) -> microseconds."""
    if isinstance(duration, int):
        return duration * 1_000
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]+)\s*", duration)
    if not m or m.group(2).lower() not in _UNITS:
        raise ValueError(f"unsupported duration: {duration!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def seconds(duration: str | int) -> float:
    return to_micros(duration) / 1_000_000


def ntz_from_millis(ms) -> Column:
    """Epoch milliseconds -> TIMESTAMP_NTZ (UTC wall clock), time-zone free."""
    return F.timestamp_add("MILLISECOND", _col(ms), F.expr(_EPOCH_NTZ))
