"""Date helpers. All of them work in the session time zone, which is one fixed zone per deployment."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

DATETIME = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyy-MM-dd"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def event_time(millis) -> Column:
    """Epoch milliseconds -> timestamp."""
    return F.timestamp_millis(_col(millis))


def parse_time(text) -> Column:
    """'yyyy-MM-dd HH:mm:ss' or 'yyyy-MM-dd' -> timestamp, null when it is neither."""
    c = _col(text)
    return F.coalesce(F.try_to_timestamp(c, F.lit(DATETIME)), F.try_to_timestamp(c, F.lit(DAY)))


def millis_of(text) -> Column:
    """Datetime or day text -> epoch milliseconds."""
    return F.unix_millis(parse_time(text))


def day_text(millis) -> Column:
    """Epoch milliseconds -> 'yyyy-MM-dd'."""
    return F.date_format(event_time(millis), DAY)


def datetime_text(millis) -> Column:
    """Epoch milliseconds -> 'yyyy-MM-dd HH:mm:ss'."""
    return F.date_format(event_time(millis), DATETIME)


def now_millis() -> Column:
    """Emission time for live jobs. It differs from run to run, so tests leave it out."""
    return F.unix_millis(F.current_timestamp())


_UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds_of(duration: str) -> float:
    """'10 seconds', '1 hour', '-2 seconds' -> seconds."""
    m = re.fullmatch(r"\s*(-?\d+(?:\.\d+)?)\s*([a-z]+?)s?\s*", duration)
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"not a duration: {duration!r}")
    return float(m.group(1)) * _UNITS[m.group(2)]
