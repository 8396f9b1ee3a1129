"""Smart keys of the date and time dimensions, computed without a lookup join."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(c) -> Column:
    """YYYYMMDD as int."""
    d = _c(c).cast("date")
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def time_key_from_ts(c) -> Column:
    """HHMMSS as int from a timestamp."""
    t = _c(c)
    return F.hour(t) * 10000 + F.minute(t) * 100 + F.second(t)


def time_key_from_text(c) -> Column:
    """HHMMSS as int from 'HH:mm:ss' text (TIME is stored as text)."""
    parts = F.split(_c(c), ":")
    return (parts.getItem(0).try_cast("int") * 10000 + parts.getItem(1).try_cast("int") * 100
            + parts.getItem(2).try_cast("int"))


def seconds_to_hms(c) -> Column:
    """Seconds of day -> 'HH:mm:ss'."""
    s = _c(c)
    return F.format_string("%02d:%02d:%02d", (s / 3600).cast("int"), ((s % 3600) / 60).cast("int"), (s % 60).cast("int"))
