"""Day-string helpers.

Days travel as fixed-width strings (``yyyy-MM-dd``, ``yyyyMMdd``) so that
lexicographic comparison is date comparison and partition values stay
readable.  The as-of day is always a parameter, never the wall clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shift_day(day: str, days: int) -> str:
    """``yyyy-MM-dd`` string moved by ``days`` (negative = earlier).

    Computed once on the driver for a literal parameter, so the result
    becomes a constant in the plan and can prune partitions.
    """
    d = _dt.date.fromisoformat(day) + _dt.timedelta(days=days)
    return d.isoformat()


def compact_day(day: str) -> str:
    """``yyyy-MM-dd`` -> ``yyyyMMdd`` for a literal."""
    return day.replace("-", "")


def dash_day(day: str) -> str:
    """``yyyyMMdd`` -> ``yyyy-MM-dd`` for a literal."""
    return f"{day[0:4]}-{day[4:6]}-{day[6:8]}"


def day_of(ts) -> Column:
    """Timestamp column -> ``yyyy-MM-dd``."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def time_of(ts) -> Column:
    """Timestamp column -> ``HH_mm_ss`` (the partition-time format)."""
    return F.date_format(_c(ts), "HH_mm_ss")


def compact_day_col(c) -> Column:
    """``yyyy-MM-dd`` column -> ``yyyyMMdd``."""
    return F.regexp_replace(_c(c), "-", "")


def dash_day_col(c) -> Column:
    """``yyyyMMdd`` column -> ``yyyy-MM-dd``."""
    c = _c(c)
    return F.concat(F.substring(c, 1, 4), F.lit("-"), F.substring(c, 5, 2),
                    F.lit("-"), F.substring(c, 7, 2))
