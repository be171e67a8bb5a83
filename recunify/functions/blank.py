"""Emptiness predicates.

Feeds carry missing values as NULL or as the empty string, and both mean
"empty".  Survivorship rules do not trim; the city rule does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c) -> Column:
    """NULL or '' (no trimming)."""
    c = _c(c)
    return c.isNull() | (c == F.lit(""))


def is_blank_trim(c) -> Column:
    """NULL, or nothing left after trimming spaces."""
    c = _c(c)
    return c.isNull() | (F.trim(c) == F.lit(""))


def filled_flag(c) -> Column:
    """1 when the value is non-empty, else 0 (sort key: filled values win)."""
    return F.when(is_blank(c), F.lit(0)).otherwise(F.lit(1))


def int_or_null(c) -> Column:
    """Integer value of a string, NULL when it is not an integer.

    ANSI mode is on in Spark 4, so a plain cast of '' would fail the job;
    ``try_cast`` gives the NULL the feeds were written against.
    """
    return _c(c).try_cast("int")


def is_int_text(c) -> Column:
    """A rule bound counts as set when it is non-blank after trim and the
    untrimmed text is all digits (so ' 3 ' is not set)."""
    c = _c(c)
    return c.isNotNull() & (F.trim(c) != F.lit("")) & c.rlike("^[0-9]+$")
