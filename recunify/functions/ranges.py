"""Range text parsing: '3-6yrs' -> ('3', '6').

Every run of non-digits becomes one '-', the text is split on '-', and
pieces 0 and 1 are the bounds.  ``get`` returns NULL past the end instead
of failing under ANSI mode.  A leading non-digit leaves an empty first
piece (literal behaviour); ``strip_ends=True`` removes it first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_pieces(text, strip_ends: bool = False) -> Column:
    dashed = F.regexp_replace(_c(text), "[^0-9]+", "-")
    if strip_ends:
        dashed = F.regexp_replace(dashed, "^-+|-+$", "")
    return F.split(dashed, "-")


def range_bounds(text, fallback_start=None, fallback_end=None,
                 strip_ends: bool = False) -> tuple[Column, Column]:
    """(start, end) string columns parsed from ``text``.

    When ``text`` is NULL or '' the fallback columns are used (the feeds
    carry explicit bound columns beside the free-text range).
    """
    pieces = range_pieces(text, strip_ends)
    has_text = _c(text) != F.lit("")
    fs = F.lit(None).cast("string") if fallback_start is None else _c(fallback_start)
    fe = F.lit(None).cast("string") if fallback_end is None else _c(fallback_end)
    start = F.when(has_text, F.get(pieces, 0)).otherwise(fs)
    end = F.when(has_text, F.get(pieces, 1)).otherwise(fe)
    return start, end
