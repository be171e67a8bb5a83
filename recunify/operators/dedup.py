"""Latest-row dedup of hot feeds and the hot/cold split.

``latest_dedup`` keeps the newest row per key with
``row_number() over (partition by keys order by <order> desc) = 1``.
Spark 3.5+ plans this as a *partial* ``WindowGroupLimit`` before the
shuffle and a final one after it, so each map task forwards at most one
row per key: a key holding a third of the feed never lands whole in one
task.  The order columns should end in a unique tie-break.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recunify.functions.dates import shift_day


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hot(df: DataFrame, day_col: str, cutoff: str) -> DataFrame:
    """Rows with ``day >= cutoff`` (P6 hot side)."""
    return df.where(F.col(day_col) >= cutoff)


def cold(df: DataFrame, day_col: str, cutoff: str) -> DataFrame:
    """Rows with ``day < cutoff`` (P6 cold side).  NULL days are in neither."""
    return df.where(F.col(day_col) < cutoff)


def latest_dedup(df: DataFrame, keys: Sequence[str], order: Sequence,
                 day_col: str | None = None, as_of: str | None = None,
                 days: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Newest row per ``keys`` among rows of the last ``days`` days.

    ``order`` columns are compared descending, most significant first; end
    them with a unique tie-break where the feed has one.

    ``columns`` is the output projection (P2: the metadata column list);
    default is every input column.
    """
    if as_of is not None:
        if day_col is None or days is None:
            raise ValueError("as_of needs day_col and days")
        df = hot(df, day_col, shift_day(as_of, -days))
    out_cols = list(columns) if columns is not None else df.columns
    # A hash of the whole row closes remaining ties, so a retried task picks
    # the same survivor (row_number over a non-unique order is otherwise
    # free to differ between attempts).
    tiebreak = F.xxhash64(*[F.col(c) for c in df.columns])
    w = Window.partitionBy(*keys).orderBy(*[_c(o).desc() for o in order], tiebreak.desc())
    return (df.withColumn("__rn", F.row_number().over(w))
              .where(F.col("__rn") == 1)
              .select(*out_cols))
