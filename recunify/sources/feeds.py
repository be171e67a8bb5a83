"""Readers of the outcome and call feeds, with the feeds' own filters."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recunify.functions.blank import int_or_null

# ---- fixed values -------------------------------------------------------
SOURCE_TYPE = "OPERATOR_customer"   # source_type of outcome-feed and suppression rows
UPDATE_TIME = "20_00_00"            # partition time of daily feeds
# ------------------------------------------------------------------------


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions)


def outcome_rows(df: DataFrame, since: str, until: str, titles: Sequence[str], *, day: str = "update_day",
                 title: str = "title", month: str | None = None, call_sys: str | None = None,
                 floor: str | None = None) -> DataFrame:
    """Outcomes of the days ``since`` to ``until`` with one of ``titles``.

    ``month`` names a yyyyMM partition column, which prunes by the first
    day's month; ``call_sys`` keeps one call system; ``floor`` is the first
    day of the feed that counts at all.  The title is compared untrimmed.
    """
    keep = [F.col(day).between(since, until), F.col(title).isin(list(titles))]
    if month is not None:
        keep.append(F.col(month) >= since.replace("-", "")[:6])
    if call_sys is not None:
        keep.append(F.col("call_sys") == call_sys)
    if floor is not None:
        keep.append(F.col(day) >= floor)
    return df.where(_all(keep))


def call_rows(df: DataFrame, since: str, until: str, max_seconds: int, *, key: str = "mobile", day: str = "update_day",
              duration: str = "duration_time", times: str | None = None, call_sys: str | None = None,
              title: str | None = None, title_col: str = "comments_title", key_length: int | None = None,
              floor: str | None = None) -> DataFrame:
    """Calls of the days ``since`` to ``until`` that lasted at most
    ``max_seconds`` (durations that are no integers never count).

    Optional: the feed's ``times`` and ``call_sys`` codes, the comment
    ``title``, the length of the key's text (11 for mobile numbers) and the
    first day that counts.
    """
    keep = [F.col(day).between(since, until), int_or_null(duration) <= max_seconds]
    if times is not None:
        keep.append(F.col("times") == times)
    if call_sys is not None:
        keep.append(F.col("call_sys") == call_sys)
    if title is not None:
        keep.append(F.col(title_col) == title)
    if key_length is not None:
        keep.append(F.length(F.col(key).cast("string")) == key_length)
    if floor is not None:
        keep.append(F.col(day) >= floor)
    return df.where(_all(keep))
