"""Ingest reports.

``ingest_report`` (A1, C10, F2, F10): rows and distinct keys per source for
one ingest day, with a ready-to-send message column.

The result is a small DataFrame (one row per source type); sending it is
left to the caller.  ``count(distinct key)`` is planned by Spark as a
two-level aggregation (by source+key, then by source), so a source holding
a third of the rows is still counted by many tasks.

``ingest_summary`` (A8): the same figures by day and source, by day, by source
and in total, as grouping sets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.functions.dates import compact_day

# ---- fixed values -------------------------------------------------------
MESSAGE_TITLE = "[ingest notice]"
# ------------------------------------------------------------------------


def ingest_report(df: DataFrame, day: str, key: str = "mobile",
                  day_col: str = "update_day", source_col: str = "source_type") -> DataFrame:
    """Counts for ``day`` (``yyyy-MM-dd``).  The filter compares the day
    column itself, so it prunes partitions / pushes into the scan."""
    d = compact_day(day)
    agg = (df.where(F.col(day_col) == day).groupBy(source_col)
             .agg(F.count(F.lit(1)).alias("counts"), F.count_distinct(key).alias("distinct_num")))
    msg = F.concat_ws("\n", F.lit(MESSAGE_TITLE),
                      F.concat(F.lit("day: "), F.lit(d)),
                      F.concat(F.lit("source: "), F.col(source_col)),
                      F.concat(F.lit("rows: "), F.col("counts").cast("string")),
                      F.concat(F.lit("distinct: "), F.col("distinct_num").cast("string")))
    return agg.select(F.lit(d).alias("day"), source_col, "counts", "distinct_num",
                      msg.alias("message"))


def ingest_summary(df: DataFrame, key: str = "mobile", day_col: str = "update_day",
                   source_col: str = "source_type") -> DataFrame:
    """``level`` (``day_source``, ``day``, ``source`` or ``total``), day, source, counts, distinct_num.

    Rows are first counted per (day, source, key), combined map-side, so the
    one Expand that makes the four levels repeats a row per key and not per
    input row.  ``level`` tells a row whose source is NULL from a day's total.
    An empty table gives no rows, not even a total.
    """
    per_key = df.groupBy(day_col, source_col, key).agg(F.count(F.lit(1)).alias("__n"))
    sets = per_key.groupingSets([[day_col, source_col], [day_col], [source_col], []], day_col, source_col).agg(
        F.grouping(day_col).alias("__no_day"), F.grouping(source_col).alias("__no_source"),
        F.sum("__n").alias("counts"), F.count_distinct(key).alias("distinct_num"))
    level = (F.when((F.col("__no_day") == 1) & (F.col("__no_source") == 1), "total").when(F.col("__no_source") == 1, "day")
             .when(F.col("__no_day") == 1, "source").otherwise("day_source"))
    return sets.select(level.alias("level"), day_col, source_col, "counts", "distinct_num")
