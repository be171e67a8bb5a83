"""What changed between two tables, and merging attributes that are not columns.

* ``change_set``    intersect/except with repeats: the rows to take out of and
  to add to one table to get another.
* ``merge_maps``    survivorship (W2) of a map column whose names are not known
  in advance.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recunify.functions.blank import is_blank


def change_set(old: DataFrame, new: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The columns, ``op`` (``add`` or ``drop``) and ``copies``: ``new`` EXCEPT ALL ``old``, and the other way.

    Every row counts +1 in ``new`` and -1 in ``old``; the sums tell both
    differences, from one union and one shuffle, combined map-side: a row
    repeated a million times is one partial sum per task.  NULLs are equal to
    each other.  Both tables are compared on ``columns`` (``old``'s by default).
    """
    columns = list(columns or old.columns)
    signed = (new.select(*columns, F.lit(1).alias("__sign")).unionByName(old.select(*columns, F.lit(-1).alias("__sign")))
              .groupBy(*columns).agg(F.sum("__sign").alias("__sign")).where("__sign <> 0"))
    return signed.select(*columns, F.when(F.col("__sign") > 0, "add").otherwise("drop").alias("op"),
                         F.abs("__sign").alias("copies"))


def common_rows(old: DataFrame, new: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The columns and ``copies`` of the rows in both: INTERSECT ALL."""
    columns = list(columns or old.columns)
    both = (new.select(*columns, F.lit(1).alias("__new"), F.lit(0).alias("__old"))
            .unionByName(old.select(*columns, F.lit(0).alias("__new"), F.lit(1).alias("__old"))))
    copies = F.least(F.sum("__new"), F.sum("__old"))
    return both.groupBy(*columns).agg(copies.alias("copies")).where("copies > 0")


def apply_changes(old: DataFrame, changes: DataFrame) -> DataFrame:
    """``old`` after a change set: the rows of ``new``, repeated as there."""
    columns = [c for c in old.columns if c in changes.columns]
    signed = changes.withColumn("__n", F.when(F.col("op") == "add", F.col("copies")).otherwise(-F.col("copies")))
    n = (old.select(*columns, F.lit(1).cast("long").alias("__n")).unionByName(signed.select(*columns, "__n"))
         .groupBy(*columns).agg(F.sum("__n").cast("int").alias("__n")).where("__n > 0"))
    return n.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__n")))).select(*columns)


def merged_entries(df: DataFrame, key: str, attributes: str, order: Sequence[str]) -> DataFrame:
    """(key, name, value): for each name the latest non-blank value, else its latest blank one.

    The map is exploded to (key, name, value) rows and one aggregate serves
    every name, so the plan is the same for ten names and for ten thousand.
    ``order`` are the columns that tell later from earlier; ties go to the
    greatest value, as in the column-wise rule.
    """
    entries = df.select(F.col(key), *order, F.explode(attributes).alias("name", "value"))
    rank = F.struct((~is_blank("value")).alias("filled"), *[F.col(c) for c in order], F.col("value"))
    return (entries.groupBy(key, "name").agg(F.max(rank).alias("__best"))
            .select(key, "name", F.col("__best.value").alias("value")))


def merge_maps(df: DataFrame, key: str, attributes: str, order: Sequence[str]) -> DataFrame:
    """(key, attributes): one map per key, its names in order; keys without any entry get an empty map."""
    best = merged_entries(df, key, attributes, order)
    merged = best.groupBy(key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("name", "value")))).alias(attributes))
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    keys = df.select(key).distinct()
    return (keys.withColumnRenamed(key, "__key").join(merged, F.col("__key").eqNullSafe(F.col(key)), "left")
            .select(F.col("__key").alias(key), F.coalesce(attributes, empty).alias(attributes)))


def attribute_map(columns: Sequence[str]) -> Column:
    """A map of the named columns, for tables that have them as columns."""
    return F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])
