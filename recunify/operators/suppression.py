"""Suppression ("do not contact") lists.

* ``anti_history``          J2/P7: rows whose key is not in a key set
                            (explicit ``left_anti``; Spark does not turn
                            left join + IS NULL into an anti join itself).
* ``seen_in_two_groups``    W5/J7: rows whose group holds >= 2 distinct
                            projects, NULL counting as a project.
* ``suppression_candidates`` C6: the daily producer of new suppression rows.
* ``active_suppression``    C7: the keys a segment must not contain.

The two-group rule is computed with aggregates only (min, max and counts
per group, combined map-side) and a semi join back, instead of a
``dense_rank`` window that would put every row of a group into one task.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recunify.functions.dates import shift_day
from recunify.sources.feeds import SOURCE_TYPE, UPDATE_TIME, call_rows
from recunify.sources.readers import align, union_all

# ---- fixed values -------------------------------------------------------
REASON_AGE = "customer_filter_age"
REASON_CHILD = "customer_filter_child"
REASON_SUCCESS = "customer_filter_success"
REASON_REFUSE = "customer_filter_refuse"
# ------------------------------------------------------------------------


# Join keys over which rows with a NULL key are spread.
NULL_SALTS = 1024


def salted_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str,
                sizes: DataFrame, hot_rows: int) -> DataFrame:
    """``left.join(right, on, how)`` with the hot keys of ``left`` spread.

    ``sizes`` has the keys and their number of rows in ``left`` as ``__n``;
    a key with n > ``hot_rows`` rows gets ceil(n / hot_rows) salts: its left
    rows take one by a hash of the row, its right rows are copied to each.
    The list of hot keys has at most rows / ``hot_rows`` entries; Spark
    broadcasts it if its measured size allows.  NULL keys are spread as in
    ``key_join``.
    """
    on = list(on)
    hot = sizes.where(F.col("__n") > hot_rows).select(*on, F.ceil(F.col("__n") / hot_rows).cast("int").alias("__salts"))
    many = F.coalesce("__salts", F.lit(1))
    row = F.xxhash64(*[F.col(c) for c in left.columns])
    salt = F.when(_any_null(on), F.pmod(row, F.lit(NULL_SALTS))).otherwise(F.pmod(row, many))
    a = left.join(hot, on, "left").withColumn("__salt", salt.cast("int")).drop("__salts")
    b = right.join(hot, on, "left").withColumn("__salt", F.explode(F.sequence(F.lit(0), many - 1))).drop("__salts")
    return a.join(b, on + ["__salt"], how).drop("__salt")


def _any_null(on: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in on])


def key_join(left: DataFrame, keys: DataFrame, on, how: str, hot_rows: int | None = None) -> DataFrame:
    """``left.join(keys, on, how)`` for ``left_semi``, ``left_anti``, ``inner`` and ``left``.

    Rows of ``left`` with a NULL key match nothing, but would all go to one
    partition; a second join column (0 for every other row) spreads them.  As
    no side is partitioned by both columns beforehand, also not one that comes
    from an aggregation by the key, each gets an exchange of its own, and
    adaptive execution can split a hot key of ``left``.  With ``hot_rows``,
    hot keys are counted and salted instead (see ``salted_join``).
    """
    on = [on] if isinstance(on, str) else list(on)
    if hot_rows is not None:
        sizes = left.where(~_any_null(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("__n"))
        return salted_join(left, keys, on, how, sizes, hot_rows)
    row = F.xxhash64(*[F.col(c) for c in left.columns])
    salt = F.when(_any_null(on), F.pmod(row, F.lit(NULL_SALTS))).otherwise(F.lit(0))
    # always 0, but no literal: the optimiser would move that out of the join keys
    zero = F.pmod(F.xxhash64(*on), F.lit(1))
    return (left.withColumn("__salt", salt.cast("int"))
            .join(keys.withColumn("__salt", zero.cast("int")), on + ["__salt"], how).drop("__salt"))


def anti_history(df: DataFrame, keys: DataFrame, on, hot_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose key(s) do not appear in ``keys`` (NULL keys stay).
    ``hot_rows`` salts keys holding more rows than that (see ``key_join``)."""
    return key_join(df, keys, on, "left_anti", hot_rows)


def _group_stats(df: DataFrame, group: Sequence[str], project: str) -> DataFrame:
    p = F.col(project)
    return df.groupBy(*group).agg(
        F.min(p).alias("__lo"), F.max(p).alias("__hi"),
        F.count(F.lit(1)).alias("__n"), F.count(p).alias("__nn"))


def _has_two() -> Column:
    two = (F.col("__lo") < F.col("__hi")) | ((F.col("__nn") > 0) & (F.col("__nn") < F.col("__n")))
    return F.coalesce(two, F.lit(False))


def _two(stats: DataFrame) -> DataFrame:
    return stats.where(_has_two())


def two_group_keys(df: DataFrame, group: Sequence[str], project: str) -> DataFrame:
    """Group keys whose rows hold at least two distinct projects.

    Equivalent to "some row has dense_rank() = 2 over (partition by group
    order by project)", where NULL sorts first and is a project of its own.
    """
    return _two(_group_stats(df, group, project)).select(*group)


def one_group_keys(df: DataFrame, group: Sequence[str], project: str) -> DataFrame:
    """The other group keys: all rows of the group have the same project, or none."""
    return _group_stats(df, group, project).where(~_has_two()).select(*group)


def group_join(df: DataFrame, keys: DataFrame, group: Sequence[str], how: str,
               hot_rows: int | None = None) -> DataFrame:
    """Join rows back to one-row-per-group ``keys``, which carry the group
    size ``__n``.  ``how`` is ``left_semi``, ``left_anti`` or ``inner``.

    Hot groups are left to adaptive execution (see ``key_join``), or, with
    ``hot_rows``, salted by their size (see ``salted_join``)."""
    if hot_rows is None:
        return key_join(df, keys.drop("__n"), list(group), how)
    return salted_join(df, keys.drop("__n"), group, how, keys, hot_rows)


def seen_in_two_groups(df: DataFrame, group: Sequence[str], project: str,
                       hot_rows: int | None = None) -> DataFrame:
    """Rows of ``df`` whose group holds >= 2 distinct projects (one copy each)."""
    keys = _two(_group_stats(df, group, project)).select(*group, "__n")
    return group_join(df, keys, group, "left_semi", hot_rows)


def seen_in_two_groups_copies(df: DataFrame, group: Sequence[str], project: str,
                              copies_col: str = "copies",
                              hot_rows: int | None = None) -> DataFrame:
    """The original joins each row to every rank-2 row of its group (left
    join + IS NOT NULL = inner), repeating it once per rank-2 row.

    Instead of materialising the repeats, each qualifying row is returned
    once with ``copies`` = the number of rank-2 rows of its group.  The rank
    is taken over the distinct projects with their counts, so the second
    distinct project is row 2, and Spark limits each group to two rows before
    the shuffle: a hot group sends two rows per map task.
    """
    per_value = df.groupBy(*group, project).agg(F.count(F.lit(1)).alias(copies_col))
    w = Window.partitionBy(*group).orderBy(F.col(project).asc_nulls_first())
    second = (per_value.withColumn("__rank", F.row_number().over(w)).where("__rank <= 2").where("__rank = 2")
              .select(*group, copies_col))
    if hot_rows is None:
        return key_join(df, second, list(group), "inner")
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    return salted_join(df, second, group, "inner", sizes, hot_rows)


def suppression_candidates(outcomes: DataFrame, history: DataFrame, calls: DataFrame,
                           as_of: str, key: str = "mobile", category: str = "category",
                           project: str = "project", reason: str = "source",
                           day: str = "update_day", duration: str = "duration_time",
                           outcome_days: int = 60, call_days: int = 14,
                           refuse_days: int = 90, max_seconds: int = 5,
                           source_type: str = SOURCE_TYPE, update_time: str = UPDATE_TIME,
                           call_rules: Mapping[str, object] | None = None,
                           call_columns: Mapping[str, object] | None = None,
                           hot_rows: int | None = None) -> DataFrame:
    """New suppression rows for day ``as_of``.

    * child / success: outcomes of the last ``outcome_days`` days with that
      reason whose key has no earlier row of that reason in ``history``;
    * age: the same, then only keys seen in >= 2 projects within
      (category, key);
    * refuse: calls of the last ``call_days`` days lasting <= ``max_seconds``
      from keys called by >= 2 projects, minus keys refused in the last
      ``refuse_days`` days.

    ``history`` rows count only with this ``source_type``.  ``call_rules``
    are further arguments of ``sources.feeds.call_rows`` (times, call_sys,
    title, key_length, floor).  ``hot_rows`` salts hot keys in the history
    anti joins (see ``key_join``).

    Output: every column of ``outcomes`` (calls are aligned to them;
    ``call_columns`` gives names or columns where they differ, the rest is
    ''), the row's own day as ``event_day``, and the partition columns
    ``source_type``, ``update_day`` (= ``as_of``) and ``update_time``.
    """
    start = shift_day(as_of, -outcome_days)
    codes = [REASON_CHILD, REASON_SUCCESS, REASON_AGE]
    win = outcomes.where(F.col(day).between(start, as_of) & F.col(reason).isin(codes))
    past = history.where((F.col("source_type") == source_type) & (F.col(day) < as_of))
    # One history pass for the three outcome reasons: (key, reason) seen before
    # today, removed with a single anti join on both columns.  Repeated rows of
    # history do no harm there, so they are not made distinct first.
    seen = past.where(F.col(reason).isin(codes)).select(key, reason)
    fresh = anti_history(win, seen, [key, reason], hot_rows)
    # Age rows must also be seen in >= 2 projects.  History takes all age rows
    # of a key or none, so the groups can be judged before it; the groups of one
    # project are removed, and age rows without a group go with them.
    is_age = F.col(reason) == REASON_AGE
    single = one_group_keys(win.where(is_age), [category, key], project).withColumn(reason, F.lit(REASON_AGE))
    fresh = anti_history(fresh.where(~is_age | (F.col(key).isNotNull() & F.col(category).isNotNull())), single,
                         [category, key, reason], hot_rows)

    short = call_rows(calls, shift_day(as_of, -call_days), as_of, max_seconds, key=key, day=day,
                      duration=duration, **(call_rules or {}))
    refused = past.where((F.col(reason) == REASON_REFUSE)
                         & (F.col(day) >= shift_day(as_of, -refuse_days))).select(key)
    # Both refuse conditions are per key, so their order is free; the anti
    # join goes last because placed first it is pushed into both inputs of
    # the two-group rule and the refused-key set is built twice.
    refuse = anti_history(seen_in_two_groups(short, [key], project), refused, key, hot_rows)

    constants = {"source_type": source_type, "update_day": as_of, "update_time": update_time}
    columns = [c for c in outcomes.columns if c not in (day, *constants)]

    def layout(df: DataFrame, renames: Mapping[str, object], values: Mapping[str, object]) -> DataFrame:
        return align(df, [*columns, "event_day", *constants], {"event_day": day, **renames}, {**constants, **values})

    return union_all([layout(fresh, {}, {}), layout(refuse, call_columns or {}, {reason: REASON_REFUSE})])


def active_suppression_parts(filter_table: DataFrame, closed: DataFrame, as_of: str,
                             key: str = "mobile", category: str = "category",
                             reason: str = "source", day: str = "update_day",
                             success_days: int = 180, refuse_days: int = 90,
                             hot_rows: int | None = None) -> tuple[DataFrame, DataFrame]:
    """C7 for every category at once, as two key sets:

    * ``common`` (key): suppressed for every category -- age rows (any day),
      success rows of the last ``success_days`` days, refuse rows of the
      last ``refuse_days`` days whose key has no closed deal anywhere;
    * ``per_category`` (key, category): child rows whose (key, category)
      has no closed deal.

    Duplicates are kept (UNION ALL semantics); anti joins ignore them, those
    of ``closed`` too, so neither is shuffled once more to be made distinct.
    """
    r, d = F.col(reason), F.col(day)
    common = filter_table.where(
        (r == REASON_AGE) | ((r == REASON_SUCCESS) & (d >= shift_day(as_of, -success_days))))
    refuse = anti_history(
        filter_table.where((r == REASON_REFUSE) & (d >= shift_day(as_of, -refuse_days))),
        closed.select(key), key, hot_rows)
    child = anti_history(filter_table.where(r == REASON_CHILD), closed.select(key, category), [key, category], hot_rows)
    return (union_all([common.select(key), refuse.select(key)]), child.select(key, category))


def active_suppression(filter_table: DataFrame, closed: DataFrame, as_of: str,
                       category_value: str | None = None, key: str = "mobile",
                       category: str = "category", reason: str = "source",
                       day: str = "update_day", success_days: int = 180,
                       refuse_days: int = 90) -> DataFrame:
    """Keys a segment of ``category_value`` must not contain.

    * age: every age row, any day, any category;
    * success: rows of the last ``success_days`` days, any category;
    * child: rows of this category whose (key, category) has no closed deal;
    * refuse: rows of the last ``refuse_days`` days whose key has no closed
      deal in any category.

    UNION ALL of keys (duplicates kept, as an anti join ignores them).  With
    ``category_value=None`` the output carries a ``category`` column (NULL =
    applies to all categories); to apply it, prefer passing
    ``active_suppression_parts(...)`` to ``suppress``.
    """
    common, per_cat = active_suppression_parts(filter_table, closed, as_of, key, category,
                                               reason, day, success_days, refuse_days)
    if category_value is not None:
        return union_all([common, per_cat.where(F.col(category) == category_value).select(key)])
    return union_all([common.select(key, F.lit(None).cast("string").alias(category)),
                      per_cat])


def suppression_pair(suppression, key: str = "mobile", category: str = "category") -> tuple[DataFrame, DataFrame]:
    """(keys for every category, (key, category) rows) of either form of a suppression."""
    if isinstance(suppression, DataFrame):
        return (suppression.where(F.col(category).isNull()).select(key),
                suppression.where(F.col(category).isNotNull()).select(key, category))
    return suppression


def suppress(rows: DataFrame, suppression, key: str = "mobile",
             category: str = "category", hot_rows: int | None = None) -> DataFrame:
    """Drop rows whose key is suppressed for every category, or for the
    row's own category.  ``suppression`` is the pair from
    ``active_suppression_parts`` (or the single table from
    ``active_suppression(category_value=None)``)."""
    common, per_cat = suppression_pair(suppression, key, category)
    return anti_history(anti_history(rows, common, key, hot_rows), per_cat, [key, category], hot_rows)
