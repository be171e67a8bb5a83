"""Audience segments from a rule table.

A rule row is (source pattern, minage, maxage, minparentage, maxparentage,
target).  A golden row belongs to a target when it satisfies ANY rule of
that target.  A rule needs ``source_type LIKE pattern`` and, depending on
which bounds are set (P9: non-blank, all digits), an age clause:

=========  =====  ==========================================================
parents    kids   age clause (OR of terms; x in [a, b] is BETWEEN)
=========  =====  ==========================================================
yes        yes    child_age, child_deduced_age in [min, max];
                  age, child_age, child_deduced_age in [pmin, pmax];
                  each of min, max, pmin, pmax in [age_start, age_end]
yes        no     age, child_age, child_deduced_age in [pmin, pmax];
                  pmin, pmax in [age_start, age_end]
no         yes    age, child_age, child_deduced_age in [min, max];
                  min, max in [age_start, age_end]
no         no     none
=========  =====  ==========================================================

Bounds that are not set are NULL, so a half-open rule only matches through
its set bound lying inside the row's [age_start, age_end].  Row values are
integers via ``try_cast`` (blank or junk -> NULL, never an error).

A target is a table of a database: rules of ``db1.t`` and ``db2.t`` never
mix.  Rules are matched in two steps, neither of which grows with rows times
targets (``matching_rules``):

1. the patterns meet the *distinct* source types: an equi-join on the part of
   the pattern before its first wildcard, then LIKE;
2. golden rows meet the rules of their own source type by an equi-join, and
   the age clause, whose bounds are columns, decides.

``how="columns"`` (default) carries the rules of a (source type, target) as
one array, so a row meets each target of its type once and needs no
``distinct``; ``how="join"`` joins rule by rule and de-duplicates.  Both give
the same rows, whatever the number of rules or targets: the plan's size does
not depend on them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recunify.functions.blank import int_or_null, is_blank_trim, is_int_text
from recunify.operators.suppression import anti_history, key_join, suppression_pair

RULE_FIELDS = ("source", "minage", "maxage", "minparentage", "maxparentage")
TARGET = ("targetdatabase", "targettable")


def _between(x: Column, lo: Column, hi: Column) -> Column:
    return (x >= lo) & (x <= hi)


def _age_clause(rule, age: Column, child: Column, deduced: Column, start: Column, end: Column) -> Column:
    """The table above; ``rule`` gives the columns kids, parents, min, max, pmin, pmax."""
    kids = [_between(x, rule["min"], rule["max"]) for x in (child, deduced)]
    parents = [_between(x, rule["pmin"], rule["pmax"]) for x in (age, child, deduced)]
    kid_bounds = [_between(rule[b], start, end) for b in ("min", "max")]
    parent_bounds = [_between(rule[b], start, end) for b in ("pmin", "pmax")]
    both = reduce(or_, kids + parents + kid_bounds + parent_bounds)
    only_parents = reduce(or_, parents + parent_bounds)
    only_kids = reduce(or_, [_between(age, rule["min"], rule["max"])] + kids + kid_bounds)
    return (F.when(rule["parents"] & rule["kids"], both).when(rule["parents"], only_parents)
            .when(rule["kids"], only_kids).otherwise(F.lit(True)))


AGE_COLUMNS = ("age", "child_age", "child_deduced_age", "age_start", "age_end")
_INT = "__int_"
_BOUNDS = ("kids", "parents", "min", "max", "pmin", "pmax")


def _row_values() -> dict[str, Column]:
    return dict(zip(("age", "child", "deduced", "start", "end"), [F.col(_INT + c) for c in AGE_COLUMNS]))


def target_columns(rules: DataFrame, target_col: str = "targettable") -> list[str]:
    """The columns that name a target: (database, table), or the table alone if rules have no database."""
    return [c for c in TARGET[:1] if c in rules.columns] + [target_col]


def rules_of_targets(rules: DataFrame, pattern: str, target_col: str = "targettable") -> DataFrame:
    """The rules of the targets whose table name matches ``pattern`` (unanchored; '' is all)."""
    return rules.where(F.col(target_col).rlike(pattern)) if pattern else rules


def matching_rules(types: DataFrame, rules: DataFrame, target_col: str = "targettable",
                   source_type: str = "source_type") -> DataFrame:
    """(source_type, target, bounds) of every rule whose pattern matches one of the distinct ``types``.
    A rule without a pattern selects nothing; a bound that is no integer or overflows is NULL."""
    def is_set(c):
        return is_int_text(F.col(c))

    def bound(c):
        return F.when(is_set(c), F.col(c).try_cast("int"))
    r = rules.where(F.col("source").isNotNull()).select(
        *target_columns(rules, target_col), F.col("source").alias("__pattern"),
        F.regexp_extract("source", r"^[^%_\\]*", 0).alias("__head"),
        (is_set("minage") | is_set("maxage")).alias("kids"),
        (is_set("minparentage") | is_set("maxparentage")).alias("parents"),
        bound("minage").alias("min"), bound("maxage").alias("max"),
        bound("minparentage").alias("pmin"), bound("maxparentage").alias("pmax"))
    heads = types.where(F.col(source_type).isNotNull()).select(source_type, F.explode(F.transform(
        F.sequence(F.lit(0), F.length(source_type)), lambda n: F.substring(F.col(source_type), F.lit(1), n))).alias("__head"))
    return (heads.join(r, "__head").where(F.like(F.col(source_type), F.col("__pattern")))
            .select(source_type, *target_columns(rules, target_col), *_BOUNDS).distinct())


def segment_rows(golden: DataFrame, rules: DataFrame, target_col: str = "targettable",
                 key: str = "mobile", how: str = "columns", source_type: str = "source_type",
                 types: DataFrame | None = None) -> DataFrame:
    """(target, golden row) for every target whose rules the row satisfies.

    ``types`` are the distinct source types, if they can be had for less than
    from ``golden`` itself."""
    target = target_columns(rules, target_col)
    types = golden.select(source_type).distinct() if types is None else types
    matched = matching_rules(types, rules, target_col, source_type)
    ints = golden.select(*golden.columns, *[int_or_null(c).alias(_INT + c) for c in AGE_COLUMNS])
    if how == "columns":
        per_target = matched.groupBy(source_type, *target).agg(F.collect_list(F.struct(*_BOUNDS)).alias("__rules"))
        hit = F.exists("__rules", lambda rule: _age_clause(rule, **_row_values()))
        return ints.join(per_target, source_type).where(hit).select(*target, *golden.columns)
    if how == "join":
        hit = _age_clause({b: F.col(b) for b in _BOUNDS}, **_row_values())
        # golden rows are unique per key, so whole-row distinct = distinct (target, key)
        return ints.join(matched, source_type).where(hit).select(*target, *golden.columns).distinct()
    raise ValueError(f"unknown evaluation {how!r}")


def lookup_fill(df: DataFrame, dim: DataFrame, key_expr: Column, dim_key: str,
                value_col: str, dim_value: str | None = None,
                hot_rows: int | None = None) -> DataFrame:
    """Fill ``value_col`` from a dimension when it is blank (after trim).

    The dimension is de-duplicated per key first (max value) so the left
    join can never multiply rows.  The join is left to Spark/AQE: it is
    broadcast when the dimension's runtime size is under the broadcast
    threshold, else shuffled; ``hot_rows`` salts hot keys then.
    """
    dim_value = dim_value or value_col
    d = dim.groupBy(F.col(dim_key).alias("__lookup_key")).agg(F.max(dim_value).alias("__dim_value"))
    j = key_join(df.withColumn("__lookup_key", key_expr), d, "__lookup_key", "left", hot_rows)
    filled = F.when(is_blank_trim(value_col), F.col("__dim_value")).otherwise(F.col(value_col))
    return j.select(*[filled.alias(c) if c == value_col else F.col(c) for c in df.columns])


def drop_blank(df: DataFrame, column: str) -> DataFrame:
    """P10: drop rows whose ``column`` is NULL or blank after trim."""
    return df.where(~is_blank_trim(column))


def targets_without_category(rules: DataFrame, target_categories: DataFrame,
                             target_col: str = "targettable", category: str = "category") -> DataFrame:
    """The targets with rules that have no category, which can't be
    published.  The category list is by table name, in every database."""
    known = target_categories.where(F.col(category).isNotNull()).select(target_col)
    return rules.select(*target_columns(rules, target_col)).distinct().join(known, target_col, "left_anti")


def publish_segments(golden: DataFrame, rules: DataFrame, target_categories: DataFrame,
                     suppression, dim: DataFrame, dim_key_expr: Column,
                     dim_key: str = "tel", city: str = "city_short",
                     target_col: str = "targettable", key: str = "mobile",
                     category: str = "category", pattern: str = "", hot_rows: int | None = None) -> DataFrame:
    """C9 for every target whose table matches ``pattern``, in one pass:
    golden rows minus the suppression for all categories -> city filled from
    the dimension -> rows with a blank city dropped -> segments -> minus the
    suppression for the target's own category.  Only the last step needs the
    target, so the others see each golden row once, not once per target.

    A target without a category fails alone: it gives no rows, the others
    do, and ``targets_without_category`` names it.  ``suppression`` is the
    pair from ``active_suppression_parts`` (or the table from
    ``active_suppression(..., category_value=None)``).
    """
    rules = rules_of_targets(rules, pattern, target_col)
    # one row per target table (first category wins)
    tc = (target_categories.where(F.col(category).isNotNull()).groupBy(target_col)
          .agg(F.min(category).alias(category)))
    common, per_category = suppression_pair(suppression, key, category)
    # what depends on the golden row alone comes before rows are copied to their targets
    kept = anti_history(golden, common, key, hot_rows)
    kept = drop_blank(lookup_fill(kept, dim, dim_key_expr, dim_key, city, hot_rows=hot_rows), city)
    segs = segment_rows(kept, rules.join(tc.select(target_col), target_col, "left_semi"), target_col, key,
                        types=golden.select("source_type").distinct())
    out = anti_history(segs.join(tc, target_col), per_category, [key, category], hot_rows)
    return out.select(*target_columns(rules, target_col), *golden.columns)


def write_segments(df: DataFrame, root: str, evaluated: DataFrame | None = None,
                   target_col: str = "targettable", rows_per_file: int | None = None) -> None:
    """K1 per target: each target is a folder ``root/<database>/<table>`` in
    partition form, fully replaced.

    ``evaluated`` lists the targets that were computed; those of them without
    rows are cleared, so people suppressed since the last run don't stay
    published.  Targets outside it (failed, or not asked for) keep their rows.
    ``rows_per_file`` spreads a large target over writers by its size.
    """
    from recunify.sinks.writers import drop_partitions, overwrite_partitions
    target = target_columns(df, target_col)
    overwrite_partitions(df, root, target, rows_per_file=rows_per_file)
    if evaluated is not None:
        empty = evaluated.select(*target).distinct().join(df.select(*target).distinct(), target, "left_anti")
        drop_partitions(df.sparkSession, root, [r.asDict() for r in empty.collect()])  # one row per target at most
