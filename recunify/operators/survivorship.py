"""Survivorship: merge many rows per key into one golden row.

Per-column rules (all are aggregate expressions, so a whole tier is ONE
``groupBy(key).agg(...)`` with map-side partial aggregation; a hot key
costs one buffer per map task, never one task holding the whole group):

* ``any``      -- W1, the largest value; '' wins over NULL.
* ``latest``   -- W2, a non-empty value beats an empty one, then the
                  latest by the order columns (day, time, tie-break).  If
                  every value is empty the latest empty one is returned.
* ``priority`` -- W3, a non-empty value beats an empty one, then the
                  highest tier.

Provenance (A2) is the sorted distinct list of a column's values.

``golden_record`` fuses the three tier passes and the cross-tier pass into
a single aggregation: the value a tier would produce is non-empty exactly
when the tier holds a non-empty value, so ordering all rows of a key by
``(filled, tier, tier-local order)`` picks the same value the tiered
pipeline picks, with one shuffle instead of four.  ``single_pass=False``
builds the literal tiered pipeline (used by the equivalence tests).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recunify.functions.blank import filled_flag

ANY = "any"
LATEST = "latest"
PRIORITY = "priority"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pairs(columns) -> list[tuple[str, str]]:
    """Accept ['a', 'b'], [('src', 'dst')] or {'dst': 'src'}."""
    if isinstance(columns, Mapping):
        return [(src, dst) for dst, src in columns.items()]
    out = []
    for c in columns:
        out.append((c, c) if isinstance(c, str) else (c[0], c[1]))
    return out


# ---------------------------------------------------------------- rules

def any_value(c) -> Column:
    """Largest value (row_number over ``c desc`` = 1)."""
    return F.max(_c(c))


def _pick(c, *ordering) -> Column:
    """Value of the row with the largest ``(filled, *ordering, value)``.

    ``max`` over one struct keeps a single buffer per column (``max_by``
    would keep the value and the ordering separately); the value as last
    field makes ties deterministic.
    """
    v = _c(c)
    fields = [filled_flag(v).alias("f")] + [o.alias(f"o{i}") for i, o in enumerate(ordering)]
    return F.max(F.struct(*fields, v.alias("v"))).getField("v")


def latest_non_empty(c, order: Sequence) -> Column:
    """Filled first, then latest by ``order`` (all descending)."""
    return _pick(c, *[_c(o) for o in order])


def by_priority(c, priority) -> Column:
    """Filled first, then highest ``priority``."""
    return _pick(c, _c(priority))


def provenance(c) -> Column:
    """A2: distinct values joined by ',' in sorted order ('' if none)."""
    return F.array_join(F.array_sort(F.collect_set(_c(c))), ",")


def rule_expr(rule: str, c, order: Sequence = (), priority=None) -> Column:
    if rule == ANY:
        return any_value(c)
    if rule == LATEST:
        return latest_non_empty(c, order)
    if rule == PRIORITY:
        return by_priority(c, priority)
    raise ValueError(f"unknown survivorship rule {rule!r}")


# ---------------------------------------------------------------- C1

def golden_tier(df: DataFrame, key: str, columns, rule: str,
                order: Sequence = ("update_day", "update_time"),
                source_cols: Sequence[str] = ("source", "source_type")) -> DataFrame:
    """One row per key for one tier of feeds.

    ``columns`` maps source columns to output names (P3); ``rule`` is
    ``any`` or ``latest``.  Rows with a NULL key are dropped (the
    reference loses them in its inner joins).
    """
    pairs = _pairs(columns)
    if not pairs:
        raise ValueError("golden_tier needs at least one mapped column")
    aggs = [rule_expr(rule, src, order).alias(dst) for src, dst in pairs]
    aggs += [provenance(s).alias(s) for s in source_cols]
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def merge_tiers(tiered: DataFrame, key: str, columns: Sequence[str], tier_col: str = "tier",
                source_cols: Sequence[str] = ("source", "source_type")) -> DataFrame:
    """Cross-tier step of C2 over per-tier rows (at most one row per key and tier)."""
    aggs = [by_priority(c, tier_col).alias(c) for c in columns]
    aggs += [provenance(s).alias(s) for s in source_cols]
    return tiered.groupBy(key).agg(*aggs)


# ---------------------------------------------------------------- C2

def golden_record(df: DataFrame, key: str, columns, tier_col: str,
                  tier_rules: Mapping[int, str],
                  order: Sequence = ("update_day", "update_time"),
                  source_cols: Sequence[str] = ("source", "source_type"),
                  single_pass: bool = True, flatten_provenance: bool = False) -> DataFrame:
    """Golden row per key from rows tagged with their tier.

    ``tier_rules`` maps tier number (higher wins) to ``any`` or ``latest``.
    ``order`` lists the recency columns, most significant first; put a
    unique tie-break last so the pick is deterministic.

    Provenance follows the reference by default: the distinct *tier
    strings* are joined, so a value seen in two tiers appears twice
    ("a,b" and "a" give "a,a,b").  ``flatten_provenance=True`` lists each
    value once instead (the sorted distinct values over all tiers).
    """
    pairs = _pairs(columns)
    if not pairs:
        raise ValueError("golden_record needs at least one mapped column")
    for t, r in tier_rules.items():
        if r not in (ANY, LATEST):
            raise ValueError(f"tier {t}: rule must be 'any' or 'latest', got {r!r}")
    df = df.where(F.col(key).isNotNull() & F.col(tier_col).isin(list(tier_rules)))
    if not single_pass:
        if flatten_provenance and source_cols:
            base = _golden_record_tiered(df, key, pairs, tier_col, tier_rules, order, ())
            return base.join(df.groupBy(key).agg(*[provenance(s).alias(s) for s in source_cols]), key)
        return _golden_record_tiered(df, key, pairs, tier_col, tier_rules, order, source_cols)
    return _golden_single_pass(df, key, pairs, tier_col, tier_rules, order, source_cols,
                               flatten_provenance)


def _golden_single_pass(df, key, pairs, tier_col, tier_rules, order, source_cols, flat):
    tier = F.col(tier_col)
    latest_tiers = [t for t, r in tier_rules.items() if r == LATEST]
    is_latest = tier.isin(latest_tiers) if latest_tiers else F.lit(False)
    # The shared part of every column's ordering -- tier, then recency --
    # is built once per row.  Recency counts only inside 'latest' tiers;
    # inside 'any' tiers it is NULL so the value itself (last field) decides.
    rec = F.struct(tier.alias("t"), *[F.when(is_latest, _c(o)).alias(f"o{i}")
                                      for i, o in enumerate(order)])
    needed = {src for src, _ in pairs} | set(source_cols) | {key, tier_col}
    df = df.select(*[F.col(c) for c in df.columns if c in needed], rec.alias("__rec"))
    aggs = [_pick(src, F.col("__rec")).alias(dst) for src, dst in pairs]
    out = [F.col(key)] + [F.col(dst) for _, dst in pairs]
    tiers = sorted(tier_rules)
    if flat:
        # flattened: the sorted distinct values over all tiers
        aggs += [provenance(s).alias(s) for s in source_cols]
        return df.groupBy(key).agg(*aggs).select(*out, *source_cols)
    # Provenance per tier (a set of plain strings per tier: cheaper to
    # buffer and shuffle than one set of (tier, value) structs), then the
    # set of tier strings (whole strings, sorted), as the tiered pipeline
    # produces it.
    for s in source_cols:
        for t in tiers:
            aggs.append(F.array_join(F.array_sort(F.collect_set(F.when(tier == t, F.col(s)))), ",")
                        .alias(f"__{s}_{t}"))
    for t in tiers:
        aggs.append(F.max(F.when(tier == t, F.lit(True))).alias(f"__has_{t}"))
    g = df.groupBy(key).agg(*aggs)
    for s in source_cols:
        parts = F.array(*[F.when(F.col(f"__has_{t}"), F.col(f"__{s}_{t}")) for t in tiers])
        out.append(F.array_join(F.array_sort(F.array_distinct(
            F.filter(parts, lambda x: x.isNotNull()))), ",").alias(s))
    return g.select(*out)


def _golden_record_tiered(df, key, pairs, tier_col, tier_rules, order, source_cols):
    from recunify.sources.readers import union_all
    names = [dst for _, dst in pairs]
    per_tier = []
    for t, rule in sorted(tier_rules.items()):
        part = golden_tier(df.where(F.col(tier_col) == t), key, pairs, rule, order, source_cols)
        per_tier.append(part.withColumn(tier_col, F.lit(t)))
    return merge_tiers(union_all(per_tier), key, names, tier_col, source_cols)
