"""Generic readers: prefix scans, tier tagging, history keys, layout alignment.

All of these are plain ``where``/``select`` over a DataFrame, so Catalyst
pushes the predicates into the parquet scan (``PushedFilters``) or prunes
hive partitions when the column is a partition column.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_table(spark, sf_dir: str, name: str) -> DataFrame:
    """Parquet table ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    """Rows whose ``column`` starts with ``prefix``.

    ``startswith`` is pushed to parquet as a StringStartsWith filter and
    prunes directories when ``column`` is a partition column.
    """
    return df.where(F.col(column).startswith(prefix))


def tier_of(column: str, tiers: Mapping[int, Sequence[str]]) -> Column:
    """Tier number for the first matching prefix, NULL when none matches."""
    expr = None
    for tier, prefixes in tiers.items():
        cond = reduce(or_, [F.col(column).startswith(p) for p in prefixes])
        expr = F.when(cond, F.lit(tier)) if expr is None else expr.when(cond, F.lit(tier))
    return expr


def read_tiers(df: DataFrame, column: str, tiers: Mapping[int, Sequence[str]],
               tier_col: str = "tier") -> DataFrame:
    """Union of the prefix scans of every tier, tagged with its tier.

    Written as one scan with an OR of prefixes and a CASE tag instead of
    one scan per prefix: the same rows, one pass over the input.  A prefix
    that starts another one would put a row into both scans; such tiers are
    refused.
    """
    prefixes = sorted(p for ps in tiers.values() for p in ps)
    for a, b in zip(prefixes, prefixes[1:]):  # in order, a prefix stands right before what it starts
        if b.startswith(a):
            raise ValueError(f"prefix {a!r} also matches {b!r}")
    cond = reduce(or_, [F.col(column).startswith(p) for p in prefixes])
    return df.where(cond).withColumn(tier_col, tier_of(column, tiers))


def history_keys(df: DataFrame, key: str, reason_col: str, reason: str,
                 day_col: str, before: str, since: str | None = None,
                 source_type: str | None = None) -> DataFrame:
    """Distinct keys recorded for ``reason`` with ``since <= day < before``, by
    rows of one ``source_type`` where it is given (S5)."""
    cond = (F.col(reason_col) == reason) & (F.col(day_col) < before)
    if since is not None:
        cond = cond & (F.col(day_col) >= since)
    if source_type is not None:
        cond = cond & (F.col("source_type") == source_type)
    return df.where(cond).select(key).distinct()


def align(df: DataFrame, layout: Sequence[str], renames: Mapping[str, str] | None = None,
          constants: Mapping[str, object] | None = None, fill: str = "") -> DataFrame:
    """Project ``df`` onto a fixed column layout.

    ``renames`` maps layout name -> source column (or Column);
    ``constants`` maps layout name -> literal; every other layout column
    that the source lacks is filled with ``fill`` ('' by default).
    """
    renames = dict(renames or {})
    constants = dict(constants or {})
    have = set(df.columns)
    cols = []
    for name in layout:
        if name in constants:
            v = constants[name]
            cols.append((v if isinstance(v, Column) else F.lit(v)).alias(name))
        elif name in renames:
            src = renames[name]
            cols.append((F.col(src) if isinstance(src, str) else src).alias(name))
        elif name in have:
            cols.append(F.col(name))
        else:
            cols.append(F.lit(fill).cast("string").alias(name))
    return df.select(*cols)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def _sql_literal(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_frame(spark, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A small metadata table (rules, mappings) as a local relation.

    ``schema`` is ``"name type, name type, ..."`` with simple types.  One
    ``VALUES`` statement builds it: no Python RDD (``createDataFrame(list)``
    would start Python workers in every query touching the table) and one
    call to the JVM.  Only for metadata of a few hundred rows.
    """
    fields = [f.strip().split(None, 1) for f in schema.split(",")]
    if not rows:
        cols = ", ".join(f"CAST(NULL AS {t}) AS `{n}`" for n, t in fields)
        return spark.sql(f"SELECT {cols} WHERE FALSE")
    for r in rows:
        if len(r) != len(fields):
            raise ValueError(f"row {r!r} does not match schema {schema!r}")
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST(col{i + 1} AS {t}) AS `{n}`" for i, (n, t) in enumerate(fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {values}")
