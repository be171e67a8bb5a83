"""Distinct keys over any range of days, from what is kept per day.

``count(distinct key)`` over a new range reads every row of its days again.
Both forms below are aggregated once per (group, day), can be stored and
appended to day by day, and merge by a cheap aggregate:

* ``daily_sketches`` / ``sketched_distinct``: one HLL sketch per (group, day),
  about 2**lg_k bytes whatever the number of keys; the relative standard error
  is about 1.04 / sqrt(2**lg_k) (1.6 % at 12);
* ``daily_bitmaps`` / ``exact_distinct``: for integer keys, a bitmap of 4 KB
  for each group, day and block of 32,768 neighbouring keys; exact.  Best for
  dense keys: a block costs the same with one key as with all.

Both are combined map-side, so a group with a third of all rows sends one
sketch, or its bitmaps, per map task.  NULL keys don't count.  Days are
compared as ``yyyy-MM-dd`` strings and prune partitions of a stored table.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12


def daily_sketches(df: DataFrame, by: Sequence[str], day: str, key: str, lg_k: int = LG_K) -> DataFrame:
    """(by, day, sketch): what is kept for a day."""
    return df.groupBy(*by, day).agg(F.hll_sketch_agg(key, lg_k).alias("sketch"))


def sketched_distinct(daily: DataFrame, by: Sequence[str], day: str, since: str, until: str, name: str = "n_keys") -> DataFrame:
    """(by, estimate) of the distinct keys from ``since`` to ``until``."""
    merged = daily.where(F.col(day).between(since, until)).groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, F.hll_sketch_estimate("sketch").alias(name))


def daily_bitmaps(df: DataFrame, by: Sequence[str], day: str, key: str) -> DataFrame:
    """(by, day, block, bits): what is kept for a day."""
    return (df.where(F.col(key).isNotNull()).withColumn("block", F.bitmap_bucket_number(F.col(key)))
            .groupBy(*by, day, "block").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col(key))).alias("bits")))


def exact_distinct(daily: DataFrame, by: Sequence[str], day: str, since: str, until: str, name: str = "n_keys") -> DataFrame:
    """(by, number) of the distinct keys from ``since`` to ``until``; groups without keys are absent."""
    blocks = (daily.where(F.col(day).between(since, until)).groupBy(*by, "block")
              .agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")))
    return blocks.groupBy(*by).agg(F.sum("n").alias(name))
