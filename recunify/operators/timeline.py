"""Rows in time order per key, without putting a key's rows into one task.

* ``as_of_join``   J9: the state in force at each row's time.
* ``sessions``     W6: gaps between a key's rows and the sessions they form.
* ``rolling``      W6: counts and sums over the last n days at each row.

A window partitioned by the key alone sends a hot key to one task.  Here
windows run within (key, time slice); what crosses a slice's border is carried
by one summary row per (key, slice), over which a second, small window runs.
``slice_of`` gives the slice of a time; it must never decrease with time
(a day string's month, a timestamp's day).

Rows whose key or time is NULL belong to nobody: they keep NULL results and
are never brought together.
"""

from __future__ import annotations

from functools import reduce
from operator import or_
from typing import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recunify.operators.suppression import NULL_SALTS, key_join


def month_of(day: Column) -> Column:
    """The month of a ``yyyy-MM-dd`` day."""
    return F.substring(day, 1, 7)


def day_slice(time: Column) -> Column:
    """The day of a timestamp."""
    return F.to_date(time)


def _missing(columns: Sequence[str]) -> Column:
    return reduce(or_, [F.col(c).isNull() for c in columns])


def as_of_join(left: DataFrame, right: DataFrame, on, time: str, values: Sequence[str], right_time: str | None = None,
               since: str | None = None, slice_of: Callable[[Column], Column] = month_of) -> DataFrame:
    """Each row of ``left`` with ``values`` of the last row of ``right`` of its key at or before its time.

    Both sides are merged into one stream per (key, slice), ordered by time,
    in which ``last(state, ignoring nulls)`` is the state in force.  The state
    at a slice's beginning is a row of its own: the last state of the slices
    before, from one row per (key, slice).  No pair of rows is ever formed, so
    a key with n rows on each side costs 2n.

    Rows of ``right`` at the same time: the greatest values win.  Rows of
    ``left`` without an earlier state get NULLs; none is lost or repeated.
    ``since`` names a column for the time of the state found.
    """
    on, right_time = [on] if isinstance(on, str) else list(on), right_time or time
    state = F.struct(F.col(right_time).alias("__t"), *[F.col(v) for v in values])
    salt = F.when(_missing([*on, time]), F.pmod(F.xxhash64(*left.columns), F.lit(NULL_SALTS))).otherwise(F.lit(0)).cast("int")
    rows = left.select(*on, slice_of(F.col(time)).alias("__slice"), salt.alias("__salt"), F.col(time).alias("__t"),
                       F.lit(2).alias("__side"), F.struct(*left.columns).alias("__row"))
    states = right.where(~_missing([*on, right_time])).select(
        *on, slice_of(F.col(right_time)).alias("__slice"), F.lit(0).alias("__salt"), F.col(right_time).alias("__t"),
        F.lit(1).alias("__side"), state.alias("__state"))
    # one row per (key, slice): its last state, and whether rows ask for the state before it
    known = rows.where(~_missing([*on, "__t"]))
    borders = (states.select(*on, "__slice", "__state", F.lit(False).alias("__asks"))
               .unionByName(known.select(*on, "__slice", F.lit(True).alias("__asks")), allowMissingColumns=True)
               .groupBy(*on, "__slice").agg(F.max("__state").alias("__state"), F.max("__asks").alias("__asks")))
    before = Window.partitionBy(*on).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (borders.withColumn("__state", F.last("__state", ignorenulls=True).over(before))
               .where(F.col("__asks") & F.col("__state").isNotNull())
               .select(*on, "__slice", F.lit(0).alias("__salt"), F.col("__state.__t").alias("__t"), F.lit(0).alias("__side"), "__state"))
    stream = rows.unionByName(states.unionByName(carried), allowMissingColumns=True)
    order = (Window.partitionBy(*on, "__slice", "__salt").orderBy("__t", "__side", "__state")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = F.when(~_missing([*on, "__t"]), F.last("__state", ignorenulls=True).over(order))
    out = stream.withColumn("__found", found).where(F.col("__side") == 2)
    return out.select("__row.*", *([F.col("__found.__t").alias(since)] if since else []), *[F.col(f"__found.{v}").alias(v) for v in values])


def sessions(df: DataFrame, on, time: str, gap_seconds: int, slice_of: Callable[[Column], Column] = day_slice) -> DataFrame:
    """``df`` with ``gap_seconds`` since the key's row before and the number of its ``session``.

    A row more than ``gap_seconds`` after the one before begins a session;
    sessions of a key count from 1.  Borders inside a (key, slice) part are
    found there; each part sends one row (first and last time, number of
    borders), from which the parts are stitched: whether a part's first row
    begins a session, and how many began before it.  Times without a zone are
    taken in the session's time zone.
    """
    on = [on] if isinstance(on, str) else list(on)
    known = df.where(~_missing([*on, time])).withColumn("__slice", slice_of(F.col(time))).withColumn(
        "__t", F.unix_micros(F.col(time).cast("timestamp")))
    part = Window.partitionBy(*on, "__slice").orderBy("__t")
    limit = F.lit(gap_seconds * 1_000_000).cast("long")
    rows = (known.withColumn("__before", F.lag("__t").over(part))
            .withColumn("__begins", F.coalesce((F.col("__t") - F.col("__before") > limit).cast("long"), F.lit(0).cast("long")))
            .withColumn("__inner", F.sum("__begins").over(part.rowsBetween(Window.unboundedPreceding, Window.currentRow))))
    parts = rows.groupBy(*on, "__slice").agg(F.min("__t").alias("__first"), F.max("__t").alias("__last"), F.sum("__begins").alias("__n"))
    line = Window.partitionBy(*on).orderBy("__slice")
    opens = F.coalesce((F.col("__first") - F.col("__prior") > limit).cast("long"), F.lit(1).cast("long"))
    stitched = (parts.withColumn("__prior", F.lag("__last").over(line)).withColumn("__opens", opens)
                .withColumn("__done", F.sum(F.col("__n") + F.col("__opens")).over(
                    line.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("__n"))
                .select(*on, "__slice", "__prior", "__done"))
    gap = (F.col("__t") - F.coalesce("__before", "__prior")) / 1_000_000
    found = rows.join(stitched, [*on, "__slice"]).select(*df.columns, gap.alias("gap_seconds"),
                                                         (F.col("__done") + F.col("__inner")).alias("session"))
    return found.unionByName(df.where(_missing([*on, time])), allowMissingColumns=True)


def session_totals(rows: DataFrame, on, time: str, gap_seconds: int) -> DataFrame:
    """One row per session of ``sessions``: first and last time, rows, longest gap inside."""
    on = [on] if isinstance(on, str) else list(on)
    inside = F.when(F.col("gap_seconds") <= gap_seconds, F.col("gap_seconds"))  # a first row's gap is longer, or NULL
    return (rows.where("session is not null").groupBy(*on, "session")
            .agg(F.min(time).alias("first_time"), F.max(time).alias("last_time"), F.count(F.lit(1)).alias("n_rows"),
                 F.max(inside).alias("longest_gap")))


def rolling_days(df: DataFrame, on, day: str, widths: Sequence[int], sums: Mapping[str, Column] | None = None) -> DataFrame:
    """Per (key, day) that has rows: ``n_<w>`` rows (and ``<name>_<w>`` sums) of that day and the w days before.

    Rows are first summed per (key, day), combined map-side; a running sum over
    the days, less the running sum w + 1 days back, is the frame.  So a window
    holds at most one row a day, and its cost does not depend on w.
    """
    on, sums = [on] if isinstance(on, str) else list(on), dict(sums or {})
    measures = {"n": F.count(F.lit(1)), **{name: F.sum(c) for name, c in sums.items()}}
    daily = (df.where(~_missing([*on, day])).groupBy(*on, day).agg(*[m.alias(f"__{n}") for n, m in measures.items()])
             .withColumn("__at", F.unix_date(F.to_date(day))))
    line = Window.partitionBy(*on).orderBy("__at")
    for n in measures:
        daily = daily.withColumn(f"__{n}", F.sum(F.coalesce(F.col(f"__{n}"), F.lit(0))).over(
            line.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
    out = [(F.col(f"__{n}") - F.coalesce(F.last(f"__{n}").over(line.rangeBetween(Window.unboundedPreceding, -w - 1)), F.lit(0)))
           .alias(f"{n}_{w}") for w in widths for n in measures]
    return daily.select(*on, day, *out)


def rolling(df: DataFrame, on, day: str, widths: Sequence[int], sums: Mapping[str, Column] | None = None) -> DataFrame:
    """``df`` with the figures of ``rolling_days`` at each row's day."""
    on = [on] if isinstance(on, str) else list(on)
    return key_join(df, rolling_days(df, on, day, widths, sums), [*on, day], "left")
