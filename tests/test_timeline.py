"""As-of join, sessions, rolling windows and interval overlap: hand-made edges, hot keys, plan shapes."""
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from recunify.operators import overlap, timeline


def rows_of(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


# ---------------------------------------------------------------- as-of join

def brute_as_of(left, right):
    out = []
    for k, t, i in left:
        states = [(rt, v) for rk, rt, v in right if k is not None and t is not None and rk == k and rt is not None and rt <= t]
        best = max(states, key=lambda s: (s[0], s[1] is not None, s[1] or ""), default=(None, None))
        out.append((k, t, i, *best))
    return sorted(out, key=str)


def test_as_of_join_edges(spark):
    left = [("a", "2024-01-01", 1), ("a", "2024-01-10", 2), ("a", "2024-03-05", 3), ("a", "2024-03-05", 3), ("a", None, 4),
            (None, "2024-01-10", 5), (None, "2024-01-10", 5), ("b", "2024-05-05", 6), ("c", "2023-12-31", 7), ("d", "2024-02-01", 8)]
    right = [("a", "2024-01-10", "x"), ("a", "2024-01-10", "y"), ("a", "2024-01-10", None), ("a", "2024-01-11", "z"),
             (None, "2024-01-01", "n"), ("c", "2024-01-01", "later"), ("d", "2024-01-31", None), ("a", None, "never"),
             ("b", "2020-02-02", "old"), ("b", "2020-02-02", "old")]
    a = spark.createDataFrame(left, "k string, day string, id int")
    b = spark.createDataFrame(right, "k string, day string, status string")
    got = timeline.as_of_join(a, b, "k", "day", ["status"], since="since")
    assert got.columns == ["k", "day", "id", "since", "status"]
    assert rows_of(got) == brute_as_of(left, right)
    assert timeline.as_of_join(a.limit(0), b, "k", "day", ["status"]).count() == 0
    assert rows_of(timeline.as_of_join(a, b.limit(0), "k", "day", ["status"])) == sorted([(*r, None) for r in left], key=str)


def test_as_of_join_random_slices_and_two_keys(spark):
    r = random.Random(4)
    day = lambda: (datetime(2024, 1, 1) + timedelta(days=r.randrange(200))).strftime("%Y-%m-%d")
    left = [(r.choice("abc"), day(), i) for i in range(300)]
    right = [(r.choice("abc"), day(), f"s{i}") for i in range(60)]
    a = spark.createDataFrame(left, "k string, day string, id int").withColumn("k2", F.lit(1))
    b = spark.createDataFrame(right, "k string, at string, status string").withColumn("k2", F.lit(1))
    for slice_of in (timeline.month_of, lambda d: F.lit("all"), lambda d: d):
        got = timeline.as_of_join(a, b, ["k", "k2"], "day", ["status"], right_time="at", since="since", slice_of=slice_of)
        assert rows_of(got, "k", "day", "id", "since", "status") == brute_as_of(left, right)


def test_as_of_join_of_a_hot_key_uses_many_tasks(spark):
    day = F.date_format(F.date_add(F.to_date(F.lit("2022-01-01")), (F.col("id") % 700).cast("int")), "yyyy-MM-dd")
    left = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"), day.alias("day"))
    right = spark.range(700).select(F.lit(-1).cast("long").alias("k"), day.alias("day"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = timeline.as_of_join(left, right, "k", "day", ["v"]).where("k = -1").withColumn("task", F.spark_partition_id())
        per_task = [r["count"] for r in got.groupBy("task").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(per_task) == 2000 and len(per_task) >= 6 and max(per_task) < 1000
    assert got.where("v is null").count() == 0


# ---------------------------------------------------------------- sessions

def brute_sessions(rows, limit):
    by_key = defaultdict(list)
    for k, t, i in rows:
        if k is not None and t is not None:
            by_key[k].append(t)
    out = {}
    for k, times in by_key.items():
        n, before = 0, None
        for t in sorted(times):
            gap = None if before is None else (t - before).total_seconds()
            n += gap is None or gap > limit
            out.setdefault((k, t), []).append((gap, n))
            before = t
    return out


def test_sessions_across_slices(spark):
    r = random.Random(8)
    start = datetime(2024, 2, 27, 22)
    rows = [(r.choice(["a", "b", None]), start + timedelta(seconds=r.randrange(400_000)), i) for i in range(200)]
    rows += [("c", start + timedelta(days=d), 1000 + d) for d in range(5)] + [("c", None, 1), (None, None, 2)]
    rows += [("d", start, 5), ("d", start, 6), ("d", start + timedelta(seconds=3600), 7), ("d", start + timedelta(seconds=7201), 8)]
    df = spark.createDataFrame(rows, "k string, at timestamp, id int")
    for limit in (3600, 20_000, 86_400):
        want = brute_sessions(rows, limit)
        for slice_of in (timeline.day_slice, lambda t: F.lit(0), lambda t: F.date_trunc("hour", t)):
            got = defaultdict(list)
            for x in timeline.sessions(df, "k", "at", limit, slice_of).collect():
                if x.k is None or x["at"] is None:
                    assert x.session is None and x.gap_seconds is None
                else:
                    got[x.k, x["at"]].append((x.gap_seconds, x.session))
            assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}
    totals = timeline.session_totals(timeline.sessions(df, "k", "at", 3600), "k", "at", 3600)
    d = rows_of(totals.where("k = 'd'"), "session", "n_rows", "longest_gap")
    assert d == [(1, 3, 3600.0), (2, 1, None)]
    assert timeline.sessions(df.limit(0), "k", "at", 5).count() == 0


def test_session_windows_over_rows_are_per_slice(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.timestamp_seconds("id").alias("at"))
    plan = timeline.sessions(df, "k", "at", 5)._jdf.queryExecution().optimizedPlan().toString()
    row_windows = [x for x in plan.splitlines() if "Window [" in x and ("lag(__t#" in x or "AS __inner#" in x)]
    assert row_windows and all(", __slice#" in x.rsplit("], [", 2)[-2] for x in row_windows)


# ---------------------------------------------------------------- rolling

def test_rolling_days_with_ties_gaps_and_nulls(spark):
    r = random.Random(2)
    day = lambda n: (datetime(2024, 1, 1) + timedelta(days=n)).strftime("%Y-%m-%d")
    rows = [(r.choice("ab"), day(r.randrange(90)), r.randrange(-5, 50)) for _ in range(300)]
    rows += [("c", day(0), None), ("c", day(14), 3), ("c", day(15), 4), (None, day(3), 1), ("a", None, 2)]
    df = spark.createDataFrame(rows, "k string, day string, v int")
    got = timeline.rolling(df, "k", "day", (0, 14, 60), {"total": F.col("v")}).collect()
    assert len(got) == len(rows)
    for x in got:
        if x.k is None or x.day is None:
            assert x.n_14 is None
            continue
        at = datetime.strptime(x.day, "%Y-%m-%d")
        for w in (0, 14, 60):
            inside = [v for k, d, v in rows if k == x.k and d and timedelta(0) <= at - datetime.strptime(d, "%Y-%m-%d") <= timedelta(days=w)]
            assert (x[f"n_{w}"], x[f"total_{w}"]) == (len(inside), sum(v or 0 for v in inside))


# ---------------------------------------------------------------- overlap

def brute_overlap(left, right):
    big = 10**12
    span = lambda a, b: (-big if a is None else a, big if b is None else b)
    out = []
    for i, a, b, g in left:
        for j, c, d, h in right:
            (a1, b1), (c1, d1) = span(a, b), span(c, d)
            if g is not None and g == h and a1 <= b1 and c1 <= d1 and a1 <= d1 and c1 <= b1:
                out.append((i, j))
    return sorted(out)


def intervals(r, n, wide):
    out = []
    for i in range(n):
        lo = r.randrange(-300, 300)
        hi = lo + r.choice([0, 1, 2, 3, 7, 8, r.randrange(wide), -1])
        out.append((i, None if r.random() < 0.05 else lo, None if r.random() < 0.05 else hi, r.choice(["x", "x", "y", None])))
    return out + [(n, -10**9, 10**9, "x"), (n + 1, 5, 5, "x"), (n + 1, 5, 5, "x")]


@pytest.mark.parametrize("wide", [4, 40, 500])
def test_overlap_join_matches_brute_force(spark, wide):
    r = random.Random(wide)
    left, right = intervals(r, 80, wide), intervals(r, 60, 30)
    a = spark.createDataFrame(left, "i int, lo int, hi int, g string")
    b = spark.createDataFrame(right, "j int, from long, to long, g string")
    got = overlap.overlap_join(a, b, "lo", "hi", "from", "to", on=["g"])
    assert got.columns == ["i", "lo", "hi", "g", "j", "from", "to"]
    assert sorted((x.i, x.j) for x in got.collect()) == brute_overlap(left, right)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert overlap.overlap_join(a.limit(0), b, "lo", "hi", "from", "to", on=["g"]).count() == 0


def test_overlap_join_spreads_a_crowded_cell(spark, monkeypatch):
    """Few bytes, many pairs: one input partition, two cells and copies of rows must not leave the pairs to one task."""
    monkeypatch.setattr(overlap, "BLOCK", 20)
    left = [(i % 150, 40, 44) for i in range(300)] + [(1000, None, None), (1001, 9, 3)]
    right = [(j % 50, 41 + j % 3, 42 + j % 5) for j in range(100)] + [(1000, None, 40), (1001, 45, 60)]
    a = spark.createDataFrame(left, "i int, lo int, hi int").withColumn("tags", F.create_map(F.lit("k"), "i")).coalesce(1)
    b = spark.createDataFrame(right, "j int, from int, to int").coalesce(1)
    got = overlap.overlap_join(a, b, "lo", "hi", "from", "to")
    assert got.columns == ["i", "lo", "hi", "tags", "j", "from", "to"]
    want = brute_overlap([(*x, "x") for x in left], [(*x, "x") for x in right])
    rows = got.withColumn("part", F.spark_partition_id()).collect()
    assert sorted((x.i, x.j) for x in rows) == want
    assert all(x.tags == {"k": x.i} for x in rows)
    assert max(Counter(x.part for x in rows).values()) < len(want) / 2


def test_overlap_join_copies_follow_the_tasks_not_the_tables(spark, monkeypatch):
    """Shuffles write the copies: the right's are bounded by the tasks, the left's by what a block holds of the right."""
    monkeypatch.setattr(overlap, "BLOCK", 2)
    left, right = [(i, 40, 44) for i in range(4000)], [(j, 41, 42) for j in range(200)]
    a = spark.createDataFrame(left, "i int, lo int, hi int")
    b = spark.createDataFrame(right, "j int, from int, to int")
    entries = [overlap._entered(overlap._dealt(overlap._levelled(df, lo, hi, n), n), n, other, [])
               for df, lo, hi, n, other in ((a, "lo", "hi", "l", [1]), (b, "from", "to", "r", [3]))]
    cells = overlap._blocks(*entries, ["__level", "__cell"]).collect()
    assert cells and all(c["__ours"] <= 200 and c["__theirs"] <= 10 for c in cells)  # 2000 and 100 lists of BLOCK rows
    for name, n in (("ROWS", 3), ("LISTS", 2), ("BLOCKS", 1)):
        monkeypatch.setattr(overlap, name, n)
    got = overlap.overlap_join(a.limit(90), b, "lo", "hi", "from", "to").collect()
    assert len(got) == len({(x.i, x.j) for x in got}) == 90 * 200


def test_overlap_index_entries_do_not_grow_with_length(spark):
    long = spark.createDataFrame([(1, 0, 10**15), (2, 7, 7)], "i int, lo long, hi long")
    entries = overlap._entered(overlap._levelled(long, "lo", "hi", "l"), "l", [0, 3, 50], [])
    assert {r.i: r.n for r in entries.groupBy("l.i").agg(F.count("*").alias("n")).collect()}.keys() == {1, 2}
    assert max(r.n for r in entries.groupBy("l.i").agg(F.count("*").alias("n")).collect()) <= 2 * 4
