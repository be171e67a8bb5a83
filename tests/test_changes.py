"""Distinct keys by merged days, grouping sets, change sets, merged maps, streamed latest rows."""
from collections import Counter

from pyspark.sql import functions as F

from recunify.operators import changes, dedup, distinct, report, survivorship as sv
from recunify.streaming.latest import latest_rows, stream_latest


def test_distinct_by_day_merges_like_count_distinct(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"),
        F.concat(F.lit("2024-01-1"), (F.col("id") % 7).cast("string")).alias("day"),
        F.when(F.col("id") % 11 == 0, None).otherwise((F.col("id") * 7919) % 9000 - 4000).alias("key"))
    bitmaps = distinct.daily_bitmaps(df, ["source"], "day", "key").cache()
    sketches = distinct.daily_sketches(df, ["source"], "day", "key").cache()
    assert max(len(r.bits) for r in bitmaps.select("bits").collect()) <= 4096
    for since, until in (("2024-01-10", "2024-01-16"), ("2024-01-12", "2024-01-13"), ("2024-01-14", "2024-01-14")):
        want = {r.source: r.n for r in df.where(F.col("day").between(since, until)).groupBy("source")
                .agg(F.count_distinct("key").alias("n")).collect()}
        assert {r.source: r.n_keys for r in distinct.exact_distinct(bitmaps, ["source"], "day", since, until).collect()} == want
        got = {r.source: r.n_keys for r in distinct.sketched_distinct(sketches, ["source"], "day", since, until).collect()}
        assert got.keys() == want.keys() and all(abs(got[s] - n) <= 0.05 * n for s, n in want.items())
    assert distinct.exact_distinct(bitmaps, ["source"], "day", "2030-01-01", "2030-01-02").count() == 0
    plan = distinct.exact_distinct(bitmaps, ["source"], "day", "2024-01-10", "2024-01-16")._jdf.queryExecution().executedPlan()
    assert "LogicalRDD" not in plan.toString()


def test_summary_tells_null_source_from_total(spark):
    rows = [("2024-01-01", "a", 1), ("2024-01-01", "a", 1), ("2024-01-01", None, 1), ("2024-01-02", None, None), (None, "a", 2)]
    df = spark.createDataFrame(rows, "update_day string, source_type string, mobile int")
    got = {(r.level, r.update_day, r.source_type): (r.counts, r.distinct_num) for r in report.ingest_summary(df).collect()}
    assert got[("total", None, None)] == (5, 2)
    assert got[("source", None, None)] == (2, 1) and got[("source", None, "a")] == (3, 2)
    assert got[("day", None, None)] == (1, 1) and got[("day", "2024-01-01", None)] == (3, 1)
    assert got[("day_source", "2024-01-01", None)] == (1, 1) and got[("day_source", "2024-01-01", "a")] == (2, 1)
    assert len(got) == 4 + 3 + 2 + 1
    assert report.ingest_summary(df.limit(0)).count() == 0
    plan = report.ingest_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand [") == 1


def test_change_set_with_repeats_and_nulls(spark):
    old = [("a", 1)] * 3 + [(None, None)] * 2 + [("b", None), ("c", 3)]
    new = [("a", 1)] + [(None, None)] * 5 + [("b", None), ("d", 4), ("d", 4)]
    a, b = (spark.createDataFrame(x, "k string, v int") for x in (old, new))
    got = changes.change_set(a, b)
    assert {tuple(r) for r in got.collect()} == {("a", 1, "drop", 2), (None, None, "add", 3), ("c", 3, "drop", 1), ("d", 4, "add", 2)}
    assert {tuple(r) for r in changes.common_rows(a, b).collect()} == {("a", 1, 1), (None, None, 2), ("b", None, 1)}
    assert Counter(tuple(r) for r in changes.apply_changes(a, got).collect()) == Counter(new)
    assert changes.change_set(a, a).count() == 0 and changes.change_set(a.limit(0), a.limit(0)).count() == 0
    plan = changes.change_set(a, b)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan


def test_merged_maps_equal_the_column_rule(spark):
    rows = [("k1", 1, "x", None), ("k1", 2, "", "b"), ("k1", 3, None, ""), ("k2", 1, "", None), ("k3", 5, "late", "z"), ("k3", 5, "lat", "z"),
            (None, 1, "n", "m")]
    df = spark.createDataFrame(rows, "key string, at int, a string, b string")
    columns = {r.key: (r.a, r.b) for r in df.groupBy("key").agg(
        *[sv.latest_non_empty(c, ["at"]).alias(c) for c in ("a", "b")]).collect()}
    maps = df.select("key", "at", changes.attribute_map(["a", "b"]).alias("attributes"))
    got = {r.key: (r.attributes["a"], r.attributes["b"]) for r in changes.merge_maps(maps, "key", "attributes", ["at"]).collect()}
    assert got == columns
    odd = spark.createDataFrame([("e", 1, {}), ("f", 1, None), ("g", 1, {"x": "1"}), ("g", 2, {"y": None, "x": ""})],
                                "key string, at int, attributes map<string,string>")
    assert {r.key: r.attributes for r in changes.merge_maps(odd, "key", "attributes", ["at"]).collect()} == {
        "e": {}, "f": {}, "g": {"x": "1", "y": None}}


def test_ten_thousand_names_do_not_grow_the_plan(spark):
    wide = spark.range(5).select(F.lit("k").alias("key"), F.col("id").alias("at"), F.map_from_arrays(
        F.transform(F.sequence(F.lit(0), F.lit(9_999)), lambda i: F.concat(F.lit("n"), i.cast("string"))),
        F.transform(F.sequence(F.lit(0), F.lit(9_999)), lambda i: (i + F.col("id")).cast("string"))).alias("attributes"))
    got = changes.merge_maps(wide, "key", "attributes", ["at"])
    assert len(got._jdf.queryExecution().executedPlan().toString()) < 20_000
    [row] = got.collect()
    assert len(row.attributes) == 10_000 and row.attributes["n17"] == "21"


def test_streamed_latest_equals_batch_in_any_order(spark, tmp_path):
    schema = "mobile string, source_type string, update_day string, update_time string, v int"
    days = [f"2024-01-{d:02d}" for d in range(1, 29)]
    rows = [(f"m{i % 13}", f"s{i % 2}", days[(i * 11) % 28], f"{i % 24:02d}_00_00", i) for i in range(400)]
    rows += [("m1", "s0", None, "01_00_00", 1000), (None, "s0", "2024-01-28", "05_00_00", 1001)]
    df = spark.createDataFrame(rows, schema)
    keys, order, n = ["source_type", "mobile"], ("update_day", "update_time", "v"), 9
    want = Counter(tuple(r) for r in dedup.latest_dedup(df, keys, order, day_col="update_day", as_of="2024-01-28", days=n).select(*df.columns).collect())
    for k, sort in enumerate(("update_day", "v")):  # oldest files first, and mixed
        src, sink, state = (str(tmp_path / f"{x}{k}") for x in ("in", "out", "state"))
        ordered = df.orderBy(F.desc(sort)) if k else df.orderBy(sort)
        for i, part in enumerate([ordered.where(F.pmod(F.xxhash64("v"), F.lit(5)) == i) for i in range(5)] if k else [ordered]):
            part.coalesce(1).write.mode("append").parquet(src)
        run = lambda: stream_latest(spark, src, df.schema, sink, state, keys, order, days=n,
                                    max_files_per_trigger=1).awaitTermination()
        run()
        read = lambda: Counter(tuple(r) for r in latest_rows(spark, sink, df.schema, keys, order, "2024-01-28", days=n).collect())
        assert read() == want
        run()  # nothing new
        assert read() == want
        late = [("m3", "s1", "2024-01-02", "23_00_00", 5000), ("m3", "s1", "2024-01-27", "23_59_59", 5001)]
        spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(src)
        run()
        both = df.unionByName(spark.createDataFrame(late, schema))
        assert read() == Counter(tuple(r) for r in dedup.latest_dedup(both, keys, order, day_col="update_day", as_of="2024-01-28", days=n)
                                 .select(*df.columns).collect())


def test_replayed_micro_batch_changes_nothing(spark, tmp_path):
    schema = "mobile string, update_day string, update_time string, v int"
    df = spark.createDataFrame([("a", "2024-01-05", "1", 1), ("a", "2024-01-06", "1", 2), ("b", "2024-01-05", "1", 3)], schema)
    src, sink = str(tmp_path / "in"), str(tmp_path / "out")
    df.write.parquet(src)

    def run(state):
        stream_latest(spark, src, df.schema, sink, str(tmp_path / state), ["mobile"], ("update_day", "update_time"), days=5).awaitTermination()
        return sorted(tuple(r) for r in spark.read.schema(df.schema).parquet(sink).select(*df.columns).collect())
    # a driver that lost its state begins at batch 0 again and replaces what that batch wrote
    assert run("first") == run("second") == [("a", "2024-01-05", "1", 1), ("a", "2024-01-06", "1", 2), ("b", "2024-01-05", "1", 3)]
    latest = latest_rows(spark, sink, df.schema, ["mobile"], ("update_day", "update_time"), "2024-01-06", days=5)
    assert sorted(tuple(r) for r in latest.collect()) == [("a", "2024-01-06", "1", 2), ("b", "2024-01-05", "1", 3)]
