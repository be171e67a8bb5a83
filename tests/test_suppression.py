from pyspark.sql import Window
from pyspark.sql import functions as F

from recunify.operators import suppression as sp


def _rows(spark, rows):
    return spark.createDataFrame(rows, "cat string, k string, p string, id int")


FIX = [
    ("c", "nullproj", None, 1), ("c", "nullproj", "p1", 2),      # NULL is a project
    ("c", "repeat", "p1", 3), ("c", "repeat", "p1", 4),          # one project twice
    ("c", "two", "p1", 5), ("c", "two", "p2", 6), ("c", "two", "p2", 7), ("c", "two", "p3", 8),
    ("c", "allnull", None, 9), ("c", "allnull", None, 10),
    ("d", "two", "p1", 11),                                      # other category
]


def _brute_inner(df):
    w = Window.partitionBy("cat", "k").orderBy(F.col("p").asc_nulls_first())
    r2 = df.withColumn("dr", F.dense_rank().over(w)).where("dr = 2").select("cat", "k")
    return df.join(r2, ["cat", "k"])


def test_two_groups_semi(spark):
    df = _rows(spark, FIX)
    got = sorted(r.id for r in sp.seen_in_two_groups(df, ["cat", "k"], "p").collect())
    assert got == [1, 2, 5, 6, 7, 8]
    brute = sorted({r.id for r in _brute_inner(df).collect()})
    assert got == brute


def test_two_groups_copies_equals_literal_join(spark):
    df = _rows(spark, FIX)
    got = {r.id: r.copies for r in sp.seen_in_two_groups_copies(df, ["cat", "k"], "p").collect()}
    lit = {}
    for r in _brute_inner(df).collect():
        lit[r.id] = lit.get(r.id, 0) + 1
    assert got == lit
    assert got[5] == 2          # two rows carry the rank-2 project p2


def test_anti_history_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, id int")
    keys = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert sorted(r.id for r in sp.anti_history(df, keys, "k").collect()) == [1, 3]


def test_anti_history_plan_is_left_anti(spark):
    df = spark.createDataFrame([("a", 1)], "k string, id int")
    plan = sp.anti_history(df, df.select("k"), "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan


def test_active_suppression_precedence(spark):
    # age rows count on any day; success only inside the 180-day window
    t = spark.createDataFrame([
        ("a", "X", sp.REASON_AGE, "1990-01-01"),
        ("s_old", "X", sp.REASON_SUCCESS, "2000-01-01"),
        ("s_new", "X", sp.REASON_SUCCESS, "2001-07-01"),
        ("ch", "P", sp.REASON_CHILD, "1990-01-01"),
        ("ch_closed", "P", sp.REASON_CHILD, "1990-01-01"),
        ("ch_other", "Q", sp.REASON_CHILD, "1990-01-01"),
        ("r", "X", sp.REASON_REFUSE, "2001-07-01"),
        ("r_closed", "X", sp.REASON_REFUSE, "2001-07-01"),
        ("r_old", "X", sp.REASON_REFUSE, "2001-01-01"),
    ], "mobile string, category string, source string, update_day string")
    closed = spark.createDataFrame([("ch_closed", "P"), ("r_closed", "Z")], "mobile string, category string")
    got = sorted(r.mobile for r in sp.active_suppression(t, closed, "2001-08-01", "P").collect())
    assert got == ["a", "ch", "r", "s_new"]
    allc = {(r.mobile, r.category) for r in sp.active_suppression(t, closed, "2001-08-01").collect()}
    assert ("ch", "P") in allc and ("ch_other", "Q") in allc and ("a", None) in allc


def test_candidates_refuse_branch_fixture(spark):
    out_schema = "mobile string, category string, project string, source string, update_day string, age string"
    empty_outcomes = spark.createDataFrame([], out_schema)
    history = spark.createDataFrame([("13900000003", sp.REASON_REFUSE, sp.SOURCE_TYPE, "2024-03-01"),
                                     ("13900000001", sp.REASON_REFUSE, "OTHER", "2024-03-01")],
                                    "mobile string, source string, source_type string, update_day string")
    calls = spark.createDataFrame([
        ("13900000001", "c", "p1", "3", "2024-04-25"),
        ("13900000001", "c", "p2", "4", "2024-04-26"),    # two projects, short: kept
        ("13900000002", "c", "p1", "3", "2024-04-25"),
        ("13900000002", "c", "p1", "9", "2024-04-26"),    # second call too long: one project only
        ("13900000003", "c", "p1", "1", "2024-04-25"),
        ("13900000003", "c", "p2", "1", "2024-04-26"),    # refused 2024-03-01 (< 90 days): dropped
        ("1390000004", "c", "p1", "1", "2024-04-25"),
        ("1390000004", "c", "p2", "1", "2024-04-26"),     # 10 digits: dropped by the length rule
        ("13900000005", "c", "p1", "", "2024-04-25"),
        ("13900000005", "c", "p2", "2", "2024-04-26"),    # '' duration is not a number: one project
    ], "mobile string, category string, project string, duration_time string, update_day string")
    got = sp.suppression_candidates(empty_outcomes, history, calls, "2024-04-30", call_rules={"key_length": 11})
    assert sorted((r.mobile, r.project) for r in got.collect()) == [("13900000001", "p1"), ("13900000001", "p2")]
    assert {(r.update_day, r.source_type, r.update_time, r.age) for r in got.collect()} == {
        ("2024-04-30", sp.SOURCE_TYPE, sp.UPDATE_TIME, "")}


def test_feed_rules(spark):
    from recunify.sources.feeds import call_rows, outcome_rows
    o = spark.createDataFrame([(1, "201801", "mongo", "2018-01-05", "a"), (2, "201801", "x", "2018-01-05", "a"),
                               (3, "201712", "mongo", "2018-01-05", "a"), (4, "201801", "mongo", "2018-01-02", "a"),
                               (5, "201801", "mongo", "2018-01-05", "b")],
                              "id int, month string, call_sys string, update_day string, title string")
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(outcome_rows(o, "2018-01-01", "2018-01-31", ["a"])) == [1, 2, 3, 4]
    assert ids(outcome_rows(o, "2018-01-01", "2018-01-31", ["a"], month="month", call_sys="mongo", floor="2018-01-03")) == [1]
    c = spark.createDataFrame([(1, "13900000001", "3", "8", "mongo", "t"), (2, "13900000001", "3", "7", "mongo", "t"),
                               (3, "13900000001", "3", "8", "x", "t"), (4, "13900000001", "3", "8", "mongo", "u"),
                               (5, "139", "3", "8", "mongo", "t"), (6, "13900000001", "6", "8", "mongo", "t"),
                               (7, "13900000001", "x", "8", "mongo", "t")],
                              "id int, mobile string, duration_time string, times string, call_sys string, "
                              "comments_title string").withColumn("update_day", F.lit("2018-01-05"))
    assert ids(call_rows(c, "2018-01-01", "2018-01-31", 5)) == [1, 2, 3, 4, 5]
    assert ids(call_rows(c, "2018-01-01", "2018-01-31", 5, times="8", call_sys="mongo", title="t", key_length=11)) == [1]
    assert ids(call_rows(c, "2018-01-01", "2018-01-31", 5, floor="2018-01-06")) == []


def test_hot_and_null_keys_match_the_plain_join(spark):
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 10 < 3, F.lit("hot")).when(F.col("id") % 10 < 6, F.lit(None))
        .otherwise((F.col("id") % 997).cast("string")).alias("k"), F.col("id"))
    keys = rows.where("id % 5 = 0").withColumn("x", F.col("id"))
    few = keys.select("k").distinct()
    plain = rows.join(few, "k", "left_anti").agg(F.count("*"), F.sum("id")).first()
    for hot in (None, 1000):
        assert sp.anti_history(rows, few, "k", hot).agg(F.count("*"), F.sum("id")).first() == plain
    # each side has an exchange for the join, which adaptive execution needs to split a hot key
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sp.anti_history(rows, few, "k")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(k#" in x and "__salt" in x]) == 2, plan


def test_salted_key_join_equals_plain_join(spark):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 11 == 0, F.lit(None))
        .otherwise((F.col("id") % 400).cast("string")).alias("k"), F.col("id"))
    keys = spark.createDataFrame([("hot",), ("hot",), ("7",), ("8",), (None,)], "k string")
    for how in ("left_anti", "left_semi"):
        plain = sorted(r.id for r in sp.key_join(rows, keys, "k", how).collect())
        salted = sp.key_join(rows, keys, "k", how, hot_rows=1000)
        assert sorted(r.id for r in salted.collect()) == plain
    payload = spark.createDataFrame([("hot", 1), ("hot", 2), ("7", 3)], "k string, v int")
    plain = sorted(map(tuple, sp.key_join(rows, payload, "k", "inner").collect()))
    assert sorted(map(tuple, sp.key_join(rows, payload, "k", "inner", hot_rows=1000).collect())) == plain


def test_composites_with_salting_match(spark):
    from recunify.sources import standins as si
    from conftest import SF01
    o, c, cl = si.outcomes(spark, SF01), si.calls(spark, SF01), si.closed_deals(spark, SF01)
    hist = si.suppression_history(spark, SF01)
    a = sp.suppression_candidates(o, hist, c, "2000-06-30")
    b = sp.suppression_candidates(o, hist, c, "2000-06-30", hot_rows=5)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    p1 = sp.active_suppression_parts(o, cl, "2001-08-01")
    p2 = sp.active_suppression_parts(o, cl, "2001-08-01", hot_rows=5)
    for x, y in zip(p1, p2):
        assert sorted(map(tuple, x.collect()), key=str) == sorted(map(tuple, y.collect()), key=str)
