from pyspark.sql import functions as F

from recunify.functions.ranges import range_bounds
from recunify.operators import segments as sg
from recunify.sources import standins as si

from conftest import SF01

GSCHEMA = ("mobile string, source_type string, age string, child_age string, "
           "child_deduced_age string, age_start string, age_end string, city_short string")
RSCHEMA = "source string, minage string, maxage string, minparentage string, maxparentage string, targettable string"


def _golden(spark, rows):
    return spark.createDataFrame(rows, GSCHEMA)


def _rules(spark, rows):
    return spark.createDataFrame(rows, RSCHEMA)


def _targets(df):
    return sorted((r.targettable, r.mobile) for r in df.collect())


def test_column_form_equals_join_form(spark):
    g, r = si.golden_parts(spark, SF01), si.segment_rules(spark)
    a = [tuple(x) for x in sg.segment_rows(g, r, how="columns").collect()]
    b = map(tuple, sg.segment_rows(g, r, how="join").collect())
    assert sorted(a, key=str) == sorted(b, key=str) and len(a) > 1061


def test_half_open_and_padded_bounds(spark):
    g = _golden(spark, [
        ("in_range", "S1", "", "", "", "3", "6", "c"),     # min 4 inside [3, 6]
        ("strictly_inside", "S1", "", "", "", "5", "5", "c"),  # row range inside rule range: no match
        ("age_only", "S1", "5", "", "", "", "", "c"),      # half-open: age BETWEEN 4 AND NULL
    ])
    rules = _rules(spark, [("S%", "4", "", "", "", "half"), ("S%", "x", " 3 ", "", "", "padded")])
    got = _targets(sg.segment_rows(g, rules))
    assert ("half", "in_range") in got
    assert ("half", "strictly_inside") not in got
    assert ("half", "age_only") not in got
    # neither bound of 'padded' is set: pattern only
    assert [m for t, m in got if t == "padded"] == ["age_only", "in_range", "strictly_inside"]
    assert _targets(sg.segment_rows(g, rules, how="join")) == got


def test_like_is_case_sensitive_and_null_pattern_skipped(spark):
    g = _golden(spark, [("a", "small", "", "", "", "", "", "c"), ("b", "SMALL", "", "", "", "", "", "c")])
    rules = _rules(spark, [("S%", "", "", "", "", "t"), (None, "", "", "", "", "t")])
    assert _targets(sg.segment_rows(g, rules)) == [("t", "b")]


def test_lookup_fill_and_drop_blank(spark):
    df = spark.createDataFrame([("1390000", " "), ("1390001", None), ("1500000", ""),
                                ("1390002", "kept")], "mobile string, city_short string")
    dim = spark.createDataFrame([("1390000", "X"), ("1390000", "Y")], "tel string, city_short string")
    filled = sg.lookup_fill(df, dim, F.substring("mobile", 1, 7), "tel", "city_short")
    rows = {r.mobile: r.city_short for r in filled.collect()}
    assert len(rows) == 4 and filled.count() == 4          # duplicate tel does not multiply rows
    assert rows == {"1390000": "Y", "1390001": None, "1500000": None, "1390002": "kept"}
    assert {r.mobile for r in sg.drop_blank(filled, "city_short").collect()} == {"1390000", "1390002"}


def test_range_bounds(spark):
    df = spark.createDataFrame([("3-6岁",), ("3岁",), ("",), (None,), ("岁3到6",)], "t string")
    s, e = range_bounds("t", F.lit("fs"), F.lit("fe"))
    got = [(r.s, r.e) for r in df.select(s.alias("s"), e.alias("e")).collect()]
    assert got == [("3", "6"), ("3", ""), ("fs", "fe"), ("fs", "fe"), ("", "3")]
    s2, e2 = range_bounds("t", strip_ends=True)
    got2 = [(r.s, r.e) for r in df.select(s2.alias("s"), e2.alias("e")).collect()]
    assert got2[4] == ("3", "6") and got2[1] == ("3", None)


def _publish(spark, cats, rules=None, **kw):
    from recunify.operators import suppression as sp
    supp = sp.active_suppression_parts(si.outcomes(spark, SF01), si.closed_deals(spark, SF01), "2001-08-01")
    return sg.publish_segments(si.golden_parts(spark, SF01), si.segment_rules(spark) if rules is None else rules, cats,
                               supp, si.nation_prefix_dimension(spark, SF01),
                               F.substring(F.col("mobile").cast("string"), 1, 2), **kw)


def _names(df):
    return {(r.targetdatabase, r.targettable) for r in df.select("targetdatabase", "targettable").distinct().collect()}


def test_target_without_category_fails_alone(spark):
    rules = si.segment_rules(spark)
    cats = spark.createDataFrame([("t1", "F"), ("t3", None)], "targettable string, category string")
    failed = sg.targets_without_category(rules, cats)
    assert _names(failed) == {("seg", "t2"), ("seg", "t3"), ("seg", "t4")}
    assert _names(_publish(spark, cats)) == {("seg", "t1"), ("seg2", "t1")}


def test_pattern_publishes_a_subset(spark):
    assert _names(_publish(spark, si.target_categories(spark), pattern="[23]$")) <= {("seg", "t2"), ("seg", "t3")}
    assert ("seg", "t3") in _names(_publish(spark, si.target_categories(spark), pattern="3"))


def test_databases_keep_their_own_audience(spark):
    g = _golden(spark, [("a", "S1", "", "", "", "", "", "c"), ("b", "P1", "", "", "", "", "", "c")])
    rules = spark.createDataFrame([("S%", "", "", "", "", "db1", "t"), ("P%", "", "", "", "", "db2", "t")],
                                  RSCHEMA.replace("targettable", "targetdatabase string, targettable"))
    for how in ("columns", "join"):
        got = sorted((r.targetdatabase, r.mobile) for r in sg.segment_rows(g, rules, how=how).collect())
        assert got == [("db1", "a"), ("db2", "b")]


def test_patterns_with_wildcards_and_escapes(spark):
    g = _golden(spark, [(t, t, "", "", "", "", "", "c") for t in ("abc", "a_c", "a%c", "axbyc", "", "xabc")])
    patterns = ["a%", "%c", "a_c", r"a\_c", r"a\%c", "%b%", "", "%", "abc"]
    rules = _rules(spark, [(p, "", "", "", "", p) for p in patterns])
    got = _targets(sg.segment_rows(g, rules))
    want = sorted((r.p, r.t) for r in spark.createDataFrame(
        [(p, t) for p in patterns for t in ("abc", "a_c", "a%c", "axbyc", "", "xabc")], "p string, t string")
        .where(F.like(F.col("t"), F.col("p"))).collect())
    assert got == want and len(got) > 15


def test_thousands_of_rules_keep_the_plan(spark):
    """5,000 rules on 500 targets: same plan as for few rules, no nested-loop join, same rows in both forms."""
    rules = [(f"{'SMPLE'[i % 5]}%", str(i % 17), str(i % 17 + 2), str(i % 40) if i % 3 else "", "", f"db{i % 2}", f"t{i % 250}")
             for i in range(5000)]
    r = spark.createDataFrame(rules, RSCHEMA.replace("targettable", "targetdatabase string, targettable"))
    g = si.golden_parts(spark, SF01)
    df = sg.segment_rows(g, r)
    plan = df._jdf.queryExecution().executedPlan().toString()
    few = sg.segment_rows(g, spark.createDataFrame(rules[:3], r.schema))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("Join") == few.count("Join") and plan.count("Exchange") <= few.count("Exchange")
    n, distinct = df.count(), df.select("targetdatabase", "targettable", "mobile").distinct().count()
    assert n == distinct == sg.segment_rows(g, r, how="join").count() > 10_000


def test_overflowing_bound_is_null_in_both_forms(spark):
    g = _golden(spark, [("a", "S1", "40", "", "", "", "", "c"), ("b", "S1", "", "", "", "1", "5", "c")])
    rules = _rules(spark, [("S%", "2", "99999999999", "", "", "t")])
    # kids rule: max bound overflows -> NULL, so only 'min inside [age_start, age_end]' can match
    got = _targets(sg.segment_rows(g, rules))
    assert got == [("t", "b")]
    assert _targets(sg.segment_rows(g, rules, how="join")) == got


def test_lookup_fill_salted_equals_plain(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 2 == 0, F.lit("1390000")).otherwise(F.col("id").cast("string")).alias("mobile"),
        F.when(F.col("id") % 3 == 0, F.lit(" ")).otherwise(F.lit("kept")).alias("city_short"))
    dim = spark.createDataFrame([("1390000", "X"), ("1", "Y")], "tel string, city_short string")
    key = F.substring("mobile", 1, 7)
    plain = sorted(map(tuple, sg.lookup_fill(df, dim, key, "tel", "city_short").collect()))
    salted = sorted(map(tuple, sg.lookup_fill(df, dim, key, "tel", "city_short", hot_rows=100).collect()))
    assert salted == plain and len(plain) == 20000
