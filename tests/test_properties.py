"""Property tests: the one-pass rewrites equal the literal multi-pass forms."""
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from recunify.operators import suppression as sp
from recunify.operators import survivorship as sv

VALUES = st.sampled_from([None, "", "a", "b", "zz"])
ROW = st.tuples(st.sampled_from(["k1", "k2", "k3"]), VALUES, VALUES,
                st.sampled_from(["2024-01-01", "2024-01-02", None]),
                st.sampled_from(["00_00_00", "12_00_00"]),
                st.sampled_from([1, 2, 3]), st.sampled_from(["s1", "s2", None]))
SCHEMA = "k string, a string, b string, day string, time string, tier int, source string"
RULES = {1: sv.ANY, 2: sv.LATEST, 3: sv.LATEST}


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(ROW, min_size=1, max_size=25))
def test_golden_single_pass_equals_tiered(spark, rows):
    rows = [r + (i,) for i, r in enumerate(rows)]          # unique tie-break
    df = spark.createDataFrame(rows, SCHEMA + ", tb long")
    order = ("day", "time", "tb")
    one = sv.golden_record(df, "k", ["a", "b"], "tier", RULES, order, source_cols=("source",))
    many = sv.golden_record(df, "k", ["a", "b"], "tier", RULES, order, source_cols=("source",),
                            single_pass=False)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2"]), st.sampled_from([None, "p", "q", "r"])),
                min_size=1, max_size=20))
def test_two_groups_equals_dense_rank(spark, rows):
    df = spark.createDataFrame([r + (i,) for i, r in enumerate(rows)], "g string, p string, id int")
    w = Window.partitionBy("g").orderBy(F.col("p").asc_nulls_first())
    r2 = df.withColumn("dr", F.dense_rank().over(w)).where("dr = 2").select("g")
    lit = df.join(r2, "g")
    want_semi = sorted({r.id for r in lit.collect()})
    got = sorted(r.id for r in sp.seen_in_two_groups(df, ["g"], "p").collect())
    assert got == want_semi
    want_copies = {}
    for r in lit.collect():
        want_copies[r.id] = want_copies.get(r.id, 0) + 1
    got_copies = {r.id: r.copies for r in sp.seen_in_two_groups_copies(df, ["g"], "p").collect()}
    assert got_copies == want_copies


def test_hot_key_third_of_rows(spark):
    # one key holds a third of all rows: results equal, and the aggregation
    # is partial before the shuffle (the hot key never travels as one group)
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 1000).cast("string")).alias("k"),
        F.when(F.col("id") % 5 == 0, F.lit("")).otherwise((F.col("id") % 97).cast("string")).alias("a"),
        F.lit(None).cast("string").alias("b"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")),
                      "yyyy-MM-dd").alias("day"),
        F.lit("00_00_00").alias("time"),
        ((F.col("id") % 3) + 1).cast("int").alias("tier"),
        (F.col("id") % 4).cast("string").alias("source"),
        F.col("id").alias("tb"))
    order = ("day", "time", "tb")
    one = sv.golden_record(df, "k", ["a", "b"], "tier", RULES, order, source_cols=("source",))
    many = sv.golden_record(df, "k", ["a", "b"], "tier", RULES, order, source_cols=("source",),
                            single_pass=False)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        one.explain()
    plan = buf.getvalue()
    assert "partial_max(" in plan and plan.count("Exchange hashpartitioning") == 1


def test_hot_group_is_salted_in_the_join_back(spark):
    """A group holding a third of the rows is spread over one join key for each
    hot_rows of them in the join back, with the same result as the plain join."""
    n = 60000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("g"),
        (F.col("id") % 7).cast("string").alias("p"), F.col("id"))
    salted = sp.seen_in_two_groups(df, ["g"], "p", hot_rows=1000)
    plain = sp.seen_in_two_groups(df, ["g"], "p", hot_rows=None)
    assert sorted(r.id for r in salted.collect()) == sorted(r.id for r in plain.collect())
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        salted.explain()
    assert "__salt" in buf.getvalue()
    # 20,000 rows of the hot group, 1,000 to a salt; its key is copied to every salt
    keys = sp._two(sp._group_stats(df, ["g"], "p")).select("g", "__n")
    tagged = df.withColumn("v", F.lit(1))
    spread = sp.salted_join(tagged, keys.select("g"), ["g"], "inner", keys, 1000)
    assert spread.count() == plain.count()
    hot = keys.where("__n > 1000").select(F.ceil(F.col("__n") / 1000).alias("s")).collect()
    assert [r.s for r in hot] == [20]
    copies = sp.seen_in_two_groups_copies(df, ["g"], "p", hot_rows=1000)
    copies_plain = sp.seen_in_two_groups_copies(df, ["g"], "p", hot_rows=None)
    assert sorted(map(tuple, copies.collect())) == sorted(map(tuple, copies_plain.collect()))
