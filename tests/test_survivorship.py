from pyspark.sql import Window
from pyspark.sql import functions as F

from recunify.operators import survivorship as sv
from recunify.plans.queries import CONTACT_ORDER
from recunify.sources import standins as si
from recunify.sources.readers import read_tiers

from conftest import SF01

SCHEMA = "k string, v string, day string, time string, tb long, tier int, source string, source_type string"


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


EDGE = [
    (None, "x", "2024-01-01", "00_00_00", 1, 2, "a", "A"),        # NULL key: dropped
    ("all_null", None, "2024-01-01", "00_00_00", 2, 2, None, None),
    ("all_null", None, "2024-01-02", "00_00_00", 3, 2, None, None),
    ("mixed", "", "2024-01-02", "00_00_00", 4, 2, "s1", "T"),     # newest is '' ...
    ("mixed", None, "2024-01-03", "00_00_00", 5, 2, "s2", "T"),   # ... newer still NULL
    ("mixed", "old", "2024-01-01", "00_00_00", 6, 2, "s1", "T"),  # older filled wins
    ("tie", "t1", "2024-01-05", "10_00_00", 7, 2, "s", "T"),      # tie on day+time
    ("tie", "t2", "2024-01-05", "10_00_00", 8, 2, "s", "T"),      # tie-break decides
    ("tiers", "low", "2024-01-09", "00_00_00", 9, 1, "l", "L"),
    ("tiers", "", "2024-01-01", "00_00_00", 10, 3, "h", "H"),     # high tier empty
    ("tiers", "mid", "2024-01-01", "00_00_00", 11, 2, "m", "M"),
    ("lowonly", "", "2024-01-01", "00_00_00", 12, 1, "x", "X"),
    ("lowonly", None, "2024-01-02", "00_00_00", 13, 1, "y", "X"),
]
RULES = {1: sv.ANY, 2: sv.LATEST, 3: sv.LATEST}
ORDER = ("day", "time", "tb")


def test_edge_rows_single_pass(spark):
    out = {r.k: r for r in sv.golden_record(_df(spark, EDGE), "k", ["v"], "tier", RULES, ORDER).collect()}
    assert None not in out
    assert out["all_null"].v is None and out["all_null"].source == ""
    assert out["mixed"].v == "old"
    assert out["tie"].v == "t2"
    assert out["tiers"].v == "mid"            # tier 3 empty, tier 2 filled
    assert out["tiers"].source == "h,l,m"
    assert out["lowonly"].v == ""             # W1: '' beats NULL


def test_single_pass_equals_tiered(spark):
    for df, key, cols, order in [
        (_df(spark, EDGE), "k", ["v"], ORDER),
        (read_tiers(si.contacts(spark, SF01), "source_type", si.CONTACT_TIERS), "contact_id",
         ["attr_a", "attr_b"], CONTACT_ORDER),
    ]:
        a = sv.golden_record(df, key, cols, "tier", RULES, order, single_pass=True)
        b = sv.golden_record(df, key, cols, "tier", RULES, order, single_pass=False)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_latest_equals_window_form(spark):
    c = si.contacts(spark, SF01)
    agg = sv.golden_tier(c, "contact_id", ["attr_b"], sv.LATEST, CONTACT_ORDER, source_cols=())
    flag = F.when(F.col("attr_b").isNull() | (F.col("attr_b") == ""), 0).otherwise(1)
    w = Window.partitionBy("contact_id").orderBy(flag.desc(), *[F.col(o).desc() for o in CONTACT_ORDER])
    win = c.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("contact_id", "attr_b")
    assert agg.exceptAll(win).count() == 0 and win.exceptAll(agg).count() == 0


def test_any_prefers_empty_string_to_null(spark):
    df = _df(spark, [("a", None, "d", "t", 1, 1, "s", "T"), ("a", "", "d", "t", 2, 1, "s", "T")])
    assert sv.golden_tier(df, "k", ["v"], sv.ANY, source_cols=()).first().v == ""


def test_empty_mapping_is_an_error(spark):
    import pytest
    with pytest.raises(ValueError):
        sv.golden_tier(_df(spark, EDGE), "k", [], sv.ANY)


def test_flattened_provenance(spark):
    rows = [("k", "v", "2024-01-01", "00_00_00", 1, 1, "a", "T"),
            ("k", "v", "2024-01-01", "00_00_00", 2, 1, "b", "T"),
            ("k", "v", "2024-01-02", "00_00_00", 3, 2, "a", "T")]
    df = _df(spark, rows)
    lit = sv.golden_record(df, "k", ["v"], "tier", RULES, ORDER).first()
    assert lit.source == "a,a,b"               # tier strings "a,b" and "a", set-ed whole
    for single in (True, False):
        flat = sv.golden_record(df, "k", ["v"], "tier", RULES, ORDER, single_pass=single,
                                flatten_provenance=True).first()
        assert flat.source == "a,b" and flat.source_type == "T" and flat.v == "v"
