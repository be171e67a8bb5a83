"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""
import pytest

from recunify.checks.compare import compare
from recunify.checks.oracle import SQL
from recunify.plans.queries import QUERIES

from conftest import SF01


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck01, name):
    assert name in SQL, f"{name} has no oracle SQL"
    r = compare(QUERIES[name](spark, SF01), duck01, SQL[name])
    assert r["columns_match"], r
    assert r["rows_match"], r
    assert r["values_match"], r


def test_entry_contract(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(e.queries()) == set(QUERIES) | set(e.CORPUS_QUERIES)


def test_survey_prototype_counts(spark):
    # counts the survey prototyped independently at sf0.01
    expect = {"scan_prefix": 1981, "tier_union": 7986, "fill_any": 150, "fill_latest": 150,
              "golden_record": 150, "latest_dedup": 750, "hot_rows": 4680, "cold_rows": 5320,
              "align_layout": 11500, "range_text": 2000, "two_groups": 13978,
              "prefix_fill": 1500, "drop_blank": 5333, "ingest_report": 5,
              "partition_manifest": 150, "overwrite_full": 2006}
    for name, n in expect.items():
        assert QUERIES[name](spark, SF01).count() == n, name


def test_two_groups_repeat_total_copies(spark):
    from pyspark.sql import functions as F
    df = QUERIES["two_groups_repeat"](spark, SF01)
    assert df.agg(F.sum("copies")).first()[0] == 20672
