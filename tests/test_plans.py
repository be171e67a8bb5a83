"""Plan-shape checks: the properties the design relies on at scale."""
import contextlib
import io

import pytest

from recunify.plans.queries import QUERIES

from conftest import SF001


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def _exchanges(text):
    return text.count("Exchange hashpartitioning") + text.count("Exchange SinglePartition") + \
        text.count("Exchange RoundRobin")


def test_golden_record_single_shuffle(spark):
    p = _plan(QUERIES["golden_record"](spark, SF001), "simple")
    assert _exchanges(p) == 1, p


@pytest.mark.parametrize("name", ["segment_rules", "segment_rules_join", "publish_segments", "seed_columns"])
def test_rules_meet_rows_by_equi_joins(spark, name):
    p = _plan(QUERIES[name](spark, SF001), "simple")
    assert "NestedLoop" not in p and "Cartesian" not in p, p


def test_two_group_copies_limit_each_group_before_the_shuffle(spark):
    p = _plan(QUERIES["two_groups_repeat"](spark, SF001), "simple")
    assert p.count("WindowGroupLimit") >= 2, p


def test_latest_dedup_uses_partial_group_limit(spark):
    p = _plan(QUERIES["latest_dedup"](spark, SF001), "simple")
    assert p.count("WindowGroupLimit") >= 2, p     # partial (pre-shuffle) + final


def test_filters_reach_the_scan(spark):
    p = _plan(QUERIES["scan_prefix"](spark, SF001), "formatted")
    assert "PushedFilters: [IsNotNull(event_type), StringStartsWith(event_type,pu)]" in p, p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string," in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udfs(spark, name):
    p = _plan(QUERIES[name](spark, SF001), "simple")
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_filters_prune_partitions_on_a_partitioned_warehouse(spark):
    """On the real layout (source_type / update_day partitions, as K2 writes
    it) the prefix scan and the hot-window filter prune directories."""
    from recunify.operators import dedup
    from recunify.session import scratch_path
    from recunify.sinks.writers import overwrite_partitions
    from recunify.sources import standins as si
    from recunify.sources.readers import scan_prefix
    path = scratch_path(spark, "partitioned_wh")
    overwrite_partitions(si.contacts(spark, SF001), path, ["source_type", "update_day"])
    wh = spark.read.parquet(path)
    q = dedup.hot(scan_prefix(wh, "source_type", "pu"), "update_day", "2024-01-17")
    p = _plan(q, "formatted")
    part = [ln for ln in p.splitlines() if ln.startswith("PartitionFilters")][0]
    assert "StartsWith(source_type" in part and "update_day" in part and ">= 2024-01-17" in part, p
    assert q.count() == si.contacts(spark, SF001).where(
        "source_type LIKE 'pu%' AND update_day >= '2024-01-17'").count()
