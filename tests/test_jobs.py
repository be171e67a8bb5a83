from pyspark.sql import functions as F

from recunify.operators import survivorship as sv
from recunify.plans import jobs
from recunify.plans.queries import CONTACT_ORDER, QUERIES
from recunify.session import scratch_path
from recunify.sources import standins as si

from conftest import SF001, SF01


def _filter_rows(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).collect()), key=str)


def test_daily_suppression_job_is_idempotent(spark):
    path = scratch_path(spark, "filter_table")
    o, c = si.outcomes(spark, SF01), si.calls(spark, SF01)
    n1 = jobs.daily_suppression_job(spark, o, c, path, "2000-06-30")
    n2 = jobs.daily_suppression_job(spark, o, c, path, "2000-07-31")
    t1 = _filter_rows(spark, path)
    assert len(t1) == n1 + n2 > n2 > 0
    # re-running the first day replaces its partition with the same rows
    assert jobs.daily_suppression_job(spark, o, c, path, "2000-06-30") == n1
    assert _filter_rows(spark, path) == t1
    # day two saw day one's rows as history: nothing suppressed twice
    days = spark.read.parquet(path).groupBy("mobile", "source").agg(
        F.countDistinct("update_day").alias("d"))
    assert days.where("d > 1 AND source <> 'customer_filter_refuse'").count() == 0
    # the feed's own columns come along, and the table has the three partition columns
    assert set(o.columns) | {"event_day", "source_type", "update_time"} == set(spark.read.parquet(path).columns)
    # a rerun of a day that finds nothing clears the day, and only that
    assert jobs.daily_suppression_job(spark, o.limit(0), c.limit(0), path, "2000-07-31") == 0
    left = spark.read.parquet(path)
    assert left.count() == n1 and {str(r.update_day) for r in left.select("update_day").distinct().collect()} == {"2000-06-30"}


def test_daily_suppression_job_fails_on_a_broken_history(spark):
    import pytest
    path = scratch_path(spark, "broken_filter")
    spark.createDataFrame([("not parquet",)], "value string").write.text(
        path + "/source_type=OPERATOR_customer/update_day=2000-01-01/update_time=20_00_00")
    with pytest.raises(Exception):
        jobs.daily_suppression_job(spark, si.outcomes(spark, SF001), si.calls(spark, SF001), path, "2000-06-30")


def test_daily_suppression_job_counts_only_its_own_family(spark):
    from recunify.sinks.writers import overwrite_partitions
    path = scratch_path(spark, "families")
    o, c = si.outcomes(spark, SF01), si.calls(spark, SF01).limit(0)
    n = jobs.daily_suppression_job(spark, o, c, path, "2000-06-30")
    rows = spark.read.parquet(path)
    other = rows.withColumn("source_type", F.lit("BEHAVIOR_visit")).withColumn("update_day", F.lit("2000-01-01"))
    path2 = scratch_path(spark, "families2")
    overwrite_partitions(other, path2, jobs.SUPPRESSION_PARTITIONS)
    assert jobs.daily_suppression_job(spark, o, c, path2, "2000-06-30") == n
    own = rows.withColumn("update_day", F.lit("2000-01-01"))
    path3 = scratch_path(spark, "families3")
    overwrite_partitions(own, path3, jobs.SUPPRESSION_PARTITIONS)
    assert jobs.daily_suppression_job(spark, o, c, path3, "2000-06-30") < n


def test_archive_cold_falls_back_to_the_feeds_bounds(spark):
    feed = spark.createDataFrame([("1", "", "5", "9", "2024-01-01"), ("2", None, "5", "9", "2024-01-01"),
                                  ("3", "3-6yrs", "5", "9", "2024-01-01"), ("4", "7", "5", "9", "2024-01-01")],
                                 "mobile string, area string, age_start string, age_end string, update_day string")
    layout = ["mobile", "age_start", "age_end", "update_day"]
    got = jobs.archive_cold([{"df": feed, "range": ("area", "age_start", "age_end")}], layout, "2024-02-01", 5)
    assert sorted(tuple(r)[:3] for r in got.collect()) == [
        ("1", "5", "9"), ("2", "5", "9"), ("3", "3", "6"), ("4", "7", None)]
    bare = feed.drop("age_start", "age_end")
    got = jobs.archive_cold([{"df": bare, "range": ("area", "age_start", "age_end")}], layout, "2024-02-01", 5)
    assert sorted(tuple(r)[:3] for r in got.collect())[0] == ("1", "", "")


def test_golden_table_job_round_trip(spark):
    path = scratch_path(spark, "golden")
    rules = {1: sv.ANY, 2: sv.LATEST, 3: sv.LATEST}
    jobs.golden_table_job(si.contacts(spark, SF001), path, "contact_id", ["attr_a", "attr_b"],
                          si.CONTACT_TIERS, rules, CONTACT_ORDER, files=3)
    back = spark.read.parquet(path)
    want = QUERIES["golden_record"](spark, SF001)
    assert back.exceptAll(want).count() == 0 and want.exceptAll(back).count() == 0


def test_daily_update_job_end_to_end(spark):
    from recunify.plans.queries import FEED_LAYOUT, WAREHOUSE_LAYOUT
    c = si.contacts(spark, SF001)
    hot_feed = c.select(F.col("contact_id").alias("mobile"), "source_type", "attr_a",
                        F.col("update_day").alias("import_date_day"),
                        F.col("update_time").alias("import_date_time"), "event_id")
    cold_feed = {"df": hot_feed.withColumn("source", F.lit("feed")),
                 "renames": {"update_day": "import_date_day", "update_time": "import_date_time"}}
    paths = {n: scratch_path(spark, n) for n in ("updated", "filter", "behavior", "warehouse")}
    reports = jobs.daily_update_job(
        spark, "2024-01-29", si.outcomes(spark, SF001), si.calls(spark, SF001),
        {"behavior": hot_feed}, [cold_feed], paths,
        order=("import_date_day", "import_date_time", "event_id"), hot_days=14,
        feed_titles=["1-URGENT", "2-HIGH"], feed_codes=si.REASON_BY_TITLE,
        feed_layout=FEED_LAYOUT, warehouse_layout=WAREHOUSE_LAYOUT,
        hot_columns={"behavior": ["mobile", "source_type", "import_date_day", "attr_a"]},
        suppression_params={"call_rules": {"key_length": 2}})
    hot = spark.read.parquet(paths["behavior"])
    assert hot.count() == hot.select("source_type", "mobile").distinct().count() > 0
    assert hot.columns == ["mobile", "source_type", "import_date_day", "attr_a"]
    day = hot.where("import_date_day = '2024-01-29'")
    assert {(r.source_type, r.counts) for r in reports.collect()} == {
        (r.source_type, r["count"]) for r in day.groupBy("source_type").count().collect()} != set()
    wh = spark.read.parquet(paths["warehouse"])
    assert wh.count() == c.where(F.col("update_day") < "2024-01-15").count()


def test_segment_publish_job_writes_each_target(spark):
    root = scratch_path(spark, "seg_pub")
    failed = jobs.segment_publish_job(si.golden_parts(spark, SF001), si.segment_rules(spark),
                             si.target_categories(spark), si.outcomes(spark, SF001),
                             si.closed_deals(spark, SF001), si.nation_prefix_dimension(spark, SF001),
                             F.substring(F.col("mobile").cast("string"), 1, 2), "2001-08-01", root,
                             rows_per_file=20)
    assert failed.count() == 0
    back = spark.read.parquet(root)
    want = QUERIES["publish_segments"](spark, SF001)
    assert back.count() == want.count() > 0
