from recunify.operators import dedup
from recunify.plans import jobs
from recunify.sources import standins as si
from recunify.sources.readers import literal_frame


def test_hot_cold_partition_except_null_days(spark):
    df = literal_frame(spark, [("a", "2024-01-01"), ("b", "2024-03-01"), ("c", None)], "k string, d string")
    hot = {r.k for r in dedup.hot(df, "d", "2024-02-01").collect()}
    cold = {r.k for r in dedup.cold(df, "d", "2024-02-01").collect()}
    assert hot == {"b"} and cold == {"a"}          # NULL day in neither


def test_latest_dedup_keeps_whole_newest_row(spark):
    df = literal_frame(spark, [
        ("t", "k", "2024-04-01", "10_00_00", "old"),
        ("t", "k", "2024-04-02", "09_00_00", "new"),
        ("t", "k", "2024-01-01", "23_00_00", "cold"),     # outside the 60-day window
        ("u", "k", "2024-04-01", "10_00_00", "other type"),
    ], "source_type string, mobile string, import_date_day string, import_date_time string, v string")
    out = dedup.latest_dedup(df, ["source_type", "mobile"], ["import_date_day", "import_date_time"],
                             day_col="import_date_day", as_of="2024-04-30", days=60)
    assert sorted((r.source_type, r.v) for r in out.collect()) == [("t", "new"), ("u", "other type")]


def test_outcome_feed_drops_padded_titles(spark):
    o = literal_frame(spark, [
        (1, "F", 10, "1-URGENT", "2024-04-01"),
        (2, "F", 11, " 1-URGENT", "2024-04-01"),          # padded: the IN filter is untrimmed
        (3, "F", 12, "3-MEDIUM", "2024-04-01"),           # not a feed title
        (4, "F", 13, "2-HIGH", "2024-04-02"),             # other day
    ], "mobile bigint, category string, project bigint, title string, update_day string")
    feed = jobs.outcome_feed(o, "2024-04-01", "2024-04-01", ["1-URGENT", "2-HIGH"], si.REASON_BY_TITLE,
                             ["mobile", "user_name", "title", "source", "source_type", "update_day", "update_time"])
    rows = [r.asDict() for r in feed.collect()]
    assert rows == [{"mobile": 1, "user_name": "", "title": "1-URGENT", "source": "customer_filter_child",
                     "source_type": jobs.SOURCE_TYPE, "update_day": "2024-04-01",
                     "update_time": jobs.UPDATE_TIME}]
