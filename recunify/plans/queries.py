"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads whole driver tables through the stand-ins in
``recunify.sources.standins`` and runs one library operator (or a
composite job) on them.  The matching DuckDB SQL lives in
``recunify.checks.oracle``; column names agree one to one.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recunify.functions.blank import is_blank, is_blank_trim
from recunify.functions.codes import code_of
from recunify.functions.dates import shift_day
from recunify.functions.ranges import range_bounds
from recunify.operators import catalog, changes, dedup, distinct, overlap, report, segments as sg, timeline
from recunify.operators import suppression as sp, survivorship as sv
from recunify.plans import jobs
from recunify.session import scratch_path
from recunify.sinks import writers
from recunify.sources import standins as si
from recunify.sources.feeds import SOURCE_TYPE, call_rows, outcome_rows
from recunify.streaming.latest import latest_rows, stream_latest
from recunify.sources.readers import (align, history_keys, literal_frame, read_table, read_tiers,
                                      scan_prefix, union_all)

# ---- fixed parameters of the stand-in queries ----------------------------
CONTACTS_AS_OF = "2024-01-31"     # events cover 2024-01-01 .. 2024-01-30
HOT_DAYS = 20                     # hot window of the dedup feeds
SPLIT_DAYS = 14                   # hot/cold split used by hot_rows/cold_rows
CONTACT_ORDER = ("update_day", "update_time", "event_id")
SUPPRESS_AS_OF = "2000-06-30"     # daily suppression job day (orders stand-in)
ACTIVE_AS_OF = "2001-08-01"       # segment publishing day (last order day)
ACTIVE_CATEGORY = "P"             # category of the published target
SESSION_GAP = 12 * 3600           # seconds without a contact that end a session
CALL_WINDOWS = (14, 60)           # days before a call in which calls are counted
DISTINCT_RANGES = (("2024-01-01", "2024-01-30"), ("2024-01-08", "2024-01-21"), ("2024-01-15", "2024-01-15"))
# --------------------------------------------------------------------------

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn=None, *, name: str | None = None):
    def register(f):
        QUERIES[name or f.__name__] = f
        return f
    return register(fn) if fn is not None else register


def _contacts(spark, d):
    return si.contacts(spark, d)


def _tiered_contacts(spark, d):
    return read_tiers(_contacts(spark, d), "source_type", si.CONTACT_TIERS)


# ---------------------------------------------------------------- sources

@query(name="scan_prefix")
def scan_prefix_q(spark, d):
    return scan_prefix(_contacts(spark, d), "source_type", "pu")


@query
def tier_union(spark, d):
    tiers = {1: ("sig",), 2: ("view", "cli"), 3: ("pur",)}
    return read_tiers(_contacts(spark, d), "source_type", tiers)


# ---------------------------------------------------------------- survivorship

@query
def fill_any(spark, d):
    return sv.golden_tier(_contacts(spark, d), "contact_id", ["attr_a", "attr_b"],
                          sv.ANY, source_cols=())


@query
def fill_latest(spark, d):
    return sv.golden_tier(_contacts(spark, d), "contact_id", ["attr_a"], sv.LATEST,
                          order=CONTACT_ORDER, source_cols=())


@query
def fill_priority(spark, d):
    per_tier = (_tiered_contacts(spark, d).groupBy("contact_id", "tier")
                .agg(sv.any_value("attr_b").alias("attr_b")))
    return sv.merge_tiers(per_tier, "contact_id", ["attr_b"], "tier", source_cols=())


@query
def provenance(spark, d):
    return (_contacts(spark, d).groupBy("contact_id")
            .agg(sv.provenance("source").alias("source"),
                 sv.provenance("source_type").alias("source_type")))


@query
def golden_record(spark, d):
    rules = {1: sv.ANY, 2: sv.LATEST, 3: sv.LATEST}
    return sv.golden_record(_tiered_contacts(spark, d), "contact_id", ["attr_a", "attr_b"],
                            "tier", rules, order=CONTACT_ORDER)


# ---------------------------------------------------------------- dedup / hot-cold

@query
def latest_dedup(spark, d):
    return dedup.latest_dedup(_contacts(spark, d), ["source_type", "contact_id"],
                              CONTACT_ORDER, day_col="update_day",
                              as_of=CONTACTS_AS_OF, days=HOT_DAYS)


@query
def hot_rows(spark, d):
    return dedup.hot(_contacts(spark, d), "update_day", shift_day(CONTACTS_AS_OF, -SPLIT_DAYS))


@query
def cold_rows(spark, d):
    return dedup.cold(_contacts(spark, d), "update_day", shift_day(CONTACTS_AS_OF, -SPLIT_DAYS))


@query
def drop_blank(spark, d):
    c = _contacts(spark, d)
    return c.where(~is_blank_trim("attr_a"))


@query
def partition_manifest(spark, d):
    return writers.partition_manifest(_contacts(spark, d), "dw.contacts",
                                      ["source_type", "update_day"])


@query
def partition_manifest_odd(spark, d):
    """K3; one source is NULL, one is empty, one has a quote and a backslash."""
    odd = (F.when(F.col("source_type") == "error", F.lit(None)).when(F.col("source_type") == "signup", "")
           .when(F.col("source_type") == "view", "it's \\ a view").otherwise(F.col("source_type")))
    return writers.partition_manifest(_contacts(spark, d).withColumn("source_type", odd), "dw.contacts",
                                      ["source_type", "update_day"])


# ---------------------------------------------------------------- suppression

@query(name="history_keys")
def history_keys_q(spark, d):
    return history_keys(si.outcomes(spark, d), "mobile", "source", sp.REASON_AGE,
                        "update_day", before="2001-01-01", since="2000-10-01")


@query(name="anti_history")
def anti_history_q(spark, d):
    refused = history_keys(si.suppression_history(spark, d), "mobile", "source", sp.REASON_REFUSE,
                           "update_day", before="2002-01-01", source_type=SOURCE_TYPE)
    return sp.anti_history(si.customer_contacts(spark, d), refused, "mobile")


@query
def two_groups(spark, d):
    return sp.seen_in_two_groups(si.outcomes(spark, d), ["category", "mobile"], "title")


@query
def two_groups_repeat(spark, d):
    return sp.seen_in_two_groups_copies(si.outcomes(spark, d), ["category", "mobile"], "title")


@query
def reason_code(spark, d):
    feed = outcome_rows(si.outcomes(spark, d), "1998-10-01", "1998-10-31", ["1-URGENT", "2-HIGH", "3-MEDIUM"],
                        floor="1998-10-05")
    return feed.withColumn("source", code_of("title", si.REASON_BY_TITLE))


@query
def short_calls(spark, d):
    return call_rows(si.calls(spark, d), "1999-01-01", "1999-01-14", 5, key_length=3)


@query
def suppression_candidates(spark, d):
    return sp.suppression_candidates(si.outcomes(spark, d), si.suppression_history(spark, d), si.calls(spark, d),
                                     SUPPRESS_AS_OF)


@query
def active_suppression(spark, d):
    return sp.active_suppression(si.outcomes(spark, d), si.closed_deals(spark, d),
                                 ACTIVE_AS_OF, category_value=ACTIVE_CATEGORY)


# ---------------------------------------------------------------- segments

def _segments(spark, d, how="columns"):
    return sg.segment_rows(si.golden_parts(spark, d), si.segment_rules(spark), how=how)


@query
def segment_rules(spark, d):
    return _segments(spark, d)


@query
def segment_rules_join(spark, d):
    """The same targets rule by rule."""
    return _segments(spark, d, how="join")


def _all_target_suppression(spark, d):
    return sp.active_suppression_parts(si.outcomes(spark, d), si.closed_deals(spark, d),
                                       ACTIVE_AS_OF)


@query
def suppress_segment(spark, d):
    segs = _segments(spark, d)
    with_category = segs.join(si.target_categories(spark), "targettable", "left")
    return sp.suppress(with_category, _all_target_suppression(spark, d)).select(*segs.columns)


@query
def prefix_fill(spark, d):
    c = si.customer_contacts(spark, d)
    return sg.lookup_fill(c, si.prefix_dimension(spark, d), F.substring("user_name", 1, 15),
                          "tel", "city_short")


@query
def publish_segments(spark, d):
    key_prefix = F.substring(F.col("mobile").cast("string"), 1, 2)
    return jobs.segment_job(si.golden_parts(spark, d), si.segment_rules(spark),
                            si.target_categories(spark), si.outcomes(spark, d),
                            si.closed_deals(spark, d), si.nation_prefix_dimension(spark, d),
                            key_prefix, ACTIVE_AS_OF)


# ---------------------------------------------------------------- catalog

@query
def targets(spark, d):
    instructs = read_table(spark, d, "part").select(F.col("p_brand").alias("targetdatabase"),
                                                    F.col("p_type").alias("targettable"))
    return catalog.targets(instructs, "A|P", exclude=["LARGE"])


@query
def table_catalog(spark, d):
    return catalog.table_catalog(si.table_metadata(spark, d), si.column_metadata(spark, d))


@query
def render_ddl(spark, d):
    return catalog.render_ddl(si.table_metadata(spark, d), si.column_metadata(spark, d),
                              root="/warehouse")


@query
def seed_columns(spark, d):
    cols = si.column_metadata(spark, d)
    template = cols.where(F.col("dbtable") == "dw_cust.cust_0")
    tables = catalog.with_dbtable(si.table_metadata(spark, d)).select("dbtable", "tablename")
    return catalog.seed_columns(template, tables, exclude=["cust_1", "dw_cust.cust_2"])


@query
def seed_columns_written(spark, d):
    """K5: the seeded metadata written as one partition per table and read again."""
    path = scratch_path(spark, "seed_columns")
    seeded = seed_columns(spark, d)
    catalog.write_column_metadata(seeded, path)
    return writers.read_partitions(spark, path, seeded.schema, many="dbtable")


@query
def created_tables(spark, d):
    """K6: the rendered statements run, and the columns that the catalog then lists.

    A table per nation, a column per customer of it.  The tables live in a
    database of their own below the scratch folder, which goes at the end."""
    path = scratch_path(spark, "created_tables")
    db = f"created_{path.rsplit('-', 1)[-1]}"
    tables, columns = si.nation_tables(spark, d, db), si.nation_columns(spark, d, db)
    spark.sql(f"CREATE DATABASE {db} LOCATION '{path}/db'")
    try:
        catalog.create_tables(spark, catalog.render_ddl(tables, columns, root=path, dialect="spark"))
        found = catalog.listed_columns(spark, db)
    finally:
        spark.sql(f"DROP DATABASE {db} CASCADE")
    return found


# ---------------------------------------------------------------- report / layout

@query
def ingest_report(spark, d):
    return report.ingest_report(_contacts(spark, d), "2024-01-15", key="contact_id")


@query
def range_text(spark, d):
    p = read_table(spark, d, "part")
    text = F.concat(p.p_size.cast("string"), F.lit("-"), (p.p_size + 3).cast("string"), F.lit("yrs"))
    p = p.select("p_partkey", text.alias("age_text"))
    start, end = range_bounds("age_text")
    return p.select("p_partkey", "age_text", start.alias("age_start"), end.alias("age_end"))


LAYOUT = ["mobile", "user_name", "source_type", "update_day"]


@query
def align_layout(spark, d):
    ev = read_table(spark, d, "events")
    cu = read_table(spark, d, "customer")
    a = align(ev, LAYOUT, renames={"mobile": "user_id", "source_type": "event_type",
                                   "update_day": F.date_format("ts", "yyyy-MM-dd")})
    b = align(cu, LAYOUT, renames={"mobile": "c_custkey", "user_name": "c_name"},
              constants={"source_type": "customer", "update_day": "2024-01-01"})
    return union_all([a, b])


WAREHOUSE_LAYOUT = ["mobile", "user_name", "age", "age_start", "age_end", "source",
                    "source_type", "update_day", "update_time"]


@query
def archive_cold(spark, d):
    c = _contacts(spark, d)
    behavior = c.where(F.col("source_type").isin("view", "click"))
    testing = c.where(F.col("source_type").isin("signup", "error", "purchase"))
    # range text with one bound, two bounds or none; the feed has bounds of its own
    text = F.when(is_blank(F.col("attr_b")) | (F.col("event_id") % 2 == 0), F.col("attr_b")).otherwise(
        F.concat("attr_b", F.lit("~"), F.col("contact_id").cast("string"), F.lit("yrs")))
    testing = testing.withColumns({"age_text": text, "age_start": F.substring("update_day", 9, 2),
                                   "age_end": F.lit("99")})
    feeds = [
        {"df": behavior, "renames": {"mobile": "contact_id"}},
        {"df": testing, "renames": {"mobile": "contact_id", "age": "attr_b"},
         "range": ("age_text", "age_start", "age_end")},
    ]
    return jobs.archive_cold(feeds, WAREHOUSE_LAYOUT, CONTACTS_AS_OF, SPLIT_DAYS)


# ---------------------------------------------------------------- sinks (round trips)

@query
def overwrite_full(spark, d):
    path = scratch_path(spark, "overwrite_full")
    c = _contacts(spark, d)
    writers.overwrite_full(c, path)
    writers.overwrite_full(c.where(F.col("source_type") == "click"), path)
    return spark.read.parquet(path)


@query
def overwrite_partitions(spark, d):
    path = scratch_path(spark, "overwrite_partitions")
    half_day = F.when(F.substring("update_time", 1, 2) < "12", F.lit("00_00_00")).otherwise(F.lit("12_00_00"))
    c = _contacts(spark, d).withColumn("update_time", half_day)
    partitions = ["source_type", "update_day", "update_time"]
    writers.overwrite_partitions(c, path, partitions, rows_per_file=1000)
    newer = c.where(F.col("source_type").isin("click", "view") & (F.col("update_day") >= "2024-01-20")
                    & ~is_blank_trim("attr_a"))
    writers.overwrite_partitions(newer, path, partitions, manifest=("dw.contacts", f"{path}-manifest"))
    return writers.read_partitions(spark, path, c.schema)


@query
def manifest_written(spark, d):
    """K3 with K2: the statements written beside a partition overwrite."""
    path = scratch_path(spark, "manifest_written")
    writers.overwrite_partitions(_contacts(spark, d), path, ["source_type"], manifest=("dw.contacts", f"{path}-manifest"))
    return spark.read.text(f"{path}-manifest").withColumnRenamed("value", "partition")


@query
def stage_round_trip(spark, d):
    """The golden record staged in the shared folder and read again."""
    return writers.stage(golden_record(spark, d), "golden", how="parquet")


# ---------------------------------------------------------------- feed / metadata-driven

FEED_LAYOUT = ["mobile", "user_name", "category", "project", "title", "source",
               "source_type", "update_day", "update_time"]


@query
def outcome_feed(spark, d):
    return jobs.outcome_feed(si.outcomes(spark, d), "1998-10-01", "1998-10-07",
                             ["1-URGENT", "2-HIGH"], si.REASON_BY_TITLE, FEED_LAYOUT)


@query
def column_map(spark, d):
    # a rename onto an excluded name stays: the warehouse names decide
    meta = si.column_metadata(spark, d)
    renamed = F.when(F.col("buiscolrank").cast("int") % 7 == 3, F.lit("mobile")).otherwise(F.col("buiscolname"))
    return catalog.column_map(meta.withColumn("buiscolname", renamed), "dw_cust.cust_1")


def _contact_column_meta(spark):
    # column metadata of the golden contacts table: warehouse name -> target name
    return literal_frame(
        spark,
        [("golden.contacts", "attr_a", "first_attr", "string", "first", 1),
         ("golden.contacts", "attr_b", "second_attr", "string", "second", 2),
         ("golden.contacts", "source", "source", "string", "sources", 3)],
        "dbtable string, dswhcolname string, buiscolname string, buiscoltype string, "
        "buiscolcomment string, buiscolrank int")


@query
def golden_mapped(spark, d):
    mapping = jobs.columns_from_metadata(
        catalog.column_map(_contact_column_meta(spark), "golden.contacts"))
    rules = {1: sv.ANY, 2: sv.LATEST, 3: sv.LATEST}
    return jobs.golden_job(_contacts(spark, d), "contact_id", mapping, si.CONTACT_TIERS,
                           rules, CONTACT_ORDER)


@query
def latest_dedup_mapped(spark, d):
    """C3 with the P2 projection: output columns come from column metadata
    (target table's columns in rank order, plus the key and source columns)."""
    meta = catalog.column_map(_contact_column_meta(spark), "golden.contacts")
    mapped = list(jobs.columns_from_metadata(meta).values())
    cols = ["contact_id", "source_type"] + mapped + ["update_day"]
    return dedup.latest_dedup(_contacts(spark, d), ["source_type", "contact_id"], CONTACT_ORDER,
                              day_col="update_day", as_of=CONTACTS_AS_OF, days=HOT_DAYS, columns=cols)


# ---------------------------------------------------------------- time and ranges

@query
def status_at_call(spark, d):
    """The suppression row in force for a key at the day of each call."""
    return timeline.as_of_join(si.calls(spark, d), si.suppression_history(spark, d), "mobile", "update_day",
                               ["source", "source_type"], since="since")


@query
def contact_sessions(spark, d):
    """Sessions of each contact."""
    rows = timeline.sessions(si.contact_times(spark, d), "contact_id", "contact_time", SESSION_GAP)
    return timeline.session_totals(rows, "contact_id", "contact_time", SESSION_GAP)


@query
def contact_gaps(spark, d):
    """Each contact with the seconds since the one before and its session."""
    return timeline.sessions(si.contact_times(spark, d), "contact_id", "contact_time", SESSION_GAP)


@query
def calls_in_last_days(spark, d):
    """At each call, the key's calls and seconds of the last 14 and 60 days."""
    return timeline.rolling(si.calls(spark, d), "mobile", "update_day", CALL_WINDOWS,
                            {"seconds": F.col("duration_time").try_cast("long")})


@query
def overlapping_ranges(spark, d):
    """Golden age ranges against rule ranges."""
    return overlap.overlap_join(si.age_ranges(spark, d), si.range_rules(spark, d), "age_from", "age_to", "rule_from", "rule_to")


# ---------------------------------------------------------------- distinct keys

@query
def distinct_by_bitmaps(spark, d):
    """Exact distinct keys per source of three day ranges, from one table of daily bitmaps."""
    daily = writers.stage(distinct.daily_bitmaps(_contacts(spark, d), ["source_type"], "update_day", "contact_id"),
                          "bitmaps", how="parquet")
    return union_all([distinct.exact_distinct(daily, ["source_type"], "update_day", since, until)
                      .select("source_type", F.lit(since).alias("since"), F.lit(until).alias("until"), "n_keys")
                      for since, until in DISTINCT_RANGES])


@query
def distinct_by_sketches(spark, d):
    """The same from daily sketches; whether each estimate is within 5 % of the exact number."""
    daily = writers.stage(distinct.daily_sketches(_contacts(spark, d), ["source_type"], "update_day", "contact_id"),
                          "sketches", how="parquet")
    estimates = union_all([distinct.sketched_distinct(daily, ["source_type"], "update_day", since, until, "estimate")
                           .select("source_type", F.lit(since).alias("since"), F.lit(until).alias("until"), "estimate")
                           for since, until in DISTINCT_RANGES])
    close = F.abs(F.col("estimate") - F.col("n_keys")) <= 0.05 * F.col("n_keys")
    return (estimates.join(distinct_by_bitmaps(spark, d), ["source_type", "since", "until"])
            .select("source_type", "since", "until", "n_keys", close.alias("within_5_percent")))


@query
def ingest_summary(spark, d):
    """Rows and distinct keys by day and source, day, source, and in total; some sources are NULL."""
    c = _contacts(spark, d).withColumn("source_type", F.when(F.col("source_type") != "error", F.col("source_type")))
    return report.ingest_summary(c, key="contact_id")


# ---------------------------------------------------------------- changes, maps, state

def _two_golden(spark, d):
    c = _contacts(spark, d).select("contact_id", "source_type", "attr_b", "update_day")
    return (c.where(F.col("update_day") < "2024-01-20").drop("update_day"),
            c.where(F.col("update_day") >= "2024-01-05").drop("update_day"))


@query
def golden_changes(spark, d):
    """EXCEPT ALL both ways in one pass: the change set of two tables with repeated rows and NULLs."""
    return changes.change_set(*_two_golden(spark, d))


@query
def golden_common(spark, d):
    """INTERSECT ALL."""
    return changes.common_rows(*_two_golden(spark, d))


@query
def merged_attributes(spark, d):
    """W2 over a map: the latest filled value of every attribute, listed from the merged maps."""
    merged = changes.merge_maps(si.contact_attributes(spark, d), "contact_id", "attributes", CONTACT_ORDER)
    return merged.select("contact_id", F.explode("attributes").alias("name", "value"))


@query
def streamed_latest(spark, d):
    """W4 as keyed state: contacts arrive as files in no order of time, the table is read at the end."""
    source, sink, state = (scratch_path(spark, f"latest-{x}") for x in ("in", "out", "state"))
    c = _contacts(spark, d)
    c.repartition(4, F.xxhash64("event_id")).write.parquet(source)
    keys = ["source_type", "contact_id"]
    stream_latest(spark, source, c.schema, sink, state, keys, CONTACT_ORDER, days=HOT_DAYS,
                  max_files_per_trigger=2).awaitTermination()
    return latest_rows(spark, sink, c.schema, keys, CONTACT_ORDER, CONTACTS_AS_OF, days=HOT_DAYS)
