"""Composite jobs: the reference's three batch programs as DataFrame plans.

Each job takes DataFrames (feeds, metadata) and parameters and returns
DataFrames; writing is a separate, explicit step (``recunify.sinks``), so
one plan can be inspected with ``explain`` or tested without storage.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recunify.functions.dates import shift_day
from recunify.functions.ranges import range_bounds
from recunify.operators import dedup, segments, suppression, survivorship
from recunify.operators.catalog import rank_of
from recunify.sources.feeds import SOURCE_TYPE, UPDATE_TIME, outcome_rows
from recunify.sources.readers import align, read_tiers, union_all


def golden_job(warehouse: DataFrame, key: str, columns, tiers: Mapping[int, Sequence[str]],
               tier_rules: Mapping[int, str], order: Sequence[str],
               source_type: str = "source_type") -> DataFrame:
    """3.1: tiers by source prefix -> one-pass survivorship -> golden rows."""
    tagged = read_tiers(warehouse, source_type, tiers)
    return survivorship.golden_record(tagged, key, columns, "tier", tier_rules, order)


def archive_cold(feeds: Sequence[dict], layout: Sequence[str], as_of: str, days: int,
                 day_col: str = "update_day") -> DataFrame:
    """C4: rows older than ``as_of - days`` from every feed, aligned to the
    warehouse layout and unioned (written back with a partition overwrite).

    Each feed is a dict: ``df``, optional ``renames``, ``constants`` and
    ``range`` = (text column, start name, end name) for range-text parsing;
    where the text is blank, the feed's own start and end columns stand.
    """
    cutoff = shift_day(as_of, -days)
    parts = []
    for f in feeds:
        df = dedup.cold(f["df"], day_col, cutoff)
        renames = dict(f.get("renames", {}))
        if f.get("range"):
            text, start, end = f["range"]
            s, e = range_bounds(text, *[renames.get(c, c if c in df.columns else F.lit("")) for c in (start, end)])
            renames[start], renames[end] = s, e
        parts.append(align(df, layout, renames, f.get("constants")))
    return union_all(parts)


def segment_job(golden: DataFrame, rules: DataFrame, target_categories: DataFrame,
                filter_table: DataFrame, closed: DataFrame, dim: DataFrame,
                dim_key_expr, as_of: str, pattern: str = "", hot_rows: int | None = None) -> DataFrame:
    """3.3: the published rows of every target that matches ``pattern``, in one plan."""
    supp = suppression.active_suppression_parts(filter_table, closed, as_of, hot_rows=hot_rows)
    return segments.publish_segments(golden, rules, target_categories, supp, dim, dim_key_expr,
                                     pattern=pattern, hot_rows=hot_rows)


SUPPRESSION_PARTITIONS = ("source_type", "update_day", "update_time")


def daily_suppression_job(spark, outcomes: DataFrame, calls: DataFrame, filter_path: str,
                          as_of: str, source_type: str = SOURCE_TYPE, update_time: str = UPDATE_TIME,
                          hot_rows: int | None = None, rows_per_file: int | None = None, **params) -> int:
    """3.2 (suppression part): compute day ``as_of``'s new suppression rows
    and write them as one (source_type, update_day, update_time) partition of
    the table at ``filter_path``, which is also the history the job reads.

    Only a path that doesn't exist means that there is no history; any other
    failure to read it fails the job.  History is read with ``update_day <
    as_of`` and only the day's partition is replaced, also by nothing, so
    re-running a day gives the same table.  The result is checkpointed
    (reliably, in the shared checkpoint folder) before the write, so the write
    never reads the files it replaces.  Returns the number of rows written.
    """
    from recunify.sinks.writers import drop_partitions, overwrite_partitions, path_exists, read_partitions, stage
    first = not path_exists(spark, filter_path)
    none = suppression.suppression_candidates(outcomes, outcomes.limit(0).withColumn("source_type", F.lit("")), calls,
                                              as_of, source_type=source_type, update_time=update_time, **params)
    history = none.limit(0) if first else read_partitions(spark, filter_path, none.schema)
    cands = suppression.suppression_candidates(outcomes, history.where(F.col("update_day") < as_of), calls, as_of,
                                               source_type=source_type, update_time=update_time, hot_rows=hot_rows,
                                               **params)
    staged = stage(cands, "suppression", how="checkpoint")
    n = staged.count()
    if n or first:
        overwrite_partitions(staged, filter_path, SUPPRESSION_PARTITIONS, rows_per_file)
    else:
        drop_partitions(spark, filter_path, [dict(zip(SUPPRESSION_PARTITIONS, (source_type, as_of, update_time)))])
    return n


def golden_table_job(warehouse: DataFrame, path: str, key: str, columns,
                     tiers: Mapping[int, Sequence[str]], tier_rules: Mapping[int, str],
                     order: Sequence[str], files: int | None = None) -> None:
    """3.1 end to end: golden rows -> full overwrite of the golden table (K1)."""
    from recunify.sinks.writers import overwrite_full
    overwrite_full(golden_job(warehouse, key, columns, tiers, tier_rules, order), path, files)


def outcome_feed(outcomes: DataFrame, since: str, until: str, titles: Sequence[str],
                 codes: Mapping[str, str], layout: Sequence[str],
                 renames: Mapping[str, object] | None = None,
                 day_col: str = "update_day", title_col: str = "title", **feed_rules) -> DataFrame:
    """Outcomes of the day range with one of ``titles``, coded (P4) and
    aligned to the feed layout with the constant partition columns (P1).
    The IN filter compares the raw title, the CASE the trimmed one;
    ``feed_rules`` are further arguments of ``sources.feeds.outcome_rows``."""
    from recunify.functions.codes import code_of
    rows = outcome_rows(outcomes, since, until, titles, day=day_col, title=title_col, **feed_rules)
    rows = rows.withColumn("source", code_of(title_col, codes))
    consts = {"source_type": SOURCE_TYPE, "update_time": UPDATE_TIME}
    return align(rows, layout, renames, consts)


def columns_from_metadata(column_map_df: DataFrame) -> dict[str, str]:
    """{target name: warehouse name} from a column-map DataFrame (the
    column list of one table)."""
    rows = column_map_df.select("dswhcolname", "buiscolname").collect()
    if not rows:
        raise ValueError("no mapped columns for this table")
    return {r.buiscolname: r.dswhcolname for r in rows}


def columns_of_table(column_metadata: DataFrame, dbtable: str) -> list[str]:
    """The columns of one table in rank order, as its metadata lists them."""
    return [r.buiscolname for r in column_metadata.where(F.col("dbtable") == dbtable)
            .orderBy(rank_of()).select("buiscolname").collect()]


def daily_update_job(spark, as_of: str, outcomes: DataFrame, calls: DataFrame,
                     hot_feeds: Mapping[str, DataFrame], cold_feeds: Sequence[dict],
                     paths: Mapping[str, str], key: str = "mobile",
                     order: Sequence[str] = ("import_date_day", "import_date_time"),
                     day_col: str = "import_date_day", hot_days: int = 60,
                     feed_titles: Sequence[str] = (), feed_codes: Mapping[str, str] | None = None,
                     feed_layout: Sequence[str] = (), warehouse_layout: Sequence[str] = (),
                     hot_columns: Mapping[str, Sequence[str]] | None = None,
                     feed_rules: Mapping[str, object] | None = None,
                     suppression_params: Mapping[str, object] | None = None,
                     rows_per_file: int | None = None) -> DataFrame:
    """3.2 end to end for day ``as_of``; returns the ingest reports.

    ``hot_columns`` (feed name -> columns, see ``columns_of_table``) is the P2
    projection of a hot feed, all columns by default; ``feed_rules`` go to
    ``outcome_rows``, ``suppression_params`` (call rules, layout, hot rows) to
    ``daily_suppression_job``.

    * outcome feed of the day -> partition overwrite of ``paths["updated"]``;
    * new suppression rows -> ``paths["filter"]`` (idempotent, see
      ``daily_suppression_job``);
    * each hot feed (name -> rows): latest row per (source_type, key) in the
      last ``hot_days`` days -> full overwrite of ``paths[name]``, then its
      ingest report for the day;
    * cold rows of ``cold_feeds`` -> partition overwrite of
      ``paths["warehouse"]`` (by source_type, update_day, update_time).
    """
    from recunify.operators.report import ingest_report
    from recunify.sinks.writers import overwrite_full, overwrite_partitions
    if feed_titles:
        feed = outcome_feed(outcomes, as_of, as_of, feed_titles, feed_codes or {}, feed_layout, **(feed_rules or {}))
        overwrite_partitions(feed, paths["updated"], SUPPRESSION_PARTITIONS, rows_per_file)
    daily_suppression_job(spark, outcomes, calls, paths["filter"], as_of,
                          **{"rows_per_file": rows_per_file, **(suppression_params or {})})
    reports = []
    for name, rows in hot_feeds.items():
        latest = dedup.latest_dedup(rows, ["source_type", key], order, day_col=day_col,
                                    as_of=as_of, days=hot_days, columns=(hot_columns or {}).get(name))
        overwrite_full(latest, paths[name])
        written = spark.read.parquet(paths[name])
        reports.append(ingest_report(written, as_of, key=key, day_col=day_col)
                       .withColumn("table", F.lit(name)))
    if cold_feeds:
        cold = archive_cold(cold_feeds, warehouse_layout, as_of, hot_days, day_col)
        overwrite_partitions(cold, paths["warehouse"], SUPPRESSION_PARTITIONS, rows_per_file)
    return union_all(reports) if reports else None


def segment_publish_job(golden: DataFrame, rules: DataFrame, target_categories: DataFrame,
                        filter_table: DataFrame, closed: DataFrame, dim: DataFrame,
                        dim_key_expr, as_of: str, root: str, pattern: str = "",
                        rows_per_file: int | None = None, hot_rows: int | None = None) -> DataFrame:
    """3.3 end to end: the rows of every target that matches ``pattern``, one
    folder per target, each replaced (also by nothing).  Returns the targets
    that failed for want of a category; their folders stay as they are."""
    from recunify.sinks.writers import stage
    rules = segments.rules_of_targets(rules, pattern)
    failed = segments.targets_without_category(rules, target_categories)
    target = segments.target_columns(rules)
    published = stage(segment_job(golden, rules, target_categories, filter_table, closed, dim, dim_key_expr, as_of,
                                  hot_rows=hot_rows), "segments", how="parquet")
    segments.write_segments(published, root, rules.select(*target).distinct().join(failed, target, "left_anti"),
                            rows_per_file=rows_per_file)
    return failed
