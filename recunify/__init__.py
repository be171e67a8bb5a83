"""recunify: record unification, suppression and segmentation on Spark DataFrames."""

from recunify.operators.catalog import (column_map, create_tables, render_ddl, seed_columns,
                                        table_catalog, targets)
from recunify.operators.changes import apply_changes, change_set, common_rows, merge_maps
from recunify.operators.dedup import cold, hot, latest_dedup
from recunify.operators.distinct import (daily_bitmaps, daily_sketches, exact_distinct,
                                         sketched_distinct)
from recunify.operators.overlap import overlap_join
from recunify.operators.report import ingest_report, ingest_summary
from recunify.operators.segments import (drop_blank, lookup_fill, publish_segments, segment_rows,
                                         write_segments)
from recunify.operators.suppression import (active_suppression, active_suppression_parts,
                                            anti_history, group_join, key_join, seen_in_two_groups,
                                            seen_in_two_groups_copies, suppress,
                                            suppression_candidates)
from recunify.operators.survivorship import (ANY, LATEST, PRIORITY, golden_record, golden_tier,
                                             merge_tiers, provenance)
from recunify.operators.timeline import as_of_join, rolling, rolling_days, session_totals, sessions
from recunify.plans.jobs import (archive_cold, daily_suppression_job, daily_update_job, golden_job,
                                 golden_table_job, outcome_feed, segment_job, segment_publish_job)
from recunify.sinks.writers import (overwrite_full, overwrite_partitions, partition_manifest,
                                    stage)
from recunify.sources.readers import align, history_keys, read_tiers, scan_prefix

__all__ = [name for name in dir() if not name.startswith("_")]
