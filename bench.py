"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and prints ONE JSON line:
{"metric": ..., "value": total seconds, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed fully with the ``noop`` sink (every row computed,
nothing collected to the driver).  One untimed warm-up pass loads classes
and the parquet footers; the timed figure is the best of ``$BENCH_REPEAT``
runs (default 3).
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "golden_record",
    "latest_dedup",
    "suppression_candidates",
    "segment_rules",
    "publish_segments",
    "two_groups",
    "two_groups_repeat",
    "active_suppression",
    "ingest_report",
    "fill_latest",
]


def _planned_shuffles(df) -> int:
    """Shuffle exchanges in the plan before execution (an exchange feeding
    two consumers is listed twice; AQE reuses it when the query runs)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return len(re.findall(r"Exchange (?:hash|range|round|single|SinglePartition)", buf.getvalue()))


def _shuffles(df) -> int:
    """Shuffles actually executed: run the query, then count the shuffle
    exchanges of AQE's final plan (a reused exchange is not run twice).
    Rows are only counted where they are; none comes to the driver."""
    df._jdf.queryExecution().toRdd().count()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    final = text.split("== Final Plan ==")[-1].split("== Initial Plan ==")[0]
    return len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange (?:hash|range|round|single|SinglePartition)",
                          final))


def _many_targets(spark, sf_dir):
    """Segment rows of 100 targets with 200 rules."""
    from recunify.operators.segments import segment_rows
    from recunify.sources import standins as si
    from recunify.sources.readers import literal_frame
    rules = [(f"{'SMPLE'[i % 5]}%", str(i % 17), str(i % 17 + 2), "", "", "seg", f"t{i % 100}") for i in range(200)]
    return segment_rows(si.golden_parts(spark, sf_dir), literal_frame(
        spark, rules, "source string, minage string, maxage string, minparentage string, maxparentage string, "
                      "targetdatabase string, targettable string"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from recunify.session import local_session
    from recunify.plans.queries import QUERIES

    queries = {n: QUERIES[n] for n in HEADLINE} | {"segments_100_targets": _many_targets}
    spark = local_session(cores=cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    times, shuffles, planned = {}, {}, {}
    for name in queries:
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in queries:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            df = queries[name](spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        times[name] = round(best, 3)
        planned[name] = _planned_shuffles(queries[name](spark, sf_dir))
        shuffles[name] = _shuffles(queries[name](spark, sf_dir))
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "shuffles_executed": shuffles,
        "shuffles_planned": planned,
        "sf": float(sf.group(1)) if sf else sf_dir,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
