"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the input folder, ``BENCH_CPUS`` the number of local cores. Each query is
run to completion into Spark's ``noop`` sink: once to warm up, then ``BENCH_RUNS`` times, of which
the median counts. ``whole_run`` is the complete path from raw events to the marts in one go.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import fixtures, queries  # noqa: E402
from pulselake.plans import gold, runs, star  # noqa: E402
from pulselake.session import configure, local_session, workspace  # noqa: E402
from pulselake.sources import tables  # noqa: E402
from pulselake.streaming import ingest  # noqa: E402

HEADLINE = (
    "q_dedup_events", "q_validate_wearable", "q_quarantine_rate", "q_enrich_events",
    "q_gold_fatigue", "q_gold_consistency", "q_gold_community", "q_gold_profile",
    "q_dim_user_scd2", "q_mart_health_score", "q_mart_coach", "q_reconcile", "q_merge_upsert",
    "q_append_idempotent", "q_decode_payload", "q_stream_demux", "q_stream_silver",
)


def whole_run(spark, sf_dir):
    """Messages to Bronze, Silver, Gold and the star schema, everything stored."""
    base = workspace(spark, "whole_run")
    queries.message_landing(spark, sf_dir, f"{base}/landing")
    ingest.ingest_messages(
        ingest.text_stream(spark, f"{base}/landing"), f"{base}/bronze", f"{base}/memory"
    )
    refs = fixtures.references(spark, sf_dir)
    runs.run_silver(spark, f"{base}/bronze", f"{base}/silver", refs)
    runs.run_gold(spark, f"{base}/silver", f"{base}/gold")
    made = {n: spark.read.parquet(f"{base}/gold/{n}") for n in runs.GOLD_INPUTS}
    marts = star.run_star(
        tables.read_silver(spark, f"{base}/silver", "user_profile"),
        made["gold_fatigue_recovery"], made["gold_workout_consistency"],
        made["gold_community_analytics"], f"{base}/star",
    )
    return marts["mart_user_health_score"]


def timed(run, spark, sf_dir) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_RUNS", "2"))
    spark = configure(local_session(os.environ.get("BENCH_CPUS", "8"), "bench"))
    chosen = {n: queries.QUERIES[n] for n in HEADLINE}
    chosen["whole_run"] = whole_run
    seconds = {}
    for name, run in chosen.items():
        timed(run, spark, sf_dir)
        seconds[name] = round(statistics.median(timed(run, spark, sf_dir) for _ in range(repeats)), 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
