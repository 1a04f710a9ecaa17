"""Benchmark the headline queries; prints one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion with a ``noop`` write (the full plan
executes, nothing is collected to the driver).  One warm-up query runs
first so JVM start-up is not charged to the first measured query.  The
bronze landing (events -> variant bronze table, a test-data adapter) is
timed as its own field, outside the query total; every query then reads the
stored bronze, as production silver flows do.  Views, tiles and app queries read
stored silver and gold; building those (the refresh) is a field of its own too.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from vitalake.plans.registry import queries, stored  # noqa: E402
from vitalake.session import get_spark  # noqa: E402
from vitalake.sources.bindings import read_events  # noqa: E402
from vitalake.sources.bronze_store import _binding, bronze_path_for, publish_atomically, spread, write_bronze  # noqa: E402

KINDS = ("healthkit", "garmin", "watch", "health_connect")

HEADLINE = [
    "silver_events", "silver_samples", "silver_sleep_stages",
    "g_hk_daily", "g_subject_daily", "g_activity_enriched", "g_sleep_nightly", "g_weekly_workouts",
    "g_cardio_vitals", "g_family_weekly", "vw_sleep_30",
    "dash_01_ingest_overview", "dash_09_gold_volumes",
    "app_dashboard_kpis", "app_steps_leaderboard",
    "sleep_sessions", "samples_live", "garmin_events", "hc_samples", "sync_stats",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", cpus)
    qs = queries()
    names = [n for n in HEADLINE if n in qs]
    spark.read.parquet(f"{sf_dir}/events.parquet").write.format("noop").mode("overwrite").save()  # warm-up
    times = {}
    # landing: derive the variant bronze from events and store it (timed)
    t0 = time.perf_counter()
    for kind in KINDS:
        frame = spread(spark, _binding(kind)(read_events(spark, sf_dir)))
        publish_atomically(spark, bronze_path_for(spark, sf_dir, kind), lambda tmp, f=frame: write_bronze(f, tmp))
    landing = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    layers = stored(spark, sf_dir)
    for table in (*layers.SILVER_TABLES, *layers.GOLD_TABLES):
        getattr(layers, table)
    refresh = round(time.perf_counter() - t0, 3)
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "bronze_landing_sec": landing,
                      "layers_refresh_sec": refresh}))
    spark.stop()


if __name__ == "__main__":
    main()
