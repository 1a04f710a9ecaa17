"""The triggered refresh job: bronze -> streaming silver -> gold -> views.

    python -m vitalake.plans.refresh --bronze PATH [--out PATH] [--dedup exact|bounded]

1. the six silver flows run as ``availableNow`` streams over the bronze table
   (each with its own checkpoint, so a rerun only processes new files);
2. gold tables are recomputed in batch from the silver sinks (X4) and
   written as parquet (S14);
3. the three views are published as temp views over the written gold.

With ``--incremental`` step 2 folds the new silver rows into stored partial states
(``plans.incremental``): a run reads what the silver flows have just appended and
rewrites the days it touches, not all history.

Everything is written under ``--out`` (default: the session's checkpoint
folder), so a failed run is simply rerun.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..operators import gold
from ..session import checkpoint_dir, get_spark
from ..sources.bronze_store import read_bronze
from ..streaming import medallion as streaming
from .incremental import ROLLUPS, IncrementalGold

# Gold tables are clustered by user then time inside each file, so row-group
# statistics serve per-user and per-window reads (``repartitionByRange`` would
# add a sampling pass and a full shuffle).
CLUSTER = {"gold_bronze_ingest_daily": ["user_id", "ingest_day"], "gold_subject_daily": ["subject_id", "day"],
           "gold_sleep_nightly": ["user_id", "sleep_night"], "gold_weekly_workout_summary": ["user_id", "week_start"],
           "gold_hk_family_weekly": ["user_id", "week_start"]}

GOLD_OUTPUTS = {
    "gold_hk_quantity_daily": "hk_quantity_daily", "gold_subject_daily": "subject_daily",
    "gold_daily_steps": "daily_steps", "gold_activity_enriched_daily": "activity_enriched",
    "gold_sleep_nightly": "sleep_nightly", "gold_weekly_workout_summary": "weekly_workouts",
    "gold_cardio_vitals_daily": "cardio_vitals", "gold_heart_rate_intraday_daily": "hr_intraday",
    "gold_bronze_ingest_daily": "ingest_daily", "gold_hk_family_weekly": "family_weekly",
}


def refresh(spark: SparkSession, bronze_path: str, out: str | None = None, dedup: str = "bounded",
            as_of: str | None = None) -> dict[str, str]:
    root = (out or f"{checkpoint_dir(spark)}/refresh").rstrip("/")
    streaming.run_available_now(spark, bronze_path, f"{root}/silver", dedup=dedup)
    m = streaming.gold_from_sinks(spark, f"{root}/silver", read_bronze(spark, bronze_path))
    written = {}
    for table, attr in GOLD_OUTPUTS.items():
        path = f"{root}/gold/{table}"
        getattr(m, attr).sortWithinPartitions(*CLUSTER.get(table, ["user_id", "day"])) \
            .write.mode("overwrite").parquet(path)
        written[table] = path
    g = {t: spark.read.parquet(p) for t, p in written.items()}
    gold.activity_last_days(g["gold_activity_enriched_daily"], as_of).createOrReplaceTempView("vw_activity_last_45d")
    gold.sleep_last_nights(g["gold_sleep_nightly"]).createOrReplaceTempView("vw_sleep_last_30_sessions")
    gold.workouts_recent(g["gold_weekly_workout_summary"], as_of).createOrReplaceTempView("vw_workouts_recent")
    return written


def refresh_incremental(spark: SparkSession, bronze_path: str, out: str | None = None, dedup: str = "bounded") -> IncrementalGold:
    """The gold tables of ``ROLLUPS`` from the rows appended since the last run, each source with its own
    checkpoint; a run that died is finished by the next one, no batch counts twice."""
    root = (out or f"{checkpoint_dir(spark)}/refresh").rstrip("/")
    streaming.run_available_now(spark, bronze_path, f"{root}/silver", dedup=dedup)
    states = IncrementalGold(spark, f"{root}/gold-states")
    for source in dict.fromkeys(r.source for r in ROLLUPS.values()):
        if source == "bronze":
            rows = streaming.bronze_stream(spark, bronze_path)
        else:
            sink = f"{root}/silver/tables/{source}"
            rows = spark.readStream.schema(spark.read.parquet(sink).schema).parquet(sink)
        q = states.follow(rows, [n for n, r in ROLLUPS.items() if r.source == source], f"{root}/checkpoints/gold-{source}")
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return states


def main() -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--bronze", required=True)
    ap.add_argument("--out")
    ap.add_argument("--dedup", default="bounded", choices=["exact", "bounded"])
    ap.add_argument("--as-of")
    ap.add_argument("--incremental", action="store_true")
    a = ap.parse_args()
    spark = get_spark()
    if a.incremental:
        states = refresh_incremental(spark, a.bronze, a.out, a.dedup)
        for name in ROLLUPS:
            print(name, states.table(name).root, "version", states.table(name).version())
        return
    for table, path in refresh(spark, a.bronze, a.out, a.dedup, a.as_of).items():
        print(table, path)


if __name__ == "__main__":
    main()
