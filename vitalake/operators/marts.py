"""Dashboard tiles, app queries and notebook checks.

Window arguments (``as_of``, ``start``/``end``, user search) are explicit
parameters instead of the wall clock (T18), so every tile is reproducible.
The parameterised app queries (R13-R20) stay what they are in the
reference -- SQL with named parameters -- run through ``spark.sql`` with
the gold frames bound as sub-plans, so Catalyst sees one plan end to end.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import SEED_DEVICE_ID, metric_short, ordered_window, ring_ratio, user_like
from ..functions.variant import header
from .gold import stage_minutes


def _date(v) -> Column:
    return F.lit(v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v)))


def _ts(v) -> Column:
    if isinstance(v, _dt.datetime):
        return F.lit(v).cast("timestamp")
    return F.to_timestamp(F.lit(str(v)))


def bronze_ingest_overview(bronze: DataFrame) -> DataFrame:
    """R1."""
    return (bronze.groupBy(F.to_date("ingested_at").alias("ingest_day"), "record_type", "source_platform")
            .agg(F.count(F.lit(1)).alias("row_count"))
            .orderBy(F.col("ingest_day").desc(), F.col("row_count").desc()))


def hk_quantity_recent(hk_daily: DataFrame, as_of, days: int = 30) -> DataFrame:
    """R2 (+P33)."""
    return (hk_daily.filter(F.col("day") >= F.date_sub(_date(as_of), days))
            .select("day", "user_id", metric_short().alias("metric_short"), "avg_value", "min_value",
                    "max_value", "sample_rows")
            .orderBy(F.col("day").desc(), F.col("sample_rows").desc()))


def recent_workouts(workouts: DataFrame, as_of_ts, days: int = 14, limit: int = 200) -> DataFrame:
    """Top ``limit`` newest workouts; ties broken on every output column."""
    out = (workouts.filter(F.col("start_at") >= _ts(as_of_ts) - F.make_dt_interval(F.lit(days)))
           .select("start_at", "user_id", "activity_type",
                   F.round(F.col("duration_seconds") / 60, 1).alias("duration_min"),
                   "total_energy_burned_kcal",
                   F.round(F.col("total_distance_meters") / 1000, 2).alias("distance_km"), "ingested_at"))
    return out.orderBy(F.col("start_at").desc(), *[F.col(c).asc_nulls_last() for c in out.columns[1:]]).limit(limit)


def sleep_stage_minutes(stages: DataFrame) -> DataFrame:
    """R4."""
    return (stages.filter(F.col("stage_start_at").isNotNull() & F.col("stage_end_at").isNotNull())
            .groupBy("user_id", F.to_date("session_start_at").alias("sleep_night"), "sleep_stage")
            .agg(F.round(F.sum(stage_minutes()), 1).alias("stage_minutes"))
            .orderBy(F.col("sleep_night").desc(), F.col("stage_minutes").desc()))


def ring_adherence(rings: DataFrame, as_of, days: int = 30) -> DataFrame:
    """R5 (P35 at 2 digits)."""
    return (rings.filter(F.col("summary_date") >= F.date_sub(_date(as_of), days))
            .select("summary_date", "user_id", "active_energy_burned_kcal", "active_energy_burned_goal_kcal",
                    ring_ratio("active_energy_burned_kcal", "active_energy_burned_goal_kcal", 2).alias("move_ring_ratio"),
                    "exercise_minutes", "exercise_minutes_goal", "stand_hours", "stand_hours_goal")
            .orderBy(F.col("summary_date").desc()))


def volumes(frames: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of one-row counts, one per named frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")
             for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).orderBy("dataset")


def seed_footprint(bronze: DataFrame) -> DataFrame:
    """R7 (+P38)."""
    return (bronze_seed_slice(bronze)
            .groupBy(F.to_date("ingested_at").alias("day"), "record_type").agg(F.count(F.lit(1)).alias("rows"))
            .orderBy(F.col("day").desc(), F.col("rows").desc()))


def bronze_seed_slice(bronze: DataFrame) -> DataFrame:
    """Rows landed by the seed device."""
    return bronze.filter(header("x-device-id") == F.lit(SEED_DEVICE_ID))


def bronze_freshness(bronze: DataFrame, as_of_ts) -> DataFrame:
    """Newest row, whole days and hours since ``as_of_ts``."""
    now = _ts(as_of_ts)
    last = F.max("ingested_at")
    return bronze.agg(
        last.alias("last_ingested_at"),
        F.datediff(now, last).alias("days_since_last_row"),
        ((F.unix_timestamp(now) - F.unix_timestamp(last)) / F.lit(3600.0)).alias("hours_since_last_row"),
    )


def activity_recent(enriched: DataFrame, as_of, days: int = 60) -> DataFrame:
    """R10."""
    return (enriched.filter(F.col("day") >= F.date_sub(_date(as_of), days))
            .select("day", "user_id", "move_ring_ratio", "exercise_ring_ratio", "stand_ring_ratio", "total_steps")
            .orderBy(F.col("day").desc(), "user_id"))


def sleep_recent(nightly: DataFrame, as_of, days: int = 90) -> DataFrame:
    """R11."""
    return (nightly.filter(F.col("sleep_night") >= F.date_sub(_date(as_of), days))
            .select("sleep_night", "user_id", "deep_sleep_min", "rem_sleep_min", "core_sleep_min", "awake_min",
                    "in_bed_min", "total_tracked_min", "sleep_sessions")
            .orderBy(F.col("sleep_night").desc(), "user_id"))


def ingest_by_type_recent(ingest_daily: DataFrame, as_of, days: int = 90) -> DataFrame:
    """R12."""
    return (ingest_daily.filter(F.col("ingest_day") >= F.date_sub(_date(as_of), days))
            .select("ingest_day", "user_id", "record_type", "row_count")
            .orderBy(F.col("ingest_day").desc(), F.col("row_count").desc()))


# --- parameterised app queries (R13-R20) ---------------------------------

def app_params(start: str, end: str, search: str = "") -> dict:
    s, e = ordered_window(start, end)
    return {"startDate": _dt.date.fromisoformat(s), "endDate": _dt.date.fromisoformat(e),
            "userPattern": user_like(search)}


def _chosen(rows: DataFrame, day: str, start: str, end: str, search: str) -> DataFrame:
    """Rows whose ``day`` lies in the window and whose user matches the search."""
    p = app_params(start, end, search)
    d = F.col(day).cast("date")
    return rows.filter(d.between(F.lit(p["startDate"]), F.lit(p["endDate"])) & F.col("user_id").like(p["userPattern"]))


def _exact(agg, col: str, scale: int, digits: int, name: str):
    """An average or sum in exact decimal arithmetic, rounded: the result does
    not depend on the order in which Spark happens to add."""
    return F.round(agg(F.col(col).cast(f"decimal({18 if scale == 3 else 38},{scale})")), digits).cast("double").alias(name)


def _top(rows: DataFrame, by: str, limit: int) -> DataFrame:
    return rows.orderBy(F.col(by).desc_nulls_last(), "user_id").limit(limit)


def activity_trend(spark: SparkSession, enriched: DataFrame, start: str, end: str, search: str = "") -> DataFrame:
    """R13."""
    return (_chosen(enriched, "day", start, end, search).groupBy("day")
            .agg(F.count_distinct("user_id").alias("active_users"), _exact(F.avg, "move_ring_ratio", 3, 3, "avg_move_ratio"),
                 _exact(F.avg, "total_steps", 6, 0, "avg_steps")).orderBy("day"))


def ingest_daily_trend(spark: SparkSession, bronze: DataFrame, start: str, end: str, search: str = "") -> DataFrame:
    """R14.  The day window is also stated as a plain ``ingested_at`` range
    (equal under the UTC session) so it reaches the scan as a pushed filter."""
    p = app_params(start, end, search)
    first, last = (F.to_timestamp(F.lit(str(p[k]))) for k in ("startDate", "endDate"))
    rows = bronze.filter((F.col("ingested_at") >= first) & (F.col("ingested_at") < last + F.expr("INTERVAL 1 DAY")))
    rows = rows.select("user_id", F.to_date("ingested_at").alias("ingest_day"))
    return _chosen(rows, "ingest_day", start, end, search).groupBy("ingest_day").agg(F.count(F.lit(1)).alias("row_count")).orderBy("ingest_day")


def ingest_mix(spark: SparkSession, ingest_daily: DataFrame, start: str, end: str, search: str = "",
               record_type: str = "ALL") -> DataFrame:
    """R15 (+P37) with each type's share of the largest, in whole percent.  Record types are free text: the
    largest comes from a one-row aggregate, not from a window over all types in one task."""
    rows = _chosen(ingest_daily, "ingest_day", start, end, search)
    if record_type != "ALL":
        rows = rows.filter(F.col("record_type") == record_type)
    mix = rows.groupBy("record_type").agg(F.sum("row_count").alias("row_count"))
    top = mix.agg(F.max("row_count").alias("top"))
    share = F.floor(F.col("row_count") * F.lit(100.0).cast("decimal(4,1)") / F.col("top") + F.lit(0.5).cast("decimal(2,1)")).cast("bigint")
    return (mix.join(F.broadcast(top)).select("record_type", "row_count", F.when(F.col("top") > 0, share).otherwise(F.lit(0).cast("bigint")).alias("pct_of_max"))
            .orderBy(F.col("row_count").desc()))  # one row on the right


def dashboard_kpis(spark: SparkSession, bronze: DataFrame, enriched: DataFrame, steps: DataFrame,
                   start: str, end: str, search: str = "") -> DataFrame:
    """Five KPIs; the three bronze KPIs share one scan (conditional
    aggregates), each gold KPI is a one-row aggregate; the one-row frames are
    unioned (other columns NULL) and collapsed with ``max`` -- no join."""
    p = app_params(start, end, search)
    in_win = (F.to_date("ingested_at").between(F.lit(p["startDate"]), F.lit(p["endDate"]))
              & F.col("user_id").like(p["userPattern"]))
    b = bronze.select("ingested_at", "user_id").agg(
        F.count_if(in_win).alias("bronze_rows_in_window"),
        F.count(F.lit(1)).alias("bronze_rows_all_time"),
        F.max(F.when(in_win, F.col("ingested_at"))).alias("last_bronze_ingest_in_window"))

    def users(df: DataFrame, name: str) -> DataFrame:
        w = F.col("day").between(F.lit(p["startDate"]), F.lit(p["endDate"])) & F.col("user_id").like(p["userPattern"])
        return df.filter(w).agg(F.count_distinct("user_id").alias(name))

    return one_row([b, users(enriched, "active_users_in_window"), users(steps, "users_with_steps_in_window")],
                   ["bronze_rows_in_window", "bronze_rows_all_time", "active_users_in_window",
                    "users_with_steps_in_window", "last_bronze_ingest_in_window"])


def one_row(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """Combine one-row aggregates side by side without a join: union them
    (missing columns NULL) and take ``max`` of each column."""
    u = reduce(lambda a, c: a.unionByName(c, allowMissingColumns=True), frames)
    return u.agg(*[F.max(c).alias(c) for c in columns])


def sleep_summary(spark: SparkSession, nightly: DataFrame, start: str, end: str, search: str = "",
                  limit: int = 50) -> DataFrame:
    """Top ``limit`` users by nights (tie-break user_id)."""
    users = _chosen(nightly, "sleep_night", start, end, search).groupBy("user_id").agg(
        _exact(F.avg, "deep_sleep_min", 10, 1, "avg_deep_min"), _exact(F.avg, "rem_sleep_min", 10, 1, "avg_rem_min"),
        _exact(F.avg, "total_tracked_min", 10, 0, "avg_tracked_min"), F.count(F.lit(1)).alias("nights"))
    return _top(users, "nights", limit)


def steps_leaderboard(spark: SparkSession, steps: DataFrame, start: str, end: str, search: str = "",
                      limit: int = 50) -> DataFrame:
    """Top ``limit`` users by average daily steps (tie-break user_id)."""
    users = _chosen(steps, "day", start, end, search).groupBy("user_id").agg(
        _exact(F.avg, "total_steps", 6, 0, "avg_steps"), F.max("total_steps").alias("peak_steps"), _exact(F.sum, "total_steps", 6, 0, "sum_steps"))
    return _top(users, "avg_steps", limit)


def rhr_trend(spark: SparkSession, cardio: DataFrame, start: str, end: str, search: str = "") -> DataFrame:
    """R19."""
    with_rate = _chosen(cardio, "day", start, end, search).filter(F.col("resting_hr_avg").isNotNull())
    return with_rate.groupBy("day").agg(_exact(F.avg, "resting_hr_avg", 10, 1, "avg_resting_hr"),
                                        F.count_distinct("user_id").alias("users_reporting")).orderBy("day")


def workout_volume_by_user(spark: SparkSession, weekly: DataFrame, start: str, end: str, search: str = "",
                           limit: int = 50) -> DataFrame:
    """Weeks whose start is in the window; top ``limit`` by workouts."""
    users = _chosen(weekly, "week_start", start, end, search).groupBy("user_id").agg(
        F.sum("workout_count").alias("workouts"), _exact(F.sum, "total_duration_min", 6, 0, "total_minutes"),
        _exact(F.sum, "total_energy_kcal", 6, 0, "total_kcal"))
    return _top(users, "workouts", limit)


# --- notebook checks (R21, R22) ------------------------------------------

def seed_counts_by_user_type(bronze: DataFrame, users: list[str] | None = None) -> DataFrame:
    """Seeded rows per (user, record_type); ``users`` narrows to a
    seeded cohort (None = every user)."""
    b = bronze_seed_slice(bronze)
    if users is not None:
        b = b.filter(F.col("user_id").isin(users))
    return (b.groupBy("user_id", "record_type").agg(F.count(F.lit(1)).alias("rows"))
            .orderBy("user_id", "record_type"))


def platform_of_headers() -> Column:
    """Platform header under either key case (T9: Garmin writers use
    ``X-Platform``, the HTTP route stores ``x-platform``)."""
    return F.coalesce(header("X-Platform"), header("x-platform"))


def platform_type_counts(bronze: DataFrame) -> DataFrame:
    """R22a."""
    return (bronze.groupBy(platform_of_headers().alias("platform"), "record_type")
            .agg(F.count(F.lit(1)).alias("cnt")).orderBy("platform", "record_type"))


def record_type_span(bronze: DataFrame, by_body_date: bool = False) -> DataFrame:
    """Rows per record type with the earliest/latest ingest time, or
    (``by_body_date``) the earliest/latest ``date`` field of the documents."""
    t = F.try_variant_get("body", "$.date", "string") if by_body_date else F.col("ingested_at")
    return (bronze.groupBy("record_type")
            .agg(F.count(F.lit(1)).alias("cnt"), F.min(t).alias("earliest"), F.max(t).alias("latest"))
            .orderBy(F.col("cnt").desc(), "record_type"))
