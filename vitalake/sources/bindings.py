"""Bind the driver's ``events`` table to the 7-column VARIANT bronze.

Every event becomes one NDJSON-shaped document of the record type its
``event_type`` stands for (view -> samples, click -> workouts, signup ->
sleep, purchase -> activity_summaries, error -> deletes); one in twenty is
landed a second time an hour later under a new record id (a client resend).
The binding is a union of one branch per shape, each branch filtered on
``event_type``: a downstream ``record_type = 'samples'`` filter folds the
other branches away and reaches the parquet scan as a pushed filter.

``k`` (0-99, from ``props``) drives the variety the operators need: time
formats, header channels, NULL stage ids, zero goals, missing distances.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dims import HK_WORKOUT_NAMES, name_expr
from ..functions.labels import SEED_DEVICE_ID
from ..functions.variant import iso_millis_z, iso_offset, iso_z
from ..schemas import BRONZE_COLUMNS

# Fixed values (must equal the reference for identical results): the twelve
# HealthKit quantity types and units of the reference's sample generator.
SAMPLE_TYPES = [
    ("HKQuantityTypeIdentifierActiveEnergyBurned", "kcal"),
    ("HKQuantityTypeIdentifierAppleExerciseTime", "min"),
    ("HKQuantityTypeIdentifierAppleStandTime", "min"),
    ("HKQuantityTypeIdentifierDistanceWalkingRunning", "m"),
    ("HKQuantityTypeIdentifierOxygenSaturation", "%"),
    ("HKQuantityTypeIdentifierRestingHeartRate", "count/min"),
    ("HKQuantityTypeIdentifierHeartRateVariabilitySDNN", "ms"),
    ("HKQuantityTypeIdentifierBodyMass", "kg"),
    ("HKQuantityTypeIdentifierFlightsClimbed", "count"),
    ("HKQuantityTypeIdentifierWalkingSpeed", "km/hr"),
    ("HKQuantityTypeIdentifierStepCount", "count"),
    ("HKQuantityTypeIdentifierHeartRate", "count/min"),
]
# Workout activity codes used by the binding (HealthKit raw values).
WORKOUT_CODES = [37, 52, 13, 57]
EVENT_RECORD_TYPES = {
    "view": "samples",
    "click": "workouts",
    "signup": "sleep",
    "purchase": "activity_summaries",
    "error": "deletes",
}
PLATFORM = "apple_healthkit"
SOURCE_NAME = "Apple Watch"
DUP_EVERY = 20


def k_col() -> Column:
    return F.regexp_extract(F.col("props"), "[0-9]+", 0).cast("int")


def _minutes(n: Column | int) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))


def _pick(values: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1)


def _landed(events: DataFrame, event_type: str) -> DataFrame:
    """Rows of one event type with the landing copies and common columns."""
    e = events.filter(F.col("event_type") == F.lit(event_type))
    copies = F.when(F.col("event_id") % DUP_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    e = e.select("event_id", "ts", "user_id", "value", k_col().alias("k"), F.explode(copies).alias("_copy"))
    return e.withColumn("_t", F.col("ts").cast("timestamp"))


def _headers(record_type: str) -> Column:
    k = F.col("k")
    device = F.when(k < 10, F.lit(SEED_DEVICE_ID)).otherwise(F.concat(F.lit("dev"), F.col("user_id").cast("string")))
    channel = F.when(k >= 20, F.when(k % 2 == 0, F.lit("notebook_simulator")).otherwise(F.lit("rest_app")))
    h = F.struct(
        F.lit("application/x-ndjson").alias("content-type"),
        F.lit(PLATFORM).alias("x-platform"),
        F.lit(record_type).alias("x-record-type"),
        device.alias("x-device-id"),
        iso_z(F.col("_t")).alias("x-upload-timestamp"),
        channel.alias("x-ingest-channel"),
    )
    return F.parse_json(F.to_json(h))


def _bronze(e: DataFrame, record_type: str, body: Column) -> DataFrame:
    dup = F.col("_copy") == 1
    return e.select(
        F.concat(F.lit("r"), F.col("event_id").cast("string"), F.when(dup, F.lit("-d")).otherwise(F.lit(""))).alias("record_id"),
        (F.col("_t") + F.make_dt_interval(F.lit(0), ((F.col("event_id") % 7) + F.col("_copy")).cast("int"))).alias("ingested_at"),
        F.parse_json(F.to_json(body)).alias("body"),
        _headers(record_type).alias("headers"),
        F.lit(record_type).alias("record_type"),
        F.lit(PLATFORM).alias("source_platform"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"),
    )


def _uuid() -> Column:
    return F.concat(F.lit("e"), F.col("event_id").cast("string"))


def _sample_time(t: Column) -> Column:
    fmt = F.col("k") % 3
    return F.when(fmt == 0, iso_z(t)).when(fmt == 1, iso_millis_z(t)).otherwise(iso_offset(t))


def samples_branch(events: DataFrame) -> DataFrame:
    e = _landed(events, "view")
    i = F.col("k") % len(SAMPLE_TYPES)
    t = F.col("_t")
    body = F.struct(
        _uuid().alias("uuid"),
        _pick([s[0] for s in SAMPLE_TYPES], i).alias("type"),
        F.col("value").alias("value"),
        _pick([s[1] for s in SAMPLE_TYPES], i).alias("unit"),
        _sample_time(t).alias("start_date"),
        _sample_time(t + _minutes(F.col("k"))).alias("end_date"),
        F.lit(SOURCE_NAME).alias("source_name"),
    )
    return _bronze(e, "samples", body)


def workouts_branch(events: DataFrame) -> DataFrame:
    e = _landed(events, "click")
    code = _pick(WORKOUT_CODES, F.col("k") % len(WORKOUT_CODES))
    t = F.col("_t")
    dur = F.col("k") * 60
    body = F.struct(
        _uuid().alias("uuid"),
        name_expr(HK_WORKOUT_NAMES, code).alias("activity_type"),
        code.alias("activity_type_raw"),
        iso_z(t).alias("start_date"),
        iso_z(t + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), dur.cast("decimal(18,6)"))).alias("end_date"),
        dur.alias("duration_seconds"),
        F.col("value").alias("total_energy_burned_kcal"),
        F.when(F.col("k") % 5 != 0, F.col("k") * 100.0).alias("total_distance_meters"),
        F.lit(SOURCE_NAME).alias("source_name"),
    )
    return _bronze(e, "workouts", body)


SLEEP_PLAN = [("asleepCore", 0, 90), ("asleepDeep", 90, 150), ("asleepREM", 150, 200)]


def sleep_branch(events: DataFrame) -> DataFrame:
    e = _landed(events, "signup")
    t = F.col("_t")
    awake = F.col("k") % 30
    no_id = F.col("k") % 10 == 0

    def stage(i: int, name: str, a: Column, b: Column) -> Column:
        sid = F.when(~no_id, F.concat(F.lit("s"), F.col("event_id").cast("string"), F.lit(f"-{i}")))
        return F.struct(sid.alias("uuid"), F.lit(name).alias("stage"),
                        iso_z(t + _minutes(a)).alias("start_date"), iso_z(t + _minutes(b)).alias("end_date"))

    stages = [stage(i, n, F.lit(a), F.lit(b)) for i, (n, a, b) in enumerate(SLEEP_PLAN)]
    stages.append(stage(3, "awake", F.lit(200), F.lit(200) + awake))
    body = F.struct(
        iso_z(t).alias("start_date"),
        iso_z(t + _minutes(F.lit(200) + awake)).alias("end_date"),
        F.array(*stages).alias("stages"),
    )
    return _bronze(e, "sleep", body)


def rings_branch(events: DataFrame) -> DataFrame:
    e = _landed(events, "purchase")
    k = F.col("k")
    body = F.struct(
        F.date_format(F.col("_t"), "yyyy-MM-dd").alias("date"),
        F.col("value").alias("active_energy_burned_kcal"),
        F.when(k % 8 == 0, F.lit(0.0)).otherwise(F.lit(500.0)).alias("active_energy_burned_goal_kcal"),
        k.cast("double").alias("exercise_minutes"),
        F.lit(30.0).alias("exercise_minutes_goal"),
        (k % 16).alias("stand_hours"),
        F.lit(12).alias("stand_hours_goal"),
    )
    return _bronze(e, "activity_summaries", body)


def deletes_branch(events: DataFrame) -> DataFrame:
    e = _landed(events, "error")
    body = F.struct(
        F.concat(F.lit("e"), (F.col("event_id") - 1).cast("string")).alias("uuid"),
        _pick([s[0] for s in SAMPLE_TYPES], F.col("k") % len(SAMPLE_TYPES)).alias("sample_type"),
    )
    return _bronze(e, "deletes", body)


BRANCHES = [samples_branch, workouts_branch, sleep_branch, rings_branch, deletes_branch]


def events_to_bronze(events: DataFrame) -> DataFrame:
    """The full HealthKit bronze derived from ``events`` (all five shapes)."""
    out = None
    for branch in BRANCHES:
        b = branch(events)
        out = b if out is None else out.unionByName(b)
    return out.select(*BRONZE_COLUMNS)


def read_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def bronze_from_dir(spark, sf_dir: str) -> DataFrame:
    return events_to_bronze(read_events(spark, sf_dir))
