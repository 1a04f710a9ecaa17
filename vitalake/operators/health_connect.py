"""Health Connect (Android) shapes onto the silver tables.

The Android client names fields differently (``id``, ``start_time``,
``exercise_type`` ...); the reference's silver reads only the HealthKit
names (T8).  These functions project the Android shapes onto the same
silver columns, so ``unionByName`` with the HealthKit silver gives one
cross-platform table.  Code -> name lookups use the fixed dimensions with a
broadcast join (their size is fixed, not data-dependent).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dims import HC_EXERCISE_NAMES, HC_SAMPLE_TYPES, HC_SLEEP_STAGES, code_dim, lookup_name
from ..functions.labels import session_duration_seconds
from ..functions.variant import body_dbl, body_long, body_str, parse_ts
from .silver import WATERMARKS, dedup

HC_PLATFORM = "android_health_connect"
HR_SAMPLES = "array<struct<time string, beats_per_minute double>>"
HC_STAGES = "array<struct<stage string, stage_code bigint, start_time string, end_time string>>"


def _hc(bronze: DataFrame, record_type: str) -> DataFrame:
    return bronze.filter((F.col("record_type") == record_type) & (F.col("source_platform") == HC_PLATFORM))


def flatten_heart_rate(df: DataFrame, id_col: str = "hk_uuid", samples_col: str = "_hr") -> DataFrame:
    """One row per inner heart-rate sample, id ``<record>-<index>``,
    start = end = the sample time."""
    hr = df.filter(F.col(samples_col).isNotNull()).select("*", F.posexplode(samples_col).alias("_i", "_s"))
    return (hr.withColumn(id_col, F.concat_ws("-", F.col(id_col), F.col("_i").cast("string")))
            .withColumn("value", F.col("_s.beats_per_minute"))
            .withColumn("start_at", parse_ts(F.col("_s.time"))).withColumn("end_at", F.col("start_at"))
            .drop("_i", "_s"))


def hc_samples(spark: SparkSession, bronze: DataFrame, dedup_mode: str = "first") -> DataFrame:
    """P10 (+P11, P12): Android samples as ``samples`` silver rows; unit from
    the record-class dimension (inner join: unknown classes are skipped)."""
    base = _hc(bronze, "samples").select(
        "record_id", "ingested_at", "user_id",
        F.coalesce(body_str("$.id"), F.col("record_id")).alias("hk_uuid"),
        body_str("$.type").alias("hk_type"),
        body_dbl("$.value").alias("value"),
        parse_ts(body_str("$.start_time")).alias("start_at"),
        parse_ts(body_str("$.end_time")).alias("end_at"),
        body_str("$.data_origin").alias("source_name"),
        body_str("$.start_zone_offset").alias("zone_offset"),
        F.try_variant_get(F.col("body"), "$.samples", HR_SAMPLES).alias("_hr"),
    )
    flat = base.filter(F.col("_hr").isNull()).unionByName(flatten_heart_rate(base)).drop("_hr")
    units = F.broadcast(spark.createDataFrame([(c, t, u) for c, t, u in HC_SAMPLE_TYPES],
                                              "_class string, _type string, hk_unit string"))
    typed = (flat.join(units, F.col("hk_type") == F.col("_class"), "inner")
             .withColumn("hk_type", F.col("_type")).drop("_class", "_type"))
    out = typed.select("record_id", "ingested_at", "user_id", "hk_uuid", "hk_type", "hk_unit", "value", "start_at",
                       "end_at", "source_name", "zone_offset")
    return dedup(out, "hk_uuid", dedup_mode, WATERMARKS["samples"])


def hc_workouts(spark: SparkSession, bronze: DataFrame, dedup_mode: str = "first") -> DataFrame:
    """P10 (+P17, P19): exercise sessions as ``workouts`` silver rows."""
    start, end = parse_ts(body_str("$.start_time")), parse_ts(body_str("$.end_time"))
    w = _hc(bronze, "workouts").select(
        "record_id", "ingested_at", "user_id",
        F.coalesce(body_str("$.id"), F.col("record_id")).alias("workout_uuid"),
        body_str("$.exercise_type").alias("_name"),
        body_long("$.exercise_type_code").alias("activity_type_raw"),
        start.alias("start_at"), end.alias("end_at"),
        F.coalesce(body_dbl("$.duration_seconds"), session_duration_seconds(start, end)).alias("duration_seconds"),
        F.lit(None).cast("double").alias("total_energy_burned_kcal"),
        F.lit(None).cast("double").alias("total_distance_meters"),
        body_str("$.data_origin").alias("source_name"),
    )
    w = lookup_name(w, code_dim(spark, HC_EXERCISE_NAMES), "activity_type_raw", "_code_name")
    w = w.withColumn("activity_type", F.coalesce(F.col("_name"), F.col("_code_name"))).drop("_name", "_code_name")
    out = w.select("record_id", "ingested_at", "user_id", "workout_uuid", "activity_type", "activity_type_raw",
                   "start_at", "end_at", "duration_seconds", "total_energy_burned_kcal", "total_distance_meters",
                   "source_name")
    return dedup(out, "workout_uuid", dedup_mode, WATERMARKS["workouts"])


def hc_sleep_stages(spark: SparkSession, bronze: DataFrame, dedup_mode: str = "first") -> DataFrame:
    """P10 (+P18): sleep sessions exploded to ``sleep_stages`` silver rows.
    Android stages carry no uuid: the id is sha256(record|stage|start)."""
    s = _hc(bronze, "sleep").select(
        F.col("record_id").alias("sleep_record_id"), "ingested_at", "user_id",
        parse_ts(body_str("$.start_time")).alias("session_start_at"),
        parse_ts(body_str("$.end_time")).alias("session_end_at"),
        F.try_variant_get(F.col("body"), "$.stages", HC_STAGES).alias("stages"),
    ).filter(F.size("stages") > 0)
    st = s.select("sleep_record_id", "ingested_at", "user_id", "session_start_at", "session_end_at",
                  F.explode("stages").alias("st"))
    st = st.withColumn("_code", F.col("st.stage_code"))
    st = lookup_name(st, code_dim(spark, HC_SLEEP_STAGES), "_code", "_dim_stage")
    stage = F.coalesce(F.col("st.stage"), F.col("_dim_stage"))
    out = st.select(
        "sleep_record_id", "ingested_at", "user_id", "session_start_at", "session_end_at",
        F.sha2(F.concat_ws("|", F.col("sleep_record_id"), stage, F.col("st.start_time")), 256).alias("stage_uuid"),
        stage.alias("sleep_stage"),
        parse_ts(F.col("st.start_time")).alias("stage_start_at"),
        parse_ts(F.col("st.end_time")).alias("stage_end_at"),
    )
    return dedup(out, "stage_uuid", dedup_mode, WATERMARKS["sleep_stages"], ("ingested_at", "sleep_record_id"))


def hc_daily_summaries(bronze: DataFrame, dedup_mode: str = "first") -> DataFrame:
    """P10: Android daily summaries (no HealthKit twin)."""
    out = _hc(bronze, "daily_summaries").select(
        "record_id", "ingested_at", "user_id",
        F.try_to_date(body_str("$.date")).alias("summary_date"),
        body_str("$.timezone").alias("timezone"),
        body_long("$.total_steps").alias("total_steps"),
        body_dbl("$.active_calories_burned_kcal").alias("active_calories_burned_kcal"),
        body_dbl("$.total_distance_meters").alias("total_distance_meters"),
        body_dbl("$.exercise_duration_minutes").alias("exercise_duration_minutes"),
    ).filter(F.col("summary_date").isNotNull())
    return dedup(out, "record_id", dedup_mode, WATERMARKS["rings"])


def hc_deletes(bronze: DataFrame, dedup_mode: str = "first") -> DataFrame:
    """P10: Android delete notices onto the ``deletes`` silver columns."""
    out = _hc(bronze, "deletes").select(
        "record_id", "ingested_at", "user_id",
        body_str("$.id").alias("deleted_uuid"),
        body_str("$.record_type").alias("deleted_sample_type"),
    )
    return dedup(out, "record_id", dedup_mode, WATERMARKS["deletes"])


# The record classes a daily summary adds up.
SUMMARY_TYPES = [("StepsRecord", "total_steps"), ("ActiveCaloriesBurnedRecord", "active_calories_burned_kcal"),
                 ("DistanceRecord", "total_distance_meters")]


def daily_summary_from_samples(samples: DataFrame) -> DataFrame:
    """Per user, local day (sample start shifted by its zone offset) and
    zone: total steps, active kcal and metres; days without samples between a
    user's first and last day are filled with zeros.

    The fill uses ``sequence`` over each user's day span -- rows grow with
    the calendar span, not with the data volume."""
    s = samples.filter(F.col("hk_type").isin([t for t, _ in SUMMARY_TYPES]))
    zone = F.coalesce(F.col("zone_offset"), F.lit("+00:00"))
    s = s.withColumn("zone", zone).withColumn("day", F.to_date(F.from_utc_timestamp(F.col("start_at"), zone)))
    sums = s.groupBy("user_id", "zone", "day").agg(
        *[F.sum(F.when(F.col("hk_type") == t, F.col("value")).otherwise(F.lit(0.0))).alias(out)
          for t, out in SUMMARY_TYPES])
    span = (sums.groupBy("user_id", "zone").agg(F.min("day").alias("_lo"), F.max("day").alias("_hi"))
            .select("user_id", "zone", F.explode(F.sequence("_lo", "_hi")).alias("day")))
    filled = span.join(sums, ["user_id", "zone", "day"], "left")
    return filled.select("user_id", "zone", "day",
                         *[F.coalesce(F.col(out), F.lit(0.0)).alias(out) for _, out in SUMMARY_TYPES])
