"""Bronze -> silver projections (P4-P9, P14) and de-duplication.

The same functions serve batch and streaming: they only ``filter`` and
``select``.  De-duplication is chosen by ``dedup``:

* ``"first"``  (batch, W5): earliest ``ingested_at`` then ``record_id`` per
  key, as a ``groupBy`` + ``min_by`` aggregate.  That aggregate is computed
  map-side first, so a hot key (one key with a third of the rows) is
  collapsed before the shuffle instead of landing whole in one task as a
  ``row_number`` window would.
* ``"exact"``  (stream): ``withWatermark`` + ``dropDuplicates([key])`` --
  the reference's form; state is never evicted (T4).
* ``"bounded"`` (stream): ``dropDuplicatesWithinWatermark([key])`` -- state
  evicted past the watermark.
* ``"none"``: keep every row.

``watermark`` replaces the flow's fixed watermark in the two stream modes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.variant import body_dbl, body_long, body_str, parse_ts

# Fixed values (must equal the reference): watermarks per flow.
WATERMARKS = {"bronze": "72 hours", "events": "48 hours", "samples": "36 hours", "workouts": "48 hours",
              "sleep_stages": "48 hours", "rings": "48 hours", "deletes": "48 hours"}

STAGE_SCHEMA = "array<struct<uuid string, stage string, start_date string, end_date string>>"


def first_arrival(df: DataFrame, keys: list[str], order: tuple[str, ...] = ("ingested_at", "record_id")) -> DataFrame:
    """One row per key, the earliest by ``order`` (skew-safe aggregate)."""
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_first"))
    return agg.select(*[F.col(k) for k in keys], *[F.col(f"_first.{c}").alias(c) for c in rest]).select(*df.columns)


def dedup(df: DataFrame, key: str | list[str], mode: str, watermark: str,
          order: tuple[str, ...] = ("ingested_at", "record_id")) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    if mode == "none":
        return df
    if mode == "first":
        return first_arrival(df, keys, order)
    if mode == "exact":
        return df.withWatermark("ingested_at", watermark).dropDuplicates(keys)
    if mode == "bounded":
        return df.withWatermark("ingested_at", watermark).dropDuplicatesWithinWatermark(keys)
    raise ValueError(f"unknown dedup mode {mode!r}")


def _of_type(bronze: DataFrame, record_type: str) -> DataFrame:
    return bronze.filter(F.col("record_type") == F.lit(record_type))


def events(bronze: DataFrame, dedup_mode: str = "first", watermark: str | None = None) -> DataFrame:
    """One normalised event row per bronze document, any record type."""
    event_id = F.coalesce(body_str("$.uuid"), F.col("record_id"))
    metric_type = F.coalesce(
        body_str("$.type"), body_str("$.sample_type"), body_str("$.activity_type"),
        F.when(F.col("record_type") == "sleep", F.lit("sleep"))
        .when(F.col("record_type") == "activity_summaries", F.lit("activity_summary"))
        .otherwise(F.col("record_type")),
    )
    effective = F.coalesce(parse_ts(body_str("$.start_date")), parse_ts(body_str("$.end_date")), F.col("ingested_at"))
    value_number = F.coalesce(*[body_dbl(p) for p in (
        "$.value", "$.duration_seconds", "$.total_energy_burned_kcal", "$.total_distance_meters",
        "$.active_energy_burned_kcal", "$.exercise_minutes", "$.stand_hours")])
    out = bronze.select(
        "record_id", "ingested_at", "record_type", "source_platform", "user_id",
        event_id.alias("event_id"), F.col("user_id").alias("subject_id"), metric_type.alias("metric_type"),
        effective.alias("effective_time"), value_number.alias("value_number"),
    ).filter(F.col("event_id").isNotNull() & F.col("metric_type").isNotNull())
    return dedup(out, "event_id", dedup_mode, watermark or WATERMARKS["events"])


def samples(bronze: DataFrame, dedup_mode: str = "first", watermark: str | None = None) -> DataFrame:
    """P5: HealthKit quantity samples."""
    out = _of_type(bronze, "samples").select(
        "record_id", "ingested_at", "user_id",
        F.coalesce(body_str("$.uuid"), F.col("record_id")).alias("hk_uuid"),
        body_str("$.type").alias("hk_type"),
        body_str("$.unit").alias("hk_unit"),
        body_dbl("$.value").alias("value"),
        parse_ts(body_str("$.start_date")).alias("start_at"),
        parse_ts(body_str("$.end_date")).alias("end_at"),
        body_str("$.source_name").alias("source_name"),
    ).filter(F.col("hk_type").isNotNull())
    return dedup(out, "hk_uuid", dedup_mode, watermark or WATERMARKS["samples"])


def workouts(bronze: DataFrame, dedup_mode: str = "first", watermark: str | None = None) -> DataFrame:
    """Typed workouts."""
    out = _of_type(bronze, "workouts").select(
        "record_id", "ingested_at", "user_id",
        F.coalesce(body_str("$.uuid"), F.col("record_id")).alias("workout_uuid"),
        body_str("$.activity_type").alias("activity_type"),
        body_long("$.activity_type_raw").alias("activity_type_raw"),
        parse_ts(body_str("$.start_date")).alias("start_at"),
        parse_ts(body_str("$.end_date")).alias("end_at"),
        body_dbl("$.duration_seconds").alias("duration_seconds"),
        body_dbl("$.total_energy_burned_kcal").alias("total_energy_burned_kcal"),
        body_dbl("$.total_distance_meters").alias("total_distance_meters"),
        body_str("$.source_name").alias("source_name"),
    )
    return dedup(out, "workout_uuid", dedup_mode, watermark or WATERMARKS["workouts"])


def sleep_stages(bronze: DataFrame, dedup_mode: str = "first", watermark: str | None = None) -> DataFrame:
    """One row per stage; a stage without uuid gets sha256(record|stage|start)."""
    parsed = _of_type(bronze, "sleep").select(
        F.col("record_id").alias("sleep_record_id"), "ingested_at", "user_id",
        parse_ts(body_str("$.start_date")).alias("session_start_at"),
        parse_ts(body_str("$.end_date")).alias("session_end_at"),
        F.try_variant_get(F.col("body"), "$.stages", STAGE_SCHEMA).alias("stages"),
    ).filter(F.size("stages") > 0)
    st = parsed.select("sleep_record_id", "ingested_at", "user_id", "session_start_at", "session_end_at",
                       F.explode("stages").alias("st"))
    out = st.select(
        "sleep_record_id", "ingested_at", "user_id", "session_start_at", "session_end_at",
        F.coalesce(F.col("st.uuid"), F.sha2(F.concat_ws("|", F.col("sleep_record_id"), F.col("st.stage"),
                                                         F.col("st.start_date")), 256)).alias("stage_uuid"),
        F.col("st.stage").alias("sleep_stage"),
        parse_ts(F.col("st.start_date")).alias("stage_start_at"),
        parse_ts(F.col("st.end_date")).alias("stage_end_at"),
    )
    return dedup(out, "stage_uuid", dedup_mode, watermark or WATERMARKS["sleep_stages"], ("ingested_at", "sleep_record_id"))


def activity_rings(bronze: DataFrame, dedup_mode: str = "first", natural_key: bool = False,
                   watermark: str | None = None) -> DataFrame:
    """Daily ring summaries.  T5: the reference keys on record_id, so a
    re-sent day is kept twice; ``natural_key=True`` keeps the latest per
    (user_id, summary_date) instead."""
    out = _of_type(bronze, "activity_summaries").select(
        "record_id", "ingested_at", "user_id",
        F.try_to_date(body_str("$.date")).alias("summary_date"),
        body_dbl("$.active_energy_burned_kcal").alias("active_energy_burned_kcal"),
        body_dbl("$.active_energy_burned_goal_kcal").alias("active_energy_burned_goal_kcal"),
        body_dbl("$.exercise_minutes").alias("exercise_minutes"),
        body_dbl("$.exercise_minutes_goal").alias("exercise_minutes_goal"),
        body_long("$.stand_hours").alias("stand_hours"),
        body_long("$.stand_hours_goal").alias("stand_hours_goal"),
    ).filter(F.col("summary_date").isNotNull())
    if natural_key:
        rest = [c for c in out.columns if c not in ("user_id", "summary_date")]
        latest = out.groupBy("user_id", "summary_date").agg(
            F.max_by(F.struct(*rest), F.struct("ingested_at", "record_id")).alias("_l"))
        return latest.select("user_id", "summary_date", "_l.*").select(*out.columns)
    return dedup(out, "record_id", dedup_mode, watermark or WATERMARKS["rings"])


def deletes(bronze: DataFrame, dedup_mode: str = "first", watermark: str | None = None) -> DataFrame:
    """Delete notices."""
    out = _of_type(bronze, "deletes").select(
        "record_id", "ingested_at", "user_id",
        body_str("$.uuid").alias("deleted_uuid"),
        body_str("$.sample_type").alias("deleted_sample_type"),
    )
    return dedup(out, "record_id", dedup_mode, watermark or WATERMARKS["deletes"])


def category_samples(df: DataFrame, value_col: str = "value") -> DataFrame:
    """A category sample (integer category value) as a quantity-shaped
    row: value cast to double, unit ``category``."""
    return df.withColumn("value", F.col(value_col).cast("double")).withColumn("unit", F.lit("category"))


SILVER = {
    "events": events,
    "samples": samples,
    "workouts": workouts,
    "sleep_stages": sleep_stages,
    "rings": activity_rings,
    "deletes": deletes,
}
