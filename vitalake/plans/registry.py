"""Named queries over a scale-factor directory: ``name -> f(spark, sf_dir)``.

Each query reads the bronze landed from the driver's ``events`` table (see
``sources.bronze_store``) and runs the real operator chain on it; nothing is
sampled or capped.  Timestamp
outputs are returned as TIMESTAMP_NTZ (UTC wall clock) so that results
compare equal with engines that have no session time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from ..operators import deletes, garmin, gold, health_connect as hc, marts, ops, quality, sessions, silver
from ..sources import landing
from ..session import checkpoint_dir
from ..functions.labels import SEED_DEVICE_ID, channel_predicate, ingest_channel
from ..session import ensure_session
from ..sources.bindings import bronze_from_dir
from ..sources.bronze_store import bronze_path_for, landed_bronze
from ..streaming import medallion as streaming
from .medallion import Medallion, StoredMedallion
from .oracle import APP_END, APP_START, AS_OF_TS, as_of
from .small_queries import SMALL_QUERIES
from .state_queries import STATE_QUERIES

Query = Callable[[SparkSession, str], DataFrame]


def ntz(df: DataFrame) -> DataFrame:
    cols = [F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def medallion(spark: SparkSession, sf_dir: str) -> Medallion:
    ensure_session(spark)
    return Medallion(landed_bronze(spark, sf_dir))


def stored(spark: SparkSession, sf_dir: str) -> StoredMedallion:
    """Silver and gold of ``sf_dir``, stored beside its bronze."""
    ensure_session(spark)
    bronze = landed_bronze(spark, sf_dir)
    return StoredMedallion(bronze, bronze_path_for(spark, sf_dir) + "-layers")


def _tile(build: Callable[[SparkSession, Medallion], DataFrame]) -> Query:
    """A view, tile or app query: reads stored layers."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ntz(build(spark, stored(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


def _q(build: Callable[[SparkSession, Medallion], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ntz(build(spark, medallion(spark, sf_dir)))
    run.__doc__ = build.__doc__
    return run


W = (APP_START, APP_END)

MEDALLION_QUERIES: dict[str, Query] = {
    # silver (P4-P9, W5)
    "silver_events": _q(lambda s, m: m.events),
    "silver_samples": _q(lambda s, m: m.samples),
    "silver_workouts": _q(lambda s, m: m.workouts),
    "silver_sleep_stages": _q(lambda s, m: m.sleep_stages),
    "silver_rings": _q(lambda s, m: m.rings),
    "silver_deletes": _q(lambda s, m: m.deletes),
    # gold (G1-G10, J1, J2)
    "g_hk_daily": _q(lambda s, m: m.hk_quantity_daily),
    "g_subject_daily": _q(lambda s, m: m.subject_daily),
    "g_daily_steps": _q(lambda s, m: m.daily_steps),
    "g_activity_enriched": _q(lambda s, m: m.activity_enriched),
    "g_sleep_nightly": _q(lambda s, m: m.sleep_nightly),
    "g_weekly_workouts": _q(lambda s, m: m.weekly_workouts),
    "g_cardio_vitals": _q(lambda s, m: m.cardio_vitals),
    "g_hr_intraday": _q(lambda s, m: m.hr_intraday),
    "g_ingest_daily": _q(lambda s, m: m.ingest_daily),
    "g_family_weekly": _q(lambda s, m: m.family_weekly),
    # views (L5, W1)
    "vw_activity_45d": _tile(lambda s, m: gold.activity_last_days(m.activity_enriched, as_of(45), 45)),
    "vw_sleep_30": _tile(lambda s, m: gold.sleep_last_nights(m.sleep_nightly, 30)),
    "vw_sleep_5": _tile(lambda s, m: gold.sleep_last_nights(m.sleep_nightly, 5)),
    "vw_workouts_12w": _tile(lambda s, m: gold.workouts_recent(m.weekly_workouts, as_of(84), 84)),
    # dashboard tiles
    "dash_01_ingest_overview": _tile(lambda s, m: marts.bronze_ingest_overview(m.bronze)),
    "dash_02_hk_quantity_30d": _tile(lambda s, m: marts.hk_quantity_recent(m.hk_quantity_daily, as_of(30), 30)),
    "dash_03_recent_workouts": _tile(lambda s, m: marts.recent_workouts(m.workouts, AS_OF_TS, 14, 200)),
    "dash_04_sleep_stage_minutes": _tile(lambda s, m: marts.sleep_stage_minutes(m.sleep_stages)),
    "dash_05_ring_adherence": _tile(lambda s, m: marts.ring_adherence(m.rings, as_of(30), 30)),
    "dash_06_silver_gold_volumes": _tile(lambda s, m: marts.volumes(m.silver_volumes())),
    "dash_07_seed_footprint": _tile(lambda s, m: marts.seed_footprint(m.bronze)),
    "dash_08_bronze_freshness": _tile(lambda s, m: marts.bronze_freshness(m.bronze, AS_OF_TS)),
    "dash_09_gold_volumes": _tile(lambda s, m: marts.volumes(m.gold_volumes())),
    "dash_10_activity_60d": _tile(lambda s, m: marts.activity_recent(m.activity_enriched, as_of(60), 60)),
    "dash_11_sleep_90d": _tile(lambda s, m: marts.sleep_recent(m.sleep_nightly, as_of(90), 90)),
    "dash_12_ingest_by_type_90d": _tile(lambda s, m: marts.ingest_by_type_recent(m.ingest_daily, as_of(90), 90)),
    # parameterised app queries
    "app_activity_trend": _tile(lambda s, m: marts.activity_trend(s, m.activity_enriched, *W)),
    "app_ingest_daily_trend": _tile(lambda s, m: marts.ingest_daily_trend(s, m.bronze, *W)),
    "app_ingest_mix": _tile(lambda s, m: marts.ingest_mix(s, m.ingest_daily, *W)),
    "app_dashboard_kpis": _tile(lambda s, m: marts.dashboard_kpis(s, m.bronze, m.activity_enriched, m.daily_steps, *W)),
    "app_sleep_summary": _tile(lambda s, m: marts.sleep_summary(s, m.sleep_nightly, *W)),
    "app_steps_leaderboard": _tile(lambda s, m: marts.steps_leaderboard(s, m.daily_steps, *W)),
    "app_rhr_trend": _tile(lambda s, m: marts.rhr_trend(s, m.cardio_vitals, *W)),
    "app_workout_volume": _tile(lambda s, m: marts.workout_volume_by_user(s, m.weekly_workouts, *W)),
    # P36 with a user search and swapped window bounds; P37 with one record type
    "app_activity_trend_search": _tile(lambda s, m: marts.activity_trend(s, m.activity_enriched, APP_END, APP_START, "1")),
    "app_ingest_mix_samples": _tile(lambda s, m: marts.ingest_mix(s, m.ingest_daily, *W, record_type="samples")),
    # notebook checks
    "seed_counts": _q(lambda s, m: marts.seed_counts_by_user_type(m.bronze)),
    "platform_types": _q(lambda s, m: marts.platform_type_counts(m.bronze)),
    "record_spans": _q(lambda s, m: marts.record_type_span(m.bronze)),
}


def _seed_rows(m: Medallion) -> DataFrame:
    return marts.bronze_seed_slice(m.bronze)


JOIN_QUERIES: dict[str, Query] = {
    # Ingest channel of every bronze row, and a channel-filtered silver flow
    "ingest_channels": _q(lambda s, m: m.bronze.groupBy(ingest_channel().alias("channel"), "record_type")
                          .agg(F.count(F.lit(1)).alias("rows"))),
    "samples_simulator_channel": _q(lambda s, m: silver.samples(m.bronze.filter(channel_predicate("notebook_simulator")))),
    # Sleep stages grouped into gap-based sessions per user
    "sleep_sessions": _q(lambda s, m: sessions.sleep_sessions(
        m.sleep_stages, start="stage_start_at", end="stage_end_at", tie="stage_uuid")),
    "sleep_session_stages": _q(lambda s, m: sessions.session_stages(
        m.sleep_stages, start="stage_start_at", end="stage_end_at", tie="stage_uuid")),
    # Deletes applied (remove / flag)
    "samples_live": _q(lambda s, m: deletes.apply_deletes(m.samples, m.deletes, "hk_uuid")),
    "workouts_live": _q(lambda s, m: deletes.apply_deletes(m.workouts, m.deletes, "workout_uuid")),
    "samples_flagged": _q(lambda s, m: deletes.apply_deletes(m.samples, m.deletes, "hk_uuid", "flag")
                          .select("hk_uuid", "user_id", "hk_type", "is_deleted")),
    # Staged ids visible in bronze
    "verify_inserted": _q(lambda s, m: deletes.verify_inserted(m.bronze, _seed_rows(m))),
    # User resolved through the device registry
    "user_by_device": _q(lambda s, m: deletes.attribute_user_by_device(
        m.bronze, deletes.device_registry(m.bronze, SEED_DEVICE_ID), SEED_DEVICE_ID)
        .select("record_id", "user_id", "device_id", "resolved_user_id")),
    # X6 batch: latest version per sample from the raw change log, minus deletes
    "samples_current": _q(lambda s, m: deletes.current_state(
        silver.samples(m.bronze, "none"), m.deletes, "hk_uuid", ("ingested_at", "record_id"))),
}


def _stream(spark: SparkSession, sf_dir: str, flows: tuple[str, ...], dedup: str = "exact") -> tuple[str, Medallion]:
    m = medallion(spark, sf_dir)  # lands the bronze table if needed
    root = streaming.run_available_now(spark, bronze_path_for(spark, sf_dir), flows=flows, dedup=dedup)
    return root, m


def stream_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples flow run as a triggered stream (exact dedup)."""
    root, _ = _stream(spark, sf_dir, ("samples",))
    return ntz(streaming.read_sink(spark, root, "samples").drop("record_id", "ingested_at"))


def stream_samples_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same flow with state bounded by the watermark (T4)."""
    root, _ = _stream(spark, sf_dir, ("samples",), "bounded")
    return ntz(streaming.read_sink(spark, root, "samples").drop("record_id", "ingested_at"))


def stream_event_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events flow as a stream; the surviving key set (which copy survives a
    same-batch duplicate is not ordered, T7)."""
    root, _ = _stream(spark, sf_dir, ("events",))
    return streaming.read_sink(spark, root, "events").select("event_id")


def stream_gold_hk_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold computed in batch from the streaming silver sink."""
    root, m = _stream(spark, sf_dir, ("samples",))
    return ntz(streaming.gold_from_sinks(spark, root, m.bronze, ("samples",)).hk_quantity_daily)


def stream_gold_sleep_nightly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X4 over the sleep-stage flow.  ``sleep_sessions`` counts record ids,
    and which copy of a resent stage survives a micro-batch is not ordered,
    so only the copy-independent minutes are returned."""
    root, m = _stream(spark, sf_dir, ("sleep_stages",))
    return ntz(streaming.gold_from_sinks(spark, root, m.bronze, ("sleep_stages",)).sleep_nightly.drop("sleep_sessions"))


def stream_bronze_mirror(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze mirror, a few files a micro-batch."""
    medallion(spark, sf_dir)
    root = streaming.run_bronze_mirror(spark, bronze_path_for(spark, sf_dir), max_files_per_trigger=2)
    return ntz(streaming.read_sink(spark, root, "bronze").select("record_id", "record_type", "user_id", "ingested_at"))


STREAM_QUERIES: dict[str, Query] = {
    "stream_bronze_mirror": stream_bronze_mirror,
    "stream_samples": stream_samples,
    "stream_samples_bounded": stream_samples_bounded,
    "stream_event_keys": stream_event_keys,
    "stream_gold_hk_daily": stream_gold_hk_daily,
    "stream_gold_sleep_nightly": stream_gold_sleep_nightly,
}


def _platform(kind: str, build: Callable[[SparkSession, DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_session(spark)
        return ntz(build(spark, landed_bronze(spark, sf_dir, kind)))
    run.__doc__ = build.__doc__
    return run


def _events_out(df: DataFrame) -> DataFrame:
    return df.withColumn("metadata_json", F.to_json("metadata")).drop("metadata")


WATCH_SINCE = "2024-01-15 00:00:00"

PLATFORM_QUERIES: dict[str, Query] = {
    # Garmin cloud
    "garmin_events": _platform("garmin", lambda s, b: _events_out(garmin.garmin_events(b))),
    "garmin_bronze_rows": _platform("garmin", lambda s, b: b.select(
        "record_id", "ingested_at", "record_type", "source_platform", "user_id",
        marts.platform_of_headers().alias("platform"),
        F.try_variant_get("headers", "$['X-Device-Id']", "string").alias("device_id"),
        F.try_variant_get("body", "$.date", "string").alias("day"))),
    "garmin_daily_view": _platform("garmin", lambda s, b: garmin.garmin_daily_view(b)),
    "garmin_sleep_view": _platform("garmin", lambda s, b: garmin.garmin_sleep_view(b)),
    "garmin_hrv_view": _platform("garmin", lambda s, b: garmin.garmin_hrv_view(b)),
    "garmin_record_spans": _platform("garmin", lambda s, b: marts.record_type_span(b, by_body_date=True)),
    # Garmin watch
    "watch_events": _platform("watch", lambda s, b: _events_out(garmin.explode_watch_batch(b))),
    "watch_incremental": _platform("watch", lambda s, b: _events_out(
        garmin.incremental_since(garmin.explode_watch_batch(b), WATCH_SINCE))),
    "watch_incremental_capped": _platform("watch", lambda s, b: _events_out(
        garmin.incremental_since(garmin.explode_watch_batch(b), WATCH_SINCE, cap=5))),
    # Health Connect
    "hc_samples": _platform("health_connect", lambda s, b: hc.hc_samples(s, b)),
    "hc_workouts": _platform("health_connect", lambda s, b: hc.hc_workouts(s, b)),
    "hc_sleep_stages": _platform("health_connect", lambda s, b: hc.hc_sleep_stages(s, b)),
    "hc_daily_summaries": _platform("health_connect", lambda s, b: hc.hc_daily_summaries(b)),
    "hc_deletes": _platform("health_connect", lambda s, b: hc.hc_deletes(b)),
    "hc_daily_from_samples": _platform("health_connect", lambda s, b: hc.daily_summary_from_samples(hc.hc_samples(s, b))),
    # P10: one cross-platform samples table (HealthKit + Health Connect)
    "samples_all_platforms": lambda s, d: ntz(
        medallion(s, d).samples.withColumn("platform", F.lit("apple_healthkit"))
        .unionByName(hc.hc_samples(s, landed_bronze(s, d, "health_connect")).drop("zone_offset")
                     .withColumn("platform", F.lit(hc.HC_PLATFORM)))),
}


def _landing(spark: SparkSession, sf_dir: str) -> str:
    """Request files written from the rows of bronze, as they are derived: storing the table first is no part of it."""
    ensure_session(spark)
    path = bronze_path_for(spark, sf_dir) + "-requests"
    if not landing._exists_success(spark, path):
        from ..sources.bronze_store import publish_atomically
        publish_atomically(spark, path, lambda tmp: landing.land_request_files(bronze_from_dir(spark, sf_dir), tmp))
    return path


def _request_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return landing.parse_lines(landing.with_credentials(landing.read_request_lines(spark, _landing(spark, sf_dir))))


def ndjson_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every landed row: id, user, what its body is about, its headers."""
    b = landing.build_bronze(_request_lines(spark, sf_dir)[0])
    get = lambda col, path, kind="string": F.try_variant_get(col, path, kind)
    headers = F.map_keys(F.try_variant_get("headers", "$", "map<string,string>"))
    return ntz(b.select(
        "record_id", "ingested_at", "record_type", "source_platform", "user_id",
        F.coalesce(get("body", "$.uuid"), get("body", "$.date"), get("body", "$.start_date")).alias("body_id"),
        F.coalesce(get("body", "$.value", "double"), get("body", "$.active_energy_burned_kcal", "double")).alias("body_value"),
        get("body", "$.demo_user_id").isNotNull().alias("has_override"), F.array_join(F.array_sort(headers), ",").alias("header_names")))


def ndjson_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every parse error with its place."""
    return _request_lines(spark, sf_dir)[1]


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.read_request_log(spark, _landing(spark, sf_dir), landing.with_credentials)


def _newest_requests(spark: SparkSession, path: str) -> DataFrame:
    """The newest request of each type; no body is read for it."""
    requests = landing.with_credentials(landing.list_requests(spark, path))
    return requests.groupBy(landing.record_type_of(F.col("headers")).alias("record_type")).agg(
        F.max_by("request_id", F.struct("received_at", "request_id")).alias("request_id"))


def last_payload_per_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest payload of each type, by its number of lines and the user its first line names.
    Only the newest request of each type is read as a whole."""
    path = _landing(spark, sf_dir)
    newest = _newest_requests(spark, path).select("request_id")  # a row a type
    wanted = landing.read_request_files(spark, path).join(F.broadcast(newest), "request_id", "left_semi")
    out = ops.last_payload_per_type(landing.request_log(landing.with_credentials(wanted)))
    first = F.regexp_extract("last_payload", '^\\{"demo_user_id":"([^"]*)"', 1)
    return ntz(out.select("record_type", "last_timestamp", F.size(F.split(F.rtrim(F.regexp_replace("last_payload", "\n$", "")), "\n")).alias("payload_lines"),
                          first.alias("first_user")))


OPS_QUERIES: dict[str, Query] = {
    "ndjson_landing": ndjson_landing,
    "ndjson_errors": ndjson_errors,
    "quality_checks": _q(lambda s, m: quality.ingest_quality_checks(
        m.bronze, marts.bronze_seed_slice(m.bronze).select("record_id"), "apple_healthkit")),
    "sync_stats": _q(lambda s, m: ops.sync_stats(m.bronze)),
    # R24 client side (T21): records sent per type from the request log
    "sync_stats_client": lambda s, d: ntz(ops.sync_stats_from_log(_log(s, d))),
    "ingest_metrics": lambda s, d: ntz(ops.ingest_metrics(_log(s, d))[0]),
    "ingest_by_type": lambda s, d: ops.ingest_metrics(_log(s, d))[1],
    "last_payload_per_type": last_payload_per_type,
    "recent_requests": lambda s, d: ntz(ops.recent_events(_log(s, d), 20)),
    "batch_chunks": _q(lambda s, m: landing.batch_chunks(m.bronze.select("record_id", "record_type", "ingested_at"), 2000)
                       .groupBy("record_type", "batch_no").agg(F.count(F.lit(1)).alias("records"))),
}


def _ntz_out(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ntz(build(spark, sf_dir))
    run.__doc__ = build.__doc__
    return run


def queries() -> dict[str, Query]:
    stepwise = {name: _ntz_out(build) for name, build in (STATE_QUERIES | SMALL_QUERIES).items()}
    return {**MEDALLION_QUERIES, **JOIN_QUERIES, **STREAM_QUERIES, **stepwise, **PLATFORM_QUERIES, **OPS_QUERIES}
