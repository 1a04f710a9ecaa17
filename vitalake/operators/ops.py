"""Operational rollups: sync statistics, ingest metrics (R24, R25) and the
latest-per-key helpers (W3, W4).

All are aggregates over bronze or the request log; latest-per-key uses ``max_by`` (a partial aggregate) rather than a window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.variant import body_str


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key (max_by on a struct, skew-safe)."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_l"))
            .select(*keys, "_l.*").select(*df.columns))


def sync_stats(bronze: DataFrame) -> DataFrame:
    """Per record type and breakdown key (sample type, workout type,
    deleted type; sleep and summaries by record type): records, last time."""
    key = F.coalesce(body_str("$.type"), body_str("$.activity_type"), body_str("$.exercise_type"),
                     body_str("$.sample_type"), F.when(F.col("record_type") == "deletes", body_str("$.record_type")),
                     F.col("record_type"))
    return (bronze.groupBy("record_type", key.alias("breakdown"))
            .agg(F.count(F.lit(1)).alias("records"), F.max("ingested_at").alias("last_sync_at")))


def sync_stats_from_log(log: DataFrame, success_only: bool = True) -> DataFrame:
    """R24 from the client side: per record type, records sent and the last
    sync time.  T21: one client counts only successful posts
    (``success_only=True``), the other every attempt."""
    rows = log.filter(F.col("success")) if success_only else log
    return (rows.groupBy("record_type")
            .agg(F.sum("record_count").cast("bigint").alias("records"), F.max("timestamp").alias("last_sync_at")))


def last_payload_per_type(log: DataFrame) -> DataFrame:
    """Newest payload per record type."""
    return (log.groupBy("record_type")
            .agg(F.max_by("ndjson_payload", F.struct("timestamp", "request_id")).alias("last_payload"),
                 F.max("timestamp").alias("last_timestamp")))


def recent_events(log: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` newest log entries (the feature is the limit)."""
    return (log.select("request_id", "record_type", "timestamp", "record_count", "http_status_code", "success")
            .orderBy(F.col("timestamp").desc(), F.col("request_id").desc()).limit(n))


def ingest_metrics(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(snapshot row, per-type rows sorted by records)."""
    ok = F.col("success")
    snap = log.agg(
        F.count_if(ok).alias("successful_ingests"), F.count_if(~ok).alias("failed_ingests"),
        F.coalesce(F.sum(F.when(ok, F.col("record_count"))), F.lit(0)).cast("bigint").alias("total_records_ingested"),
        F.max(F.when(ok, F.col("timestamp"))).alias("last_ingest_at"),
        F.max(F.when(~ok, F.col("timestamp"))).alias("last_error_at"),
        F.max_by(F.when(~ok, F.col("message")), F.when(~ok, F.struct("timestamp", "request_id"))).alias("last_error_message"))
    by_type = (log.filter(ok).groupBy("record_type")
               .agg(F.count(F.lit(1)).alias("requests"), F.sum("record_count").cast("bigint").alias("records"))
               .orderBy(F.col("records").desc(), "record_type"))
    return snap, by_type
