"""Schemas of bronze, the HealthEvent silver and the landing frames."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, MapType, StringType, StructField, StructType,
                               TimestampType, VariantType)

BRONZE_COLUMNS = ["record_id", "ingested_at", "body", "headers", "record_type", "source_platform", "user_id"]

BRONZE = StructType([
    StructField("record_id", StringType(), False),
    StructField("ingested_at", TimestampType(), True),
    StructField("body", VariantType(), True),
    StructField("headers", VariantType(), True),
    StructField("record_type", StringType(), True),
    StructField("source_platform", StringType(), True),
    StructField("user_id", StringType(), True),
])

# Normalised device metric (Garmin cloud, watch batches).
HEALTH_EVENT = StructType([
    StructField("source", StringType(), True),
    StructField("device_id", StringType(), True),
    StructField("metric_type", StringType(), True),
    StructField("value", DoubleType(), True),
    StructField("unit", StringType(), True),
    StructField("recorded_at", TimestampType(), True),
    StructField("ingested_at", TimestampType(), True),
    StructField("metadata", MapType(StringType(), StringType()), True),
])
HEALTH_EVENT_COLUMNS = [f.name for f in HEALTH_EVENT.fields]

# Fixed values (must equal the reference): the record types the ingest
# route knows, and the headers it never stores.
KNOWN_RECORD_TYPES = ["samples", "workouts", "sleep", "activity_summaries", "deletes"]
BLOCKED_HEADERS = ["authorization", "x-forwarded-access-token", "cookie", "set-cookie"]
