"""Queries of the small operators that no larger query shows by itself."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dims
from ..functions.labels import display_label, session_duration_seconds
from ..functions.variant import body_str, header, str_map
from ..operators import silver
from ..schemas import BRONZE_COLUMNS
from ..session import checkpoint_dir, ensure_session
from ..sources import landing
from ..sources.bronze_store import landed_bronze, read_bronze
from .medallion import Medallion


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session(spark)
    return landed_bronze(spark, sf_dir)


def sample_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label, canonical unit and category shape of every sample."""
    rows = dims.canonical_unit(spark, Medallion(_bronze(spark, sf_dir)).samples.select("hk_uuid", "hk_type", "value"))
    return (silver.category_samples(rows.withColumn("value", F.floor("value"))).withColumnRenamed("unit", "category_unit")
            .select("hk_uuid", display_label().alias("label"), "canonical_unit", "category_unit", "value"))


def workout_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of every workout from its ends."""
    return Medallion(_bronze(spark, sf_dir)).workouts.select("workout_uuid", session_duration_seconds(F.col("start_at"), F.col("end_at")).alias("seconds"))


def header_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The headers of every row as a map of strings, in the order of their names."""
    entries = F.array_sort(F.map_entries(str_map("headers")))
    return _bronze(spark, sf_dir).select("record_id", F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("headers"))


def staged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows staged as JSON text, appended in two batches and read back as variants."""
    bronze = _bronze(spark, sf_dir)
    staged = bronze.withColumns({"body_json": F.to_json("body"), "headers_json": F.to_json("headers")}).drop("body", "headers")
    path = f"{checkpoint_dir(spark)}/staged/{uuid.uuid4().hex}"
    for half in (0, 1):
        landing.append_json_staging(staged.filter(F.pmod(F.crc32(F.col("record_id").cast("binary")), F.lit(2)) == half), path)
    return read_bronze(spark, path).select("record_id", "record_type", "user_id", "ingested_at", header("x-device-id").alias("device_id"),
                                           F.coalesce(body_str("$.uuid"), body_str("$.date"), body_str("$.start_date")).alias("body_id"))


def evolved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table created with the bronze columns, then given a device column; old rows read NULL there."""
    bronze, name = _bronze(spark, sf_dir), f"evolving_{uuid.uuid4().hex}"
    table = f"{checkpoint_dir(spark)}/evolving/{name}"
    landing.create_bronze(spark, name, table)
    old = F.col("record_type") == "deletes"
    bronze.filter(old).select(*[c for c in BRONZE_COLUMNS if c != "record_type"], "record_type").write.insertInto(name)
    landing.evolve_bronze(spark, name, {"device_id": "STRING"})
    columns = spark.table(name).columns
    bronze.filter(~old).withColumn("device_id", header("x-device-id")).select(*columns).write.insertInto(name)
    return landing.union_evolving([spark.table(name), bronze.limit(0)]).select("record_id", "record_type", "user_id", "device_id")


def ndjson_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per row, keys sorted, NULL fields left out."""
    rows = _bronze(spark, sf_dir).select("record_id", "record_type", "user_id", header("x-ingest-channel").alias("channel"))
    return rows.select("record_id", landing.ndjson_line(rows).alias("line"))


SMALL_QUERIES = {"sample_labels": sample_labels, "workout_spans": workout_spans, "header_maps": header_maps,
                 "staged_rows": staged_rows, "evolved_rows": evolved_rows, "ndjson_lines": ndjson_lines}
