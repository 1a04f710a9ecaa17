from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from vitalake.schemas import BRONZE_COLUMNS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="vitalake-test-ckpt-")
    s = (SparkSession.builder.master("local[4]").appName("vitalake-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.checkpoint.dir", ckpt)
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    yield s


def make_bronze(spark, rows):
    """rows: dicts with record_id, ingested_at (ISO text), body (dict), headers
    (dict), record_type, source_platform, user_id."""
    data = [(r["record_id"], r.get("ingested_at", "2026-01-16T00:00:00Z"), json.dumps(r["body"]),
             json.dumps(r.get("headers", {})), r.get("record_type"), r.get("source_platform", "apple_healthkit"),
             r.get("user_id", "u1")) for r in rows]
    df = spark.createDataFrame(data, "record_id string, ts string, body string, headers string, record_type string, "
                                     "source_platform string, user_id string")
    return df.select("record_id", F.to_timestamp("ts").alias("ingested_at"), F.parse_json("body").alias("body"),
                     F.parse_json("headers").alias("headers"), "record_type", "source_platform",
                     "user_id").select(*BRONZE_COLUMNS)


def cardio_by_outer_joins(spark, samples):
    """The three-outer-join form of the daily cardio table, in SQL."""
    parts = {"resting_hr_avg": "hk_type LIKE '%RestingHeartRate%'", "hrv_sdnn_avg": "hk_type LIKE '%HeartRateVariability%'",
             "spo2_avg": "hk_type LIKE '%OxygenSaturation%'"}
    heart = "hk_type LIKE '%HeartRate%' AND hk_type NOT LIKE '%Resting%'"
    one = "(SELECT user_id, to_date(start_at) AS day, {agg} FROM {{s}} WHERE start_at IS NOT NULL AND {where} GROUP BY ALL)"
    subqueries = [one.format(agg=f"avg(value) AS {n}", where=w) for n, w in parts.items()]
    subqueries.append(one.format(agg="avg(value) AS heart_rate_avg, max(value) AS heart_rate_max", where=heart))
    joined = subqueries[0] + "".join(f" FULL OUTER JOIN {q} USING (user_id, day)" for q in subqueries[1:])
    return spark.sql(f"SELECT * FROM {joined}", s=samples)
