"""Structured Streaming form of the medallion.

The silver functions in ``operators.silver`` are plain ``select``/``filter``
chains, so the streaming flows are the same functions applied to a
streaming bronze with a streaming de-duplication mode:

* ``bronze_stream`` (S7): file stream over the stored bronze table with the
  channel filter (P2) and an optional bronze watermark;
* ``start_silver_flows`` (S13, X3): one query per silver table, each with
  its own checkpoint, append output to a parquet sink;
* ``trigger`` (X5): ``availableNow`` (triggered refresh) or a processing-time
  interval (continuous);
* watermarks and dedup (X1, X2, X7): ``dedup="exact"`` is the reference's
  ``dropDuplicates(key)`` (state never evicted, T4); ``"bounded"`` is
  ``dropDuplicatesWithinWatermark(key)``.  Rows older than the watermark
  are dropped by the stateful operator.  Files come in no order of
  ``ingested_at``, so a silver flow takes what has landed since its last run as
  one micro-batch, in which nothing is late; where the caller caps the files of a
  micro-batch, the watermark is widened by the time span of the whole table,
  and no row that had landed when the flow started is late either;
* ``gold_from_sinks`` (X4): the stream-static boundary -- gold is a batch
  read of the silver sinks after each run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.labels import channel_predicate
from ..operators import silver
from ..operators.sessions import GAP_SECONDS
from ..plans.medallion import Medallion
from ..schemas import BRONZE, BRONZE_COLUMNS
from ..session import checkpoint_dir

#: files that one micro-batch of the mirror takes in at most (it drops no late row), so that a backlog is worked off in steps
FILES_PER_TRIGGER = 500
SILVER_FLOWS = ("events", "samples", "workouts", "sleep_stages", "rings", "deletes")


def bronze_stream(spark: SparkSession, path: str, channel: str = "all", watermark: str | None = None,
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """Continuous read of the bronze table (VARIANT schema given, no
    inference), channel filter, optional watermark, 7-column projection."""
    reader = spark.readStream.schema(BRONZE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    df = reader.parquet(path).filter(channel_predicate(channel))
    if watermark:
        df = df.withWatermark("ingested_at", watermark)
    return df.select(*BRONZE_COLUMNS)


def _trigger(writer, trigger: str):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger == "once":
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def start_flow(df: DataFrame, sink: str, checkpoint: str, trigger: str = "availableNow",
               name: str | None = None) -> StreamingQuery:
    """Append a streaming frame to a parquet sink with its own checkpoint."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", sink).option("checkpointLocation", checkpoint))
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


def landed_span(spark: SparkSession, path: str) -> int:
    """Seconds between the oldest and the newest row of a bronze table, rounded up."""
    at = F.unix_micros("ingested_at")
    return spark.read.schema(BRONZE).parquet(path).agg(
        F.ceil((F.max(at) - F.min(at)) / 1e6).cast("long").alias("span")).first().span or 0


def start_silver_flows(spark: SparkSession, bronze_path: str, root: str | None = None, dedup: str = "bounded",
                       trigger: str = "availableNow", channel: str = "all",
                       flows: tuple[str, ...] = SILVER_FLOWS, max_files_per_trigger: int | None = None
                       ) -> dict[str, StreamingQuery]:
    """Fan one bronze stream out to one append flow per silver table."""
    root = (root or f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}").rstrip("/")
    span = landed_span(spark, bronze_path) if max_files_per_trigger and dedup in ("exact", "bounded") else 0
    out = {}
    for flow in flows:
        b = bronze_stream(spark, bronze_path, channel, max_files_per_trigger=max_files_per_trigger)
        df = silver.SILVER[flow](b, dedup, watermark=f"{silver.WATERMARKS[flow]} {span} seconds")
        out[flow] = start_flow(df, f"{root}/tables/{flow}", f"{root}/checkpoints/{flow}", trigger)
    return out


def run_available_now(spark: SparkSession, bronze_path: str, root: str | None = None, dedup: str = "bounded",
                      flows: tuple[str, ...] = SILVER_FLOWS, max_files_per_trigger: int | None = None) -> str:
    """Triggered refresh (X5): process everything landed so far, then stop."""
    root = (root or f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}").rstrip("/")
    qs = start_silver_flows(spark, bronze_path, root, dedup, "availableNow", flows=flows,
                            max_files_per_trigger=max_files_per_trigger)
    for q in qs.values():
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return root


def run_bronze_mirror(spark: SparkSession, bronze_path: str, root: str | None = None,
                      max_files_per_trigger: int | None = FILES_PER_TRIGGER) -> str:
    """The bronze table as a stream under its 72 h watermark, appended
    to a mirror table partitioned by record type."""
    root = (root or f"{checkpoint_dir(spark)}/streams/{uuid.uuid4().hex}").rstrip("/")
    b = bronze_stream(spark, bronze_path, watermark=silver.WATERMARKS["bronze"], max_files_per_trigger=max_files_per_trigger)
    w = (b.writeStream.format("parquet").outputMode("append").partitionBy("record_type")
         .option("path", f"{root}/tables/bronze").option("checkpointLocation", f"{root}/checkpoints/bronze"))
    q = _trigger(w, "availableNow").start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return root


def read_sink(spark: SparkSession, root: str, flow: str) -> DataFrame:
    return spark.read.parquet(f"{root}/tables/{flow}")


def gold_from_sinks(spark: SparkSession, root: str, bronze: DataFrame,
                    flows: tuple[str, ...] = SILVER_FLOWS) -> Medallion:
    """A batch Medallion whose silver layer is the streaming sinks of
    ``flows`` (the other silver tables stay batch projections of bronze)."""
    m = Medallion(bronze)
    for flow in flows:
        m.__dict__[flow] = read_sink(spark, root, flow)
    return m


def stream_sleep_sessions(stages: DataFrame, watermark: str = "48 hours", gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Sleep sessions on a stream of stage rows, ``session_window`` with a
    per-row gap of (stage length + 30 min); a session is emitted once the
    watermark passes its end."""
    length = F.unix_seconds("stage_end_at") - F.unix_seconds("stage_start_at")
    gap = F.concat((length + F.lit(gap_seconds)).cast("string"), F.lit(" seconds"))
    return (stages.withWatermark("stage_start_at", watermark)
            .groupBy("user_id", F.session_window("stage_start_at", gap).alias("w"))
            .agg(F.min("stage_start_at").alias("session_start_at"), F.max("stage_end_at").alias("session_end_at"),
                 F.count(F.lit(1)).alias("stage_count")))
