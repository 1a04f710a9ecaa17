"""Spark session setup shared by the library, tests and the bench.

Every operator assumes the session time zone is UTC: the landed ISO strings
end in ``Z`` or carry an offset, and day/week boundaries are UTC days.
``ensure_session`` pins that on any session handed to us (the driver's
included) without touching anything else.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
STATE_STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "vitalake") -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "zstd")
        .config("spark.sql.files.openCostInBytes", os.environ.get("VITALAKE_OPEN_COST", str(1 << 20)))
        .config("spark.driver.memory", os.environ.get("VITALAKE_DRIVER_MEMORY", "16g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    if not shuffle_partitions and spark.sparkContext.master.startswith("local"):
        # a cluster's own value stands: partitions must follow the data there, not the driver's cores
        spark.conf.set("spark.sql.shuffle.partitions", str(os.cpu_count() or 8))
    spark.sparkContext.setLogLevel("ERROR")
    ensure_session(spark)
    return spark


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the session settings the operators rely on (UTC day boundaries)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get(STATE_STORE_CONF, None) is None:
        spark.conf.set(STATE_STORE_CONF, ROCKSDB)  # streaming state on disk, not on the heap
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared filesystem every
    executor can reach), and it is an error if it is not.  Only a local master
    gets a scratch folder of its own.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"{CHECKPOINT_CONF} is not set: with master {master} it must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="vitalake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)  # the core conf itself cannot be set at runtime
    return spark.sparkContext.getCheckpointDir().rstrip("/")
