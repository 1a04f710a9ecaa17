"""The stored bronze table (S12, S13-style sink): land once, read many.

Production bronze is an append-only table every silver flow reads.  Here it
is derived from the driver's ``events`` and written once per input (keyed by
path, size and mtime) as parquet with VARIANT ``body``/``headers``,
partitioned by ``record_type``:

* silver flows filter one record type -> partition pruning, only that
  directory is scanned;
* ingest/volume tiles read ``ingested_at``/``user_id``/``record_type`` only
  -> the variant columns are pruned from the scan;
* the table lives under ``spark.checkpoint.dir`` (the shared folder on a
  cluster), so it is also a lineage cut that survives executor loss.
"""

from __future__ import annotations

import ast
import functools
import hashlib
import importlib.util
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import BRONZE_COLUMNS
from ..session import checkpoint_dir, ensure_session
from .bindings import events_to_bronze, read_events

PARTITION_COLUMNS = ("record_type",)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _without_docs(tree: ast.AST) -> ast.AST:
    for node in ast.walk(tree):
        body = getattr(node, "body", None)
        if isinstance(body, list) and body and isinstance(body[0], ast.Expr) and isinstance(body[0].value, ast.Constant):
            node.body = body[1:]
    return tree


@functools.cache
def code_version(*modules: str) -> str:
    """Hash of the code of the named modules of this package, without comments and docstrings: a rule that
    changes makes a fresh table, an edited comment does not."""
    h = hashlib.sha1()
    for name in modules:
        with open(importlib.util.find_spec(f"{__package__.rpartition('.')[0]}.{name}").origin, encoding="utf-8") as f:
            h.update(ast.dump(_without_docs(ast.parse(f.read()))).encode())
    return h.hexdigest()[:8]


#: the modules that decide what a landed table, and what a stored silver or gold table, contains
LANDED_BY = ("sources.bindings", "sources.platform_bindings", "sources.landing", "sources.bronze_store", "operators.garmin", "functions.variant", "schemas")
LAYERS_BY = ("operators.silver", "operators.gold", "functions.variant", "functions.labels", "functions.dims", "plans.medallion")


def _input_key(spark: SparkSession, path: str) -> str:
    """Name, size and time of every file of the input (a folder's own length says nothing), and the landing code."""
    fs, p = _fs(spark, path)
    files, found = fs.listFiles(p, True), []
    while files.hasNext():
        st = files.next()
        found.append(f"{st.getPath().toString()}|{st.getLen()}|{st.getModificationTime()}")
    raw = "\n".join([fs.makeQualified(p).toString(), *sorted(found), code_version(*LANDED_BY)])
    return hashlib.sha1(raw.encode()).hexdigest()[:16]


def write_bronze(bronze: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a bronze frame as the partitioned VARIANT parquet table.  Rows
    are sorted by ``ingested_at`` inside each file, so row-group min/max
    statistics let time-window filters skip row groups."""
    (bronze.select(*BRONZE_COLUMNS).sortWithinPartitions(*PARTITION_COLUMNS, "ingested_at").write.mode(mode)
     .option("compression", "zstd").partitionBy(*PARTITION_COLUMNS).parquet(path))


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*BRONZE_COLUMNS)


def _binding(kind: str):
    from . import platform_bindings as pb
    return {"healthkit": events_to_bronze, "garmin": pb.garmin_bronze, "watch": pb.watch_bronze,
            "health_connect": pb.hc_bronze}[kind]


def bronze_path_for(spark: SparkSession, sf_dir: str, kind: str = "healthkit") -> str:
    events_path = os.path.join(sf_dir, "events.parquet")
    return f"{checkpoint_dir(spark)}/bronze/{kind}-{_input_key(spark, events_path)}"


def landed_bronze(spark: SparkSession, sf_dir: str, kind: str = "healthkit") -> DataFrame:
    """Bronze of one platform binding for ``sf_dir``: landed on first use,
    then read from storage."""
    ensure_session(spark)
    target = bronze_path_for(spark, sf_dir, kind)
    if not _exists(spark, f"{target}/_SUCCESS"):
        publish_atomically(spark, target, lambda tmp: write_bronze(
            spread(spark, _binding(kind)(read_events(spark, sf_dir))), tmp))
    return read_bronze(spark, target)


def publish_atomically(spark: SparkSession, target: str, write) -> None:
    """Write to a unique sibling path, then rename it into place.  A
    concurrent writer that loses the rename leaves the winner's table."""
    import uuid
    tmp = f"{target}.tmp-{uuid.uuid4().hex}"
    write(tmp)
    fs, src = _fs(spark, tmp)
    _, dst = _fs(spark, target)
    if fs.exists(dst) and not _exists(spark, f"{target}/_SUCCESS"):
        fs.delete(dst, True)  # a partial table left by a crashed non-atomic writer
    if not fs.exists(dst) and fs.rename(src, dst):
        return
    fs.delete(src, True)


def spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Rebalance the landed rows by record type and day: adaptive execution
    splits and joins the partitions to its advisory size, so the number of files
    follows the data and not the cluster's cores, and a file holds few days."""
    return df.withColumn("_day", F.to_date("ingested_at")).hint("rebalance", *PARTITION_COLUMNS, "_day").drop("_day")
