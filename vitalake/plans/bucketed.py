"""J1/G4 and J4 on co-bucketed tables: joins of stored tables without a shuffle.

A daily table is written once in buckets of its join keys, sorted by them within
each bucket; the folder is registered in the session's catalog with that layout.
Tables with the same keys and number of buckets are then joined bucket by bucket:
Spark plans no exchange for either side, however large they are.  The layout is
kept beside the data, so another session opens it as it was written.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import deletes as deletion
from ..operators import gold
from ..sources.bronze_store import _exists, _fs, publish_atomically

BUCKETS = 64


class BucketedStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def _name(self, path: str) -> str:
        return f"bucketed_{hashlib.sha1(path.encode()).hexdigest()[:16]}"

    def _register(self, path: str, schema_ddl: str, keys: list[str], buckets: int) -> DataFrame:
        name, by = self._name(path), ", ".join(f"`{k}`" for k in keys)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema_ddl}) USING parquet "
                       f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def store(self, table: str, rows: DataFrame, keys: list[str]) -> DataFrame:
        """``rows`` in buckets of ``keys``: written on first use, published by a rename, read from there."""
        path = f"{self.root}/{table}"
        if not _exists(self.spark, f"{path}/_SUCCESS"):
            # as many tasks as buckets, dealt as the buckets are: a file each
            dealt = rows.repartition(self.buckets, *keys)

            def write(tmp: str) -> None:
                name = self._name(tmp)
                dealt.write.format("parquet").bucketBy(self.buckets, *keys).sortBy(*keys).option("path", tmp).saveAsTable(name)
                self.spark.sql(f"DROP TABLE {name}")  # the folder stays: the table was an external one
                fs, p = _fs(self.spark, f"{tmp}/_layout.json")
                out = fs.create(p, True)
                out.write(bytearray(json.dumps({"keys": keys, "buckets": self.buckets, "schema": _ddl(rows)}).encode()))
                out.close()

            publish_atomically(self.spark, path, write)
        return self.open(table)

    def open(self, table: str) -> DataFrame:
        """A stored table with the layout it was written in."""
        path = f"{self.root}/{table}"
        fs, p = _fs(self.spark, f"{path}/_layout.json")
        stream = fs.open(p)
        try:
            layout = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return self._register(path, layout["schema"], layout["keys"], layout["buckets"])


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


def activity_enriched_bucketed(store: BucketedStore, rings: DataFrame, steps: DataFrame) -> DataFrame:
    """G4 / J1 from rings and steps that are both stored by (user_id, day)."""
    by_day = store.store("rings_by_user_day", rings.withColumnRenamed("summary_date", "day"), ["user_id", "day"])
    steps_by_day = store.store("steps_by_user_day", steps, ["user_id", "day"])
    return gold.activity_enriched_daily(by_day.withColumnRenamed("day", "summary_date"), steps_by_day)


def live_bucketed(store: BucketedStore, name: str, facts: DataFrame, deletes: DataFrame, key: str, mode: str = "remove") -> DataFrame:
    """J4 on facts stored by their id: the delete feed, one row an id, lies in the same buckets, so reading the live
    rows moves neither side.  A feed that has grown is stored under a name of its own; the facts stay as they are."""
    by_id = store.store(name, facts, [key])
    gone = deletes.select(F.col("deleted_uuid").alias(key)).filter(F.col(key).isNotNull()).distinct()
    feed = store.store(f"{name}_deletes", gone, [key])
    return deletion.apply_deletes(by_id, feed, key, mode, key)
