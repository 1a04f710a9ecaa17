"""P31 with stored high-water marks: every sample of a device is delivered once.

Marks (newest time delivered per device and metric) and delivered rows are one
version of one ``SnapshotTable``: a delivery that fails moves no mark, one that
is replayed after its commit finds its marks and delivers nothing again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..sources.snapshots import SnapshotTable


class Deliveries:
    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: tuple[str, ...] = ("device_id", "metric_type"), at: str = "recorded_at"):
        self.keys, self.at, self.columns = list(keys), at, schema.names
        self.table = SnapshotTable(spark, root, "_part_of", StructType([*schema.fields, StructField("_part_of", StringType())]))

    def _keyed(self, rows: DataFrame) -> DataFrame:
        """One text key; a missing device or metric is a value like any other."""
        return rows.withColumn("_k", F.to_json(F.struct(*self.keys)))

    def marks(self, version: int | None = None) -> DataFrame:
        return self.table.read(version, ["marks"]).select(*self.keys, F.col(self.at).alias("since"))

    def delivered(self) -> DataFrame:
        return self.table.read(parts=["rows"]).select(*self.columns)

    def fresh(self, events: DataFrame, version: int | None = None) -> DataFrame:
        """Events newer than the mark of their device and metric (one without a time is never newer)."""
        since = self._keyed(self.marks(version)).select("_k", "since")
        return (self._keyed(events.select(*self.columns)).join(since, "_k", "left")
                .filter(F.col(self.at).isNotNull() & (F.col("since").isNull() | (F.col(self.at) > F.col("since")))).select(*self.columns))

    def deliver(self, events: DataFrame) -> int:
        """Deliver what is new and advance the marks; the version that holds both."""
        held = self.table.manifest()
        fresh = self.fresh(events, held["version"]).persist()
        try:
            old = self.table.read(held["version"], ["marks"]).select(*self.columns)
            new = fresh.unionByName(old).groupBy(*self.keys).agg(F.max(self.at).alias(self.at))
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.table.schema.fields if f.name in self.columns and f.name not in (*self.keys, self.at)]
            marks = new.select(*self.keys, self.at, *empty).select(*self.columns, F.lit("marks").alias("_part_of"))
            written = self.table.write(fresh.withColumn("_part_of", F.lit("rows")).unionByName(marks))
            names = {n: n.encode().hex().upper() for n in ("rows", "marks")}
            parts = {names["marks"]: [written[names["marks"]]] if names["marks"] in written else [],
                     names["rows"]: [*held["parts"].get(names["rows"], []), *([written[names["rows"]]] if names["rows"] in written else [])]}
            return self.table.commit(held["version"], parts)
        finally:
            fresh.unpersist()
