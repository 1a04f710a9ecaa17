"""Late rows are set aside, not lost.

The stateful operator drops rows behind the watermark without a trace.  Here
each micro-batch is divided before it is de-duplicated: rows behind the
watermark go to a quarantine beside the table, the others are reduced to the
first arrival per key and compared with the kept rows inside the watermark (the
table is its own state; only the days from the watermark on are read).  Kept and
late rows, the watermark, the epoch and the counts are one version of one
``SnapshotTable``: landed = kept + duplicates + late holds for every version,
and a replayed epoch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.silver import first_arrival
from ..sources.snapshots import SnapshotTable

_EXTRA = [StructField("_kind", StringType()), StructField("_epoch", LongType()), StructField("_part_of", StringType())]


class LateGate:
    """A silver table with first-arrival de-duplication by ``key`` inside a watermark of ``delay_seconds``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str, delay_seconds: int,
                 at: str = "ingested_at", order: tuple[str, ...] = ("ingested_at", "record_id")):
        self.key, self.delay, self.at, self.order, self.columns = key, delay_seconds * 1_000_000, at, order, schema.names
        self.table = SnapshotTable(spark, root, "_part_of", StructType([*schema.fields, *_EXTRA]))

    def _parts(self, version: int, kind: str, since: str = "") -> list[str]:
        names = (bytes.fromhex(p).decode() for p in self.table.manifest(version)["parts"])
        return [n for n in names if n.startswith(f"{kind}:") and n[len(kind) + 1:] >= since]

    def rows(self, kind: str = "kept") -> DataFrame:
        v = self.table.version()
        return self.table.read(v, self._parts(v, kind)).select(*self.columns, "_epoch")

    def totals(self) -> dict[str, int]:
        return self.table.manifest()["meta"].get("totals", {})

    def take(self, batch: DataFrame, epoch: int) -> dict[str, int]:
        """Divide one micro-batch; its counts (none for a batch that is in already)."""
        held = self.table.manifest()
        if epoch <= held["meta"].get("epoch", -1):
            return {}
        t = F.unix_micros(self.at)
        high = held["meta"].get("high")
        late_if = F.lit(False) if high is None else F.coalesce(t < F.lit(high - self.delay), F.lit(False))
        batch = batch.select(*self.columns).persist()
        try:
            landed, newest = batch.agg(F.count("*"), F.max(t)).first()
            fresh = first_arrival(batch.filter(~late_if), [self.key], self.order)
            if high is not None:
                from datetime import datetime, timedelta, timezone
                day = (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=high - self.delay)).strftime("%Y-%m-%d")
                seen = self.table.read(held["version"], self._parts(held["version"], "kept", day)).filter(t >= F.lit(high - self.delay))
                fresh = fresh.join(seen.select(self.key), self.key, "left_anti").select(*self.columns)
            both = fresh.withColumn("_kind", F.lit("kept")).unionByName(batch.filter(late_if).withColumn("_kind", F.lit("late")))
            day_of = F.coalesce(F.to_date(self.at).cast("string"), F.lit("9999"))  # a row without a time is never late
            out = both.withColumns({"_epoch": F.lit(epoch).cast("long"), "_part_of": F.concat("_kind", F.lit(":"), day_of)})
            seen_by = Observation()
            new = self.table.write(out.observe(seen_by, F.count_if(F.col("_kind") == "kept").alias("kept"), F.count_if(F.col("_kind") == "late").alias("late")))
            counts = {"landed": landed, **{k: seen_by.get[k] for k in ("kept", "late")}}
            counts["duplicates"] = landed - counts["kept"] - counts["late"]
            before = held["meta"].get("totals", {})
            meta = {"epoch": epoch, "high": max(x for x in (high, newest, -(1 << 62)) if x is not None),
                    "totals": {k: before.get(k, 0) + v for k, v in counts.items()}}
            if newest is None and high is None:
                del meta["high"]
            self.table.commit(held["version"], {p: [*held["parts"].get(p, []), f] for p, f in new.items()}, meta)
        finally:
            batch.unpersist()
        return counts

    def follow(self, rows: DataFrame, checkpoint: str) -> StreamingQuery:
        return (rows.writeStream.foreachBatch(lambda batch, epoch: self.take(batch, epoch) and None)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
