"""Sleep sessions on a stream, by the rule of W2.

``session_window`` measures gaps from the running maximum end and so differs
from W2 for nested stages.  Here the rows that a later row may still change stay
open between micro-batches: each batch is merged with them and put through the
batch operator.  A session is closed once all its starts, and its last end plus
the gap, lie before the watermark: no row that is on time can come between or
join it, so closed sessions are always the first ones of their user, and a count
per user continues the numbering.  Rows behind the watermark are set aside.

Closed sessions, open rows, counts, watermark and epoch are one version of one
``SnapshotTable``; open rows and what a batch rewrites are bounded by the
watermark, closed sessions are only appended.

A batch is numbered once: the numbered rows and their sessions are stored for as
long as the batch is worked on.  They are stored and not cached because a cached
frame keeps ``spark.sql.shuffle.partitions`` partitions whatever its size, and each
shuffle after it that number squared of blocks.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType, _parse_datatype_string

from ..operators.sessions import GAP_SECONDS, sessionize
from ..operators.silver import first_arrival
from ..sources.snapshots import SnapshotTable

#: rows of all kinds: open and late stages, closed sessions, closed sessions per user
_SCHEMA = ("user_id string, stage_uuid string, stage_start_at timestamp, stage_end_at timestamp, ingested_at timestamp, "
           "session_seq long, session_start_at timestamp, session_end_at timestamp, stage_count long, _part_of string")
_STAGE = ["user_id", "stage_uuid", "stage_start_at", "stage_end_at", "ingested_at"]
_SESSION = ["user_id", "session_seq", "session_start_at", "session_end_at", "stage_count"]


def _user_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), "user_id"), F.lit(""))


class OpenSessions:
    def __init__(self, spark: SparkSession, root: str, delay_seconds: int = 48 * 3600, gap_seconds: int = GAP_SECONDS):
        schema = _parse_datatype_string(_SCHEMA)
        assert isinstance(schema, StructType)
        self.table, self.delay, self.gap = SnapshotTable(spark, root, "_part_of", schema), delay_seconds * 1_000_000, gap_seconds

    def _shaped(self, rows: DataFrame, part: str) -> DataFrame:
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.table.schema.fields if f.name not in rows.columns and f.name != "_part_of"]
        return rows.select("*", *missing, F.lit(part).alias("_part_of")).select(*self.table.schema.names)

    def _tagged(self, stages: DataFrame) -> DataFrame:
        """Open ``stages`` with the number of their session among the open ones, and ``_u``, the user as a key without NULL."""
        tagged = sessionize(stages, "user_id", "stage_start_at", "stage_end_at", "stage_uuid", self.gap)
        return tagged.withColumnRenamed("session_seq", "_local").withColumn("_u", _user_key())

    def _numbered(self, tagged: DataFrame, counts: DataFrame) -> DataFrame:
        """Sessions of tagged rows, numbered after the closed ones of their user, with their last start and last row's end."""
        sessions = tagged.groupBy("_u", "user_id", "_local").agg(
            F.min("stage_start_at").alias("session_start_at"), F.max("stage_end_at").alias("session_end_at"), F.count(F.lit(1)).alias("stage_count"),
            F.max("stage_start_at").alias("_last"), F.max_by("stage_end_at", "stage_no").alias("_last_end"))
        done = counts.select(_user_key().alias("_u"), F.col("session_seq").alias("_done"))
        return sessions.join(done, "_u", "left").withColumn("session_seq", F.col("_local") + F.coalesce("_done", F.lit(0))).drop("_done")

    def _stored(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.parquet(path)
        return self.table.spark.read.schema(rows.schema).parquet(path)

    def take(self, batch: DataFrame, epoch: int) -> None:
        held = self.table.manifest()
        meta, base = held["meta"], held["version"]
        if epoch <= meta.get("epoch", -1):
            return
        t = F.unix_micros("stage_start_at")
        high = meta.get("high")
        work = f"{self.table.root}/work/{uuid.uuid4().hex}"
        new = batch.select(*_STAGE).filter("stage_start_at IS NOT NULL AND stage_end_at IS NOT NULL").persist()
        try:
            newest = new.agg(F.max(t)).first()[0]
            behind = F.lit(False) if high is None else t < F.lit(high - self.delay)
            arrived = first_arrival(self.table.read(base, ["open"]).select(*_STAGE).unionByName(new.filter(~behind)), ["stage_uuid"], ("ingested_at", "stage_start_at"))
            marks = [x for x in (high, newest) if x is not None]
            mark = max(marks) - self.delay if marks else -(1 << 62)
            counts = self.table.read(base, ["users"]).select("user_id", "session_seq")
            over = (F.unix_micros("_last") < F.lit(mark)) & (F.unix_micros("_last_end") + F.lit(self.gap * 1_000_000) < F.lit(mark))
            stages = self._stored(arrived, f"{work}/stages")
            tagged = self._stored(self._tagged(stages), f"{work}/tagged")
            sessions = self._stored(self._numbered(tagged, counts).withColumn("_over", over), f"{work}/sessions")
            closed = sessions.filter("_over")
            open_rows = tagged.join(sessions.filter(~F.col("_over")), ["_u", "_local"], "left_semi").select(*_STAGE)
            users = (counts.unionByName(closed.select("user_id", "session_seq")).groupBy("user_id").agg(F.max("session_seq").alias("session_seq")))
            out = (self._shaped(open_rows, "open").unionByName(self._shaped(users, "users"))
                   .unionByName(self._shaped(closed.select(*_SESSION), "closed")).unionByName(self._shaped(new.filter(behind), "late")))
            names = {p: n for n in ("open", "users", "closed", "late") for p in [n.encode().hex().upper()]}
            written = self.table.write(out)
            parts = {p: ([*held["parts"].get(p, [])] if n in ("closed", "late") else []) + ([written[p]] if p in written else []) for p, n in names.items()}
            state = {"epoch": epoch} | ({"high": max(marks)} if marks else {})
            self.table.commit(base, parts, state)
        finally:
            new.unpersist()
            self.table.delete(work)

    def sessions(self) -> DataFrame:
        """All sessions so far: the closed ones, and the open ones as they stand."""
        v = self.table.version()
        still = self._numbered(self._tagged(self.table.read(v, ["open"]).select(*_STAGE)), self.table.read(v, ["users"]).select("user_id", "session_seq"))
        return self.table.read(v, ["closed"]).select(*_SESSION).unionByName(still.select(*_SESSION))

    def follow(self, stages: DataFrame, checkpoint: str) -> StreamingQuery:
        return (stages.writeStream.foreachBatch(self.take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
