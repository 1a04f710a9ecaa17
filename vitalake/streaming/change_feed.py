"""A resumable change feed over keyed, bucketed state with a token per type.

The state of all keys is a ``SnapshotTable`` of hash buckets.  A batch of
changes rewrites only the buckets its keys fall into; the other buckets keep
their files.  The epoch of the stream, or the token reached for each record
type, is part of the manifest that publishes the rows, so data and token move in
one step: a batch that fails leaves both where they were, a batch that is
replayed after its commit is recognised and skipped.

Deletes are order-free (a record id is not used twice): a delete leaves a
tombstone in its bucket, which also removes a record that arrives later.
Tombstones older than ``keep_tombstones`` (measured by the feed's own order, not
by the clock) go when their bucket is next rewritten.

``sync`` pulls from a log with a retention floor per type.  A type whose token
lies behind the floor has lost changes: it is read again in full, its rows that
the full read no longer holds are dropped, and it gets a new token.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from ..sources.snapshots import CommitConflict, SnapshotTable

BUCKETS = 64
_EXTRA = [StructField("_bucket", IntegerType()), StructField("_seq", LongType()), StructField("_dead", BooleanType())]


class KeyedState:
    """Current rows by ``key``; ``seq`` (a long) orders the changes, ``order`` breaks its ties."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str, seq: Column, order: list[str],
                 buckets: int = BUCKETS, keep_tombstones: int | None = None):
        self.key, self.seq, self.order, self.buckets, self.keep = key, seq, order, buckets, keep_tombstones
        self.columns = schema.names
        self.table = SnapshotTable(spark, root, "_bucket", StructType([*schema.fields, *_EXTRA]))

    def rows(self, version: int | None = None) -> DataFrame:
        return self.table.read(version).filter(~F.col("_dead")).select(*self.columns)

    def tokens(self) -> dict[str, int]:
        return self.table.manifest()["meta"].get("tokens", {})

    def _shaped(self, changes: DataFrame, dead: bool) -> DataFrame:
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.table.schema.fields
                   if f.name in self.columns and f.name not in changes.columns]
        return (changes.withColumns({"_bucket": bucket, "_seq": self.seq.cast("long"), "_dead": F.lit(dead)})
                .select("*", *missing).select(*self.table.schema.names))

    def _merged(self, rows: DataFrame) -> DataFrame:
        """One row per key: its tombstone if there is one, else its latest version (partial aggregates; a key
        that a third of the changes touch is reduced before the shuffle)."""
        rest = [c for c in self.columns if c != self.key]
        newest = F.max_by(F.struct(*rest), F.struct("_seq", *self.order))
        out = (rows.groupBy("_bucket", self.key)
               .agg(newest.alias("_row"), F.max("_seq").alias("_last"), F.bool_or("_dead").alias("_dead"), F.max(F.when(F.col("_dead"), F.col("_seq"))).alias("_died")))
        keep = [F.when(~F.col("_dead"), F.col(f"_row.{c}")).alias(c) for c in rest]
        return out.select(F.col(self.key), *keep, "_bucket", F.when(F.col("_dead"), F.col("_died")).otherwise(F.col("_last")).alias("_seq"),
                          "_dead").select(*self.table.schema.names)

    def apply(self, upserts: DataFrame, deletes: DataFrame, meta: dict | None = None, base: int | None = None,
              dropped: Column | None = None) -> int:
        """Merge a batch and publish it with ``meta``; returns the new version.

        ``deletes`` has the key and what ``seq`` reads.  ``dropped``: rows of the
        state to be forgotten first (a full read replaces them); all buckets are then rewritten."""
        base = self.table.version() if base is None else base
        batch = self._shaped(upserts, False).unionByName(self._shaped(deletes, True)).filter(F.col(self.key).isNotNull())
        old = self.table.manifest(base)["meta"]
        if dropped is None:
            touched = [r[0] for r in batch.select("_bucket").distinct().collect()]  # at most one row a bucket
        else:
            touched = list(range(self.buckets))
        current = self.table.read(base, touched)
        if dropped is not None:
            current = current.filter(F.col("_dead") | ~F.coalesce(dropped, F.lit(False)))
        merged = self._merged(current.unionByName(batch))
        high = max(old.get("high", 0), batch.agg(F.max("_seq")).first()[0] or 0)
        if self.keep is not None:
            merged = merged.filter(~F.col("_dead") | (F.col("_seq") >= high - self.keep))
        return self.table.replace(merged, touched, {**(meta or {}), "high": high}, base)

    # --- as a stream ------------------------------------------------------------

    def follow(self, changes: DataFrame, checkpoint: str, op_col: str = "op", trigger: str = "availableNow") -> StreamingQuery:
        """Merge a stream of change rows, one version a micro-batch."""
        def step(batch: DataFrame, epoch: int) -> None:
            base = self.table.version()
            done = self.table.manifest(base)["meta"].get("epoch", -1)
            if epoch <= done:
                return  # replayed after its commit
            ups, dels = (batch.filter(F.col(op_col) == kind).drop(op_col) for kind in ("upsert", "delete"))
            batch.persist()
            try:
                self.apply(ups, dels, {"epoch": epoch}, base)
            finally:
                batch.unpersist()

        w = changes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)).start()

    # --- as a pull with tokens ----------------------------------------------------

    def sync(self, log: DataFrame, full_read: Callable[[list[str]], DataFrame], floors: dict[str, int] | None = None,
             type_col: str = "type", row_type: str | None = None, op_col: str = "op", attempts: int = 3) -> dict[str, str]:
        """Pull what is new in ``log`` (``type, seq, op`` and the row) for every type; ``{type: how}``.

        A type without a token or with one behind its floor is read in full from
        ``full_read(types)`` (its live rows); else its changes after the token are merged.
        A writer that was overtaken starts again from the newer version."""
        for attempt in range(attempts):
            try:
                return self._sync(log, full_read, floors or {}, type_col, row_type or type_col, op_col)
            except CommitConflict:
                if attempt + 1 == attempts:
                    raise
        raise AssertionError

    def _sync(self, log, full_read, floors, type_col, row_type, op_col) -> dict[str, str]:
        base = self.table.version()
        tokens = self.table.manifest(base)["meta"].get("tokens", {})
        newest = {r[0]: r[1] for r in log.groupBy(type_col).agg(F.max(self.seq.cast("long"))).collect() if r[0] is not None}  # a row a type
        how = {}
        for t, last in newest.items():
            token = tokens.get(t)
            how[t] = "full" if token is None or token < floors.get(t, token) else "changes" if last > token else "none"
        full = [t for t, h in how.items() if h == "full"]
        if all(h == "none" for h in how.values()):
            return how
        of = F.col(type_col)
        reached = F.coalesce(*[F.when(of == t, F.lit(tokens[t])) for t, h in how.items() if h == "changes"], F.lit(None)).cast("long")
        new = log.filter(reached.isNotNull() & (self.seq.cast("long") > reached))
        # the deletes that the log still has are taken for types read in full too: they may name records of other types
        dels = new.filter(F.col(op_col) == "delete").unionByName(log.filter(of.isin(full) & (F.col(op_col) == "delete")))
        ups = new.filter(F.col(op_col) == "upsert")
        rows = ups.select(*[c for c in ups.columns if c in self.columns])
        dropped = None
        if full:
            rows = rows.unionByName(full_read(full).select(*rows.columns))
            dropped = F.col(row_type).isin(full) if base else None
        self.apply(rows, dels, {"tokens": tokens | newest}, base, dropped)
        return how
