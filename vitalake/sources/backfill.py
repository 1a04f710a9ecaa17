"""Backfill of a range of days with a ledger of runs.

The ledger (a ``SnapshotTable``, a partition per day) says of each day whether
it has landed or failed, after how many attempts, with how many rows or which
error.  A run takes the days of ``[start, end)`` that are missing or failed,
extracts them in one distributed job, lands the days without an error (each
replaces its own partition of the sink, so a run that died can simply be
repeated) and then updates the ledger.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from .snapshots import SnapshotTable

LEDGER = "day date, status string, attempts int, rows long, error string"


def day_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The days of the half-open range; an error where it is empty."""
    s, e = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    if s >= e:
        raise ValueError(f"start {start} must be before end {end}")
    return spark.range(1).select(F.explode(F.sequence(F.lit(s), F.date_sub(F.lit(e), 1))).alias("day"))


class Backfill:
    def __init__(self, spark: SparkSession, root: str, row_schema: StructType, max_attempts: int = 5):
        self.spark, self.max_attempts = spark, max_attempts
        schema = _parse_datatype_string(LEDGER)
        assert isinstance(schema, StructType)
        self.ledger = SnapshotTable(spark, f"{root}/ledger", "day", schema)
        self.sink = SnapshotTable(spark, f"{root}/rows", "day", row_schema)

    def due(self, start: str, end: str) -> DataFrame:
        """``(day, attempts)``: days that have never run, and failed ones with attempts left."""
        known = self.ledger.read().select("day", "status", "attempts")
        return (day_range(self.spark, start, end).join(known, "day", "left")
                .filter(F.col("status").isNull() | ((F.col("status") == "failed") & (F.col("attempts") < self.max_attempts)))
                .select("day", F.coalesce("attempts", F.lit(0)).alias("attempts")))

    def run(self, start: str, end: str, extract: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``extract(days)`` gives rows with ``day`` and ``error`` (NULL where the row is good).  A day with any
        error fails whole; a day without rows has landed, empty.  Returns the ledger rows of this run."""
        due = self.due(start, end).persist()
        try:
            days = [r.day for r in due.select("day").collect()]  # a row a day of the range
            if not days:
                return self.ledger.read().limit(0)
            rows = extract(due.select("day")).join(F.broadcast(due.select("day")), "day", "left_semi").persist()
            result = (due.join(rows.groupBy("day").agg(F.count(F.lit(1)).alias("rows"), F.min("error").alias("error")), "day", "left")
                      .select("day", F.when(F.col("error").isNull(), "landed").otherwise("failed").alias("status"),
                              (F.col("attempts") + 1).cast("int").alias("attempts"),
                              F.when(F.col("error").isNull(), F.coalesce("rows", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("rows"), "error"))
            result = result.persist()
            failed = result.filter("status = 'failed'").select("day")
            good = rows.join(F.broadcast(failed), "day", "left_anti").select(*self.sink.schema.names)
            landed = [r.day for r in result.filter("status = 'landed'").collect()]
            if landed:
                self.sink.replace(good, landed)
            self.ledger.replace(result, days)
            rows.unpersist()
            return self.ledger.read(parts=days)
        finally:
            due.unpersist()
