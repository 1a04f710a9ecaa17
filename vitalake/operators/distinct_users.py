"""Exact distinct users over any window of days (R13, R16, R19) from day rows.

A stored numbering gives every user a number once; a day's users are bitmaps
over these numbers (a row per day and 32,768 numbers).  The users of any window
are the union of its days' bitmaps, so a query reads day rows and never the
facts, and a new batch rewrites the days it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from ..sources.snapshots import SnapshotTable

#: hash parts of the numbering; a batch reads and extends all of them by appending
PARTS = 16


def _schema(ddl: str) -> StructType:
    out = _parse_datatype_string(ddl)
    assert isinstance(out, StructType)
    return out


class UserDays:
    def __init__(self, spark: SparkSession, root: str):
        self.users = SnapshotTable(spark, f"{root}/users", "part", _schema("user_id string, n long, part int"))
        self.days = SnapshotTable(spark, f"{root}/days", "day", _schema("day date, bucket long, bits binary"))

    def _number(self, users: DataFrame) -> None:
        """Number the users that have none: in runs without gaps per task, after all earlier numbers."""
        new = users.join(self.users.read().select("user_id"), "user_id", "left_anti")
        top = self.users.read().agg(F.max("n")).first()[0]
        base = 0 if top is None else ((top >> 33) + 1) << 33
        part = F.pmod(F.xxhash64("user_id"), F.lit(PARTS)).cast("int")
        numbered = new.withColumn("n", F.monotonically_increasing_id() + F.lit(base)).withColumn("part", part)
        self.users.append(numbered)  # stored once, read from there: a task that runs twice changes no number

    def update(self, rows: DataFrame, batch: int) -> list[str]:
        """Add ``rows (day, user_id)``; the days rewritten (none for a batch that is in already)."""
        held = self.days.manifest()
        if batch <= held["meta"].get("batch", -1):
            return []
        seen = rows.select(F.col("day").cast("date").alias("day"), "user_id").filter("day IS NOT NULL AND user_id IS NOT NULL").distinct().persist()
        try:
            self._number(seen.select("user_id").distinct())
            new = (seen.join(self.users.read().select("user_id", "n"), "user_id")
                   .groupBy("day", F.bitmap_bucket_number("n").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits")))
            touched = [r[0] for r in seen.select(F.col("day").cast("string")).distinct().collect()]  # the days of one batch
            both = self.days.read(held["version"], touched).unionByName(new)
            self.days.replace(both.groupBy("day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits")), touched, {"batch": batch}, held["version"])
        finally:
            seen.unpersist()
        return touched

    def _counted(self, rows: DataFrame, *keys: Column | str) -> DataFrame:
        per_bucket = rows.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("c"))
        names = per_bucket.columns[:-2]
        return per_bucket.groupBy(*names).agg(F.sum("c").alias("users"))

    def between(self, start: str, end: str) -> DataFrame:
        """One row: the distinct users of the days from ``start`` to ``end`` (both included)."""
        return self._counted(self.days.read().filter(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
                             ).agg(F.coalesce(F.sum("users"), F.lit(0)).alias("users"))

    def per_day(self) -> DataFrame:
        return self._counted(self.days.read(), "day")

    def rolling(self, days: int) -> DataFrame:
        """Distinct users of the ``days`` days that end on each day with any."""
        rows = self.days.read()
        ends = rows.select(F.col("day").alias("window_end")).distinct()
        spread = rows.withColumn("window_end", F.explode(F.sequence("day", F.date_add("day", days - 1))))
        return self._counted(spread.join(ends, "window_end", "left_semi"), "window_end")
