"""The batch medallion DAG: bronze -> silver -> gold -> views.

``Medallion`` builds each table lazily from the one below it; nothing runs
until an action.  Building a gold table therefore yields one Catalyst plan
from the bronze scan up, with filters and column pruning pushed through the
silver projections into the scan.  ``materialize`` writes a layer to the
shared checkpoint folder and re-reads it, which cuts lineage (and survives
executor loss) when many gold tables are built from the same silver.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..operators import gold, silver
from ..session import checkpoint_dir


class Medallion:
    def __init__(self, bronze: DataFrame, dedup: str = "first", strict_heart_rate: bool = False):
        self.bronze = bronze
        self.dedup = dedup
        self.strict = strict_heart_rate

    # silver
    @cached_property
    def events(self) -> DataFrame:
        return silver.events(self.bronze, self.dedup)

    @cached_property
    def samples(self) -> DataFrame:
        return silver.samples(self.bronze, self.dedup)

    @cached_property
    def workouts(self) -> DataFrame:
        return silver.workouts(self.bronze, self.dedup)

    @cached_property
    def sleep_stages(self) -> DataFrame:
        return silver.sleep_stages(self.bronze, self.dedup)

    @cached_property
    def rings(self) -> DataFrame:
        return silver.activity_rings(self.bronze, self.dedup)

    @cached_property
    def deletes(self) -> DataFrame:
        return silver.deletes(self.bronze, self.dedup)

    # gold
    @cached_property
    def hk_quantity_daily(self) -> DataFrame:
        return gold.hk_quantity_daily(self.samples)

    @cached_property
    def subject_daily(self) -> DataFrame:
        return gold.subject_daily(self.events)

    @cached_property
    def daily_steps(self) -> DataFrame:
        return gold.daily_steps(self.samples)

    @cached_property
    def activity_enriched(self) -> DataFrame:
        return gold.activity_enriched_daily(self.rings, self.daily_steps)

    @cached_property
    def sleep_nightly(self) -> DataFrame:
        return gold.sleep_nightly(self.sleep_stages)

    @cached_property
    def weekly_workouts(self) -> DataFrame:
        return gold.weekly_workout_summary(self.workouts)

    @cached_property
    def cardio_vitals(self) -> DataFrame:
        return gold.cardio_vitals_daily(self.samples, self.strict)

    @cached_property
    def hr_intraday(self) -> DataFrame:
        return gold.heart_rate_intraday_daily(self.samples)

    @cached_property
    def ingest_daily(self) -> DataFrame:
        return gold.bronze_ingest_daily(self.bronze)

    @cached_property
    def family_weekly(self) -> DataFrame:
        return gold.hk_family_weekly(self.samples)

    SILVER_TABLES = ("events", "samples", "workouts", "sleep_stages", "rings", "deletes")
    GOLD_TABLES = ("hk_quantity_daily", "subject_daily", "daily_steps", "activity_enriched", "sleep_nightly",
                   "weekly_workouts", "cardio_vitals", "hr_intraday", "ingest_daily", "family_weekly")

    def silver_volumes(self) -> dict[str, DataFrame]:
        """The seven tables of the silver/gold volume tile."""
        return {"silver_events": self.events, "silver_samples": self.samples, "silver_workouts": self.workouts,
                "silver_sleep_stages": self.sleep_stages, "silver_rings": self.rings,
                "gold_hk_quantity_daily": self.hk_quantity_daily, "gold_subject_daily": self.subject_daily}

    def gold_volumes(self) -> dict[str, DataFrame]:
        """The eight tables of the newer-gold volume tile."""
        return {"gold_daily_steps": self.daily_steps, "gold_activity_enriched_daily": self.activity_enriched,
                "gold_sleep_nightly": self.sleep_nightly, "gold_weekly_workout_summary": self.weekly_workouts,
                "gold_cardio_vitals_daily": self.cardio_vitals, "gold_heart_rate_intraday_daily": self.hr_intraday,
                "gold_bronze_ingest_daily": self.ingest_daily, "gold_hk_family_weekly": self.family_weekly}

    def materialize(self, spark: SparkSession, names: tuple[str, ...] = SILVER_TABLES,
                    root: str | None = None) -> "Medallion":
        """Write the named tables as parquet under the shared checkpoint
        folder (or ``root``) and serve later reads from there."""
        base = (root or checkpoint_dir(spark)).rstrip("/") + "/medallion"
        for name in names:
            path = f"{base}/{name}"
            getattr(self, name).write.mode("overwrite").parquet(path)
            self.__dict__[name] = spark.read.parquet(path)
        return self


class StoredMedallion(Medallion):
    """A medallion whose silver and gold tables are stored once under ``root``
    and read from there by everything above them: a tile scans the gold table it
    shows, with its window in the scan's filters, and never the bronze again.

    Gold is sorted by day (or week) within files, so that the row-group
    statistics let a window skip most of it.  A table is written on its first
    use and published by a rename, so a crashed writer leaves nothing behind.
    The folder names the options and the version of the code that makes the
    tables, so no option and no changed rule is served another one's rows."""

    SORTED_BY = {"hk_quantity_daily": "day", "subject_daily": "day", "daily_steps": "day", "activity_enriched": "day", "sleep_nightly": "sleep_night",
                 "weekly_workouts": "week_start", "cardio_vitals": "day", "hr_intraday": "day", "ingest_daily": "ingest_day", "family_weekly": "week_start"}

    def __init__(self, bronze: DataFrame, root: str, dedup: str = "first", strict_heart_rate: bool = False):
        super().__init__(bronze, dedup, strict_heart_rate)
        from ..sources.bronze_store import LAYERS_BY, code_version
        options = f"{dedup}-{'strict' if strict_heart_rate else 'plain'}"
        self.root = f"{root.rstrip('/')}/{options}-{code_version(*LAYERS_BY)}"

    def __getattribute__(self, name: str):
        if name not in Medallion.SILVER_TABLES and name not in Medallion.GOLD_TABLES:
            return super().__getattribute__(name)
        held = self.__dict__
        if name not in held:
            held[name] = self._stored(name, Medallion.__dict__[name].func(self))
        return held[name]

    def _stored(self, name: str, table: DataFrame) -> DataFrame:
        from ..sources.bronze_store import _exists, publish_atomically
        spark, path = table.sparkSession, f"{self.root}/{name}"
        if not _exists(spark, f"{path}/_SUCCESS"):
            day = self.SORTED_BY.get(name)
            rows = table.repartitionByRange(day).sortWithinPartitions(day) if day else table
            publish_atomically(spark, path, lambda tmp: rows.write.parquet(tmp))
        return spark.read.schema(table.schema).parquet(path)
