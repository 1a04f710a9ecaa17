"""Gold kept up to date from new silver rows only.

A gold table is held as mergeable partial states, one row per key and period:
sums, counts, minima, maxima and distinct sets.  A batch of silver rows is
reduced to such states, merged with the stored states of the periods it touches,
and published as a new version of a ``SnapshotTable`` partitioned by period;
all other periods keep their files and are not read.  The batch's id goes with
the same commit, so a replay after a crash adds nothing twice.

Averages are the ratio of two states, so they equal a full recompute up to the
last bits of a sum of doubles.  Distinct sets (record ids of a user's night,
activity types of a user's week) are bounded by their key, not by the corpus.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.labels import hk_family
from ..operators.gold import SLEEP_STAGE_COLUMNS, stage_minutes
from ..sources.snapshots import SnapshotTable

#: how states of one kind are made from rows, and merged
MAKE: dict[str, Callable[[Column], Column]] = {
    "sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "set": F.collect_set}
MERGE: dict[str, Callable[[str], Column]] = {
    "sum": F.sum, "count": F.sum, "min": F.min, "max": F.max,
    "set": lambda c: F.array_distinct(F.flatten(F.collect_list(c)))}

Expr = str | Callable[[], Column]


def _column(expr: Expr) -> Column:
    return F.expr(expr) if isinstance(expr, str) else expr()


@dataclass(frozen=True)
class Rollup:
    """A gold table: the silver table it reads, its keys and period, its states and the columns made of them."""

    source: str
    where: str
    keys: dict[str, Expr]
    by: str
    period: str
    states: dict[str, tuple[str, Expr]]
    columns: dict[str, str]

    def partial(self, rows: DataFrame) -> DataFrame:
        groups = [_column(c).alias(n) for n, c in self.keys.items()] + [F.expr(self.period).alias(self.by)]
        return rows.filter(self.where).groupBy(*groups).agg(*[MAKE[kind](_column(c)).alias(n) for n, (kind, c) in self.states.items()])

    def merge(self, states: DataFrame) -> DataFrame:
        return states.groupBy(*self.keys, self.by).agg(*[MERGE[kind](n).alias(n) for n, (kind, _) in self.states.items()])

    def finish(self, states: DataFrame) -> DataFrame:
        return states.select(*self.keys, self.by, *[F.expr(c).alias(n) for n, c in self.columns.items()])


def _of(value: str) -> dict[str, tuple[str, Expr]]:
    return {"s": ("sum", value), "c": ("count", value), "lo": ("min", value), "hi": ("max", value)}


_USER: dict[str, Expr] = {"user_id": "user_id"}
_STAGE_MINUTES = {out: ("sum", lambda stage=stage: F.when(F.col("sleep_stage") == stage, stage_minutes()).otherwise(F.lit(0.0)))
                  for stage, out in SLEEP_STAGE_COLUMNS}

_CARDIO = {"resting_hr_avg": "contains(hk_type, 'RestingHeartRate')", "hrv_sdnn_avg": "contains(hk_type, 'HeartRateVariability')",
           "spo2_avg": "contains(hk_type, 'OxygenSaturation')", "heart_rate_avg": "contains(hk_type, 'HeartRate') AND NOT contains(hk_type, 'Resting')"}


def _cardio(strict: bool) -> Rollup:
    """G7; ``strict`` keeps heart-rate variability out of the heart rate."""
    types = _CARDIO | ({"heart_rate_avg": f"{_CARDIO['heart_rate_avg']} AND NOT contains(hk_type, 'HeartRateVariability')"} if strict else {})
    value = {name: f"CASE WHEN {t} THEN value END" for name, t in types.items()}
    return Rollup(
        "samples", "start_at IS NOT NULL AND (" + " OR ".join(f"({t})" for t in types.values()) + ")", _USER, "day", "to_date(start_at)",
        {f"s_{n}": ("sum", v) for n, v in value.items()} | {f"c_{n}": ("count", v) for n, v in value.items()} | {"top": ("max", value["heart_rate_avg"])},
        {n: f"s_{n} / nullif(c_{n}, 0)" for n in value} | {"heart_rate_max": "top"})


ROLLUPS: dict[str, Rollup] = {
    "cardio_vitals": _cardio(False),
    "cardio_vitals_strict": _cardio(True),
    "hk_quantity_daily": Rollup(
        "samples", "value IS NOT NULL AND hk_type IS NOT NULL", _USER | {"hk_type": "hk_type"}, "day", "to_date(start_at)", _of("value"),
        {"avg_value": "s / c", "min_value": "lo", "max_value": "hi", "sample_rows": "c"}),
    "subject_daily": Rollup(
        "events", "value_number IS NOT NULL", {"subject_id": "subject_id", "metric_type": "metric_type"}, "day", "to_date(effective_time)",
        _of("value_number"), {"avg_value_number": "s / c", "min_value_number": "lo", "max_value_number": "hi", "event_count": "c"}),
    "daily_steps": Rollup(
        "samples", "value IS NOT NULL AND contains(hk_type, 'StepCount')", _USER, "day", "to_date(start_at)", _of("value"),
        {"total_steps": "s", "sample_intervals": "c"}),
    "hr_intraday": Rollup(
        "samples", "value IS NOT NULL AND contains(hk_type, 'HeartRate') AND NOT contains(hk_type, 'Resting')", _USER, "day", "to_date(start_at)",
        _of("value"), {"avg_hr": "s / c", "min_hr": "lo", "max_hr": "hi", "reading_count": "c"}),
    "family_weekly": Rollup(
        "samples", "value IS NOT NULL", _USER | {"metric_family": hk_family}, "week_start", "date_trunc('week', start_at)", _of("value"),
        {"avg_value": "s / c", "sum_value": "s", "readings": "c"}),
    "sleep_nightly": Rollup(
        "sleep_stages", "stage_start_at IS NOT NULL AND stage_end_at IS NOT NULL", _USER, "sleep_night", "to_date(session_start_at)",
        _STAGE_MINUTES | {"total": ("sum", stage_minutes), "ids": ("set", "sleep_record_id")},
        {out: out for _, out in SLEEP_STAGE_COLUMNS} | {"total_tracked_min": "total", "sleep_sessions": "bigint(size(ids))"}),
    "weekly_workouts": Rollup(
        "workouts", "start_at IS NOT NULL", _USER, "week_start", "date_trunc('week', start_at)",
        {"n": ("count", "1"), "minutes": ("sum", "duration_seconds / 60.0D"), "seconds": ("sum", "duration_seconds"),
         "kcal": ("sum", "total_energy_burned_kcal"), "metres": ("sum", "total_distance_meters"), "kinds": ("set", "activity_type")},
        {"workout_count": "n", "total_duration_min": "minutes", "total_energy_kcal": "kcal", "total_distance_m": "metres",
         "avg_speed_m_per_s": "metres / nullif(seconds, 0.0D)", "distinct_activity_types": "bigint(size(kinds))"}),
    "ingest_daily": Rollup(
        "bronze", "true", _USER | {"record_type": "record_type"}, "ingest_day", "to_date(ingested_at)", {"n": ("count", "1")}, {"row_count": "n"}),
}


class IncrementalGold:
    """The gold tables of ``ROLLUPS`` under ``root``, one snapshot table each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, name: str, like: DataFrame | None = None) -> SnapshotTable:
        """The states of one gold table; their schema is kept beside it at first use."""
        from pyspark.sql.types import StructType

        rollup, place = ROLLUPS[name], f"{self.root}/{name}"
        probe = SnapshotTable(self.spark, place, rollup.by, StructType())
        known = probe.manifest()["meta"].get("schema")
        if known is None:
            if like is None:
                raise ValueError(f"{name} has no data yet")
            return SnapshotTable(self.spark, place, rollup.by, rollup.merge(rollup.partial(like)).schema)
        return SnapshotTable(self.spark, place, rollup.by, StructType.fromJson(known))

    def update(self, name: str, rows: DataFrame, batch: int) -> list[str]:
        """Fold a batch of new silver rows in; the periods rewritten (none for a batch that is in already).

        Batches are numbered upwards; the first write of a number counts."""
        rollup, table = ROLLUPS[name], self.table(name, rows)
        held = table.manifest()
        if batch <= held["meta"].get("batch", -1):
            return []
        new = rollup.partial(rows).persist()
        try:
            touched = [r[0] for r in new.select(F.col(rollup.by).cast("string")).distinct().collect()]  # the periods of one batch
            states = rollup.merge(table.read(held["version"], touched).unionByName(new))
            table.replace(states, touched, {"batch": batch, "schema": table.schema.jsonValue()}, held["version"])
        finally:
            new.unpersist()
        return touched

    def read(self, name: str) -> DataFrame:
        return ROLLUPS[name].finish(self.table(name).read())

    def follow(self, silver: DataFrame, names: list[str], checkpoint: str) -> StreamingQuery:
        """Keep ``names`` (all of one silver table) up to date from a stream of its rows."""
        def step(batch: DataFrame, epoch: int) -> None:
            batch.persist()
            try:
                for name in names:
                    self.update(name, batch, epoch)
            finally:
                batch.unpersist()

        return (silver.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
