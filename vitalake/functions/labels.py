"""Scalar rules over typed columns: channels, families, labels, ratios.

Each helper returns a Column built from built-in functions so it stays inside
whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .variant import header

# Fixed values (must equal the reference for identical results).
SEED_DEVICE_ID = "demo-notebook-seed"
CHANNEL_SIMULATOR = "notebook_simulator"
CHANNEL_REST = "rest_app"
LABEL_PREFIXES = ["HKQuantityTypeIdentifier", "HKCategoryTypeIdentifier", "HKCorrelationTypeIdentifier"]
# hk_type substring -> metric family, first match wins.
FAMILY_RULES = [
    ("StepCount", "steps"),
    ("ActiveEnergy", "active_energy"),
    ("DistanceWalking", "distance"),
    ("HeartRate", "heart_rate"),
    ("OxygenSaturation", "spo2"),
    ("FlightsClimbed", "flights"),
]


def ingest_channel() -> Column:
    """Explicit ``x-ingest-channel`` -> seed device -> ``rest_app``."""
    explicit = F.lower(F.trim(header("x-ingest-channel")))
    device = F.lower(F.trim(header("x-device-id")))
    return (F.when(explicit.isNotNull() & (F.length(explicit) > 0), explicit)
            .when(device == F.lit(SEED_DEVICE_ID), F.lit(CHANNEL_SIMULATOR))
            .otherwise(F.lit(CHANNEL_REST)))


def channel_predicate(mode: str | None) -> Column:
    """``all``/empty/unknown keep everything, else channel equality."""
    m = (mode or "").strip().lower()
    if m in (CHANNEL_SIMULATOR, CHANNEL_REST):
        return ingest_channel() == F.lit(m)
    return F.lit(True)


def hk_family(col: str = "hk_type") -> Column:
    """7-way family by substring (T1: resting HR and HRV land in heart_rate)."""
    c = F.col(col)
    out = None
    for needle, fam in FAMILY_RULES:
        out = F.when(c.contains(needle), F.lit(fam)) if out is None else out.when(c.contains(needle), F.lit(fam))
    return out.otherwise(F.lit("other"))


def metric_short(col: str = "hk_type") -> Column:
    """Drop the ``HKQuantityTypeIdentifier`` prefix."""
    return F.regexp_replace(F.col(col), "HKQuantityTypeIdentifier", "")


def display_label(col: str = "hk_type") -> Column:
    """Strip one known prefix, then a space before each inner capital."""
    c = F.col(col)
    stripped = F.regexp_replace(c, "^(" + "|".join(LABEL_PREFIXES) + ")", "")
    spaced = F.regexp_replace(stripped, "(?<=.)(\\p{Lu})", " $1")
    return F.when(F.length(spaced) > 0, spaced).otherwise(c)


def ring_ratio(actual: Column | str, goal: Column | str, digits: int = 3) -> Column:
    """round(actual / nullif(goal, 0), n) -- NULL on a zero goal."""
    a = F.col(actual) if isinstance(actual, str) else actual
    g = F.col(goal) if isinstance(goal, str) else goal
    return F.round(a / F.nullif(g, F.lit(0.0)), digits)


def session_duration_seconds(start: Column, end: Column) -> Column:
    """(end - start) in whole milliseconds / 1000."""
    return F.timestamp_diff("MILLISECOND", start, end) / F.lit(1000.0)


def user_like(search: str | None) -> str:
    """Empty search -> ``%``, else ``%q%``."""
    s = (search or "").strip()
    return "%" if not s else f"%{s}%"


def ordered_window(start: str, end: str) -> tuple[str, str]:
    """Swapped window bounds are put back in order."""
    return (start, end) if start <= end else (end, start)
