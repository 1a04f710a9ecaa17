"""Ingest quality checks as one (check, passed, detail) frame.

The six rules of the reference's end-to-end validation, evaluated over
*every* ingested row (the reference samples the first row for the header
and body rules).  Each rule is a conditional aggregate; the one-row
aggregates are combined without a join and the rule rows are produced with
``stack``, so nothing is collected to the driver.

``land_checked`` applies the rules in the write itself and publishes only rows
that pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schemas import KNOWN_RECORD_TYPES
from ..sources.snapshots import SnapshotTable
from .marts import one_row

# Fixed values (must equal the reference).
CHECK_BLOCKED = ["authorization", "cookie", "set-cookie"]
EXPECTED_HEADERS = ["x-record-type", "x-platform", "x-device-id", "x-ingest-channel", "content-type"]
SAMPLE_BODY_KEYS = ["uuid", "type", "value", "unit", "start_date", "end_date", "source_name"]
MIN_EXPECTED_HEADERS = 3


def ingest_quality_checks(bronze: DataFrame, ingested_ids: DataFrame, expected_platform: str,
                          expected_user: str | None = None,
                          expected_types: list[str] = KNOWN_RECORD_TYPES) -> DataFrame:
    ids = ingested_ids.select("record_id").distinct()
    rows = bronze.join(ids, "record_id", "left_semi")
    keys = F.map_keys(F.try_variant_get(F.col("headers"), "$", "map<string,variant>"))
    body_keys = F.map_keys(F.try_variant_get(F.col("body"), "$", "map<string,variant>"))
    bad_header = (F.size(F.array_intersect(keys, F.array(*[F.lit(h) for h in CHECK_BLOCKED]))) > 0) | (
        F.size(F.array_intersect(keys, F.array(*[F.lit(h) for h in EXPECTED_HEADERS]))) < MIN_EXPECTED_HEADERS)
    bad_body = (F.col("record_type") == "samples") & (
        F.size(F.array_except(F.array(*[F.lit(k) for k in SAMPLE_BODY_KEYS]), F.coalesce(body_keys, F.array()))) > 0)
    a = rows.agg(
        F.count(F.lit(1)).alias("found"),
        F.count_distinct(F.coalesce("source_platform", F.lit("<null>"))).alias("n_platforms"),
        F.count_if(F.coalesce(F.col("source_platform"), F.lit("")) != expected_platform).alias("off_platform"),
        F.count_if(bad_header).alias("bad_headers"),
        F.count_if(F.col("record_type") == "samples").alias("sample_rows"),
        F.count_if(bad_body).alias("bad_bodies"),
        F.count_distinct(F.coalesce("user_id", F.lit("<null>"))).alias("n_users"),
        F.count_if(F.coalesce(F.col("user_id"), F.lit("")) != F.lit(expected_user or "")).alias("off_user"))
    expected = ids.agg(F.count(F.lit(1)).alias("expected"))
    types = bronze.select("record_type").distinct().filter(F.col("record_type").isin(expected_types)) \
        .agg(F.count(F.lit(1)).alias("types_present"))
    j = one_row([a, expected, types], a.columns + ["expected", "types_present"])
    n_types = len(expected_types)
    checks = j.select(F.expr(f"""stack(6,
        'ids_present', found = expected, format_string('found=%d expected=%d', found, expected),
        'single_platform', n_platforms = 1 AND off_platform = 0,
            format_string('platforms=%d off_platform=%d', n_platforms, off_platform),
        'header_blocklist', found > 0 AND bad_headers = 0, format_string('rows_failing=%d', bad_headers),
        'sample_body_keys', sample_rows > 0 AND bad_bodies = 0,
            format_string('sample_rows=%d rows_missing_keys=%d', sample_rows, bad_bodies),
        'record_types_present', types_present = {n_types}, format_string('present=%d expected={n_types}', types_present),
        'single_user', n_users = 1 AND off_user = 0, format_string('users=%d off_user=%d', n_users, off_user)
    ) AS (check, passed, detail)"""))
    return checks


class QualityRefused(RuntimeError):
    """A required check failed; the rows were not published."""

    def __init__(self, checks: list[tuple[str, bool, str]]):
        self.checks = checks
        super().__init__("; ".join(f"{name}: {detail}" for name, passed, detail in checks if not passed))


def _ends(name: str) -> list[Column]:
    """Least and greatest value of a column, NULL as a value: equal if there is only one."""
    text = F.coalesce(F.col(name), F.lit("<null>"))
    return [F.min(text).alias(f"{name}_least"), F.max(text).alias(f"{name}_most")]


def gate_metrics(expected_platform: str, expected_types: list[str] = KNOWN_RECORD_TYPES) -> list[Column]:
    """The aggregates that the checks need, without a distinct count, so that they can be observed while rows are written."""
    keys = F.map_keys(F.try_variant_get(F.col("headers"), "$", "map<string,variant>"))
    body_keys = F.map_keys(F.try_variant_get(F.col("body"), "$", "map<string,variant>"))
    bad_header = (F.size(F.array_intersect(keys, F.array(*[F.lit(h) for h in CHECK_BLOCKED]))) > 0) | (
        F.size(F.array_intersect(keys, F.array(*[F.lit(h) for h in EXPECTED_HEADERS]))) < MIN_EXPECTED_HEADERS)
    missing = F.size(F.array_except(F.array(*[F.lit(k) for k in SAMPLE_BODY_KEYS]), F.coalesce(body_keys, F.array()))) > 0
    return [F.count(F.lit(1)).alias("found"), F.count_if(F.col("record_id").isNull() | F.col("ingested_at").isNull()).alias("unkeyed"),
            F.count_if(F.coalesce(F.col("source_platform"), F.lit("")) != expected_platform).alias("off_platform"),
            F.count_if(F.coalesce(bad_header, F.lit(True))).alias("bad_headers"),
            F.count_if(F.col("record_type") == "samples").alias("sample_rows"),
            F.count_if((F.col("record_type") == "samples") & missing).alias("bad_bodies"),
            *[F.max(F.col("record_type") == t).alias(f"has_{k}") for k, t in enumerate(expected_types)], *_ends("user_id")]


def gate_checks(m: dict, expected_rows: int | None, expected_types: list[str] = KNOWN_RECORD_TYPES) -> list[tuple[str, bool, str]]:
    """(check, passed, detail) of observed metrics."""
    present = sum(bool(m[f"has_{k}"]) for k in range(len(expected_types)))
    wanted = m["found"] if expected_rows is None else expected_rows
    return [("rows_present", m["found"] == wanted, f"found={m['found']} expected={wanted}"),
            ("keys_present", m["unkeyed"] == 0, f"rows_failing={m['unkeyed']}"),
            ("single_platform", m["off_platform"] == 0, f"off_platform={m['off_platform']}"),
            ("header_blocklist", m["bad_headers"] == 0, f"rows_failing={m['bad_headers']}"),
            ("sample_body_keys", m["bad_bodies"] == 0, f"sample_rows={m['sample_rows']} rows_missing_keys={m['bad_bodies']}"),
            ("record_types_present", present == len(expected_types), f"present={present} expected={len(expected_types)}"),
            ("single_user", m["found"] > 0 and m["user_id_least"] == m["user_id_most"], f"users={'one' if m['user_id_least'] == m['user_id_most'] else 'several'}")]


#: checks that must pass before rows are published
REQUIRED = ("rows_present", "keys_present", "single_platform", "header_blocklist", "sample_body_keys")


def land_checked(table: SnapshotTable, rows: DataFrame, expected_platform: str, expected_rows: int | None = None,
                 required: tuple[str, ...] = REQUIRED) -> list[tuple[str, bool, str]]:
    """R23 in the write pass: append ``rows`` to ``table`` and check them while they are written (no second
    scan).  The version is published with its checks only if all ``required`` ones pass; else
    ``QualityRefused``, and readers never see the rows."""
    base = table.version()
    seen = Observation()
    written = table.write(rows.observe(seen, *gate_metrics(expected_platform)))
    checks = gate_checks(seen.get, expected_rows)
    if any(not passed for name, passed, _ in checks if name in required):
        raise QualityRefused(checks)
    held = table.manifest(base)["parts"]
    table.commit(base, {p: [*held.get(p, []), f] for p, f in written.items()}, {"checks": checks})
    return checks
