"""Garmin cloud and watch normalisers (S10, P20-P31, P39) -> HealthEvent rows.

Every bronze row carries one category document.  Each normaliser turns the
document into an array of candidate HealthEvent structs (NULL where the
source field is missing or filtered out); one ``explode`` over the
non-NULL candidates yields the event rows.  Time series inside a document
(``[[millis, value], ...]``) are handled with ``transform``/``filter`` on the
variant array -- no UDF, no per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import body_str, parse_ts, vget
from ..schemas import HEALTH_EVENT_COLUMNS

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results).
# ---------------------------------------------------------------------------
GARMIN_SOURCE = "garmin_connect"
WATCH_SOURCE = "garmin_connect_iq"
# extract key -> bronze record_type
GARMIN_CATEGORIES = [
    ("stats", "daily_stats"), ("heart_rates", "heart_rates"), ("sleep", "sleep"), ("stress", "stress"),
    ("hrv", "hrv"), ("spo2", "spo2"), ("body_battery", "body_battery"), ("steps", "steps"),
    ("respiration", "respiration"), ("activities", "activities"),
]
# daily stats: garmin key, metric_type, unit
DAILY_STATS = [
    ("restingHeartRate", "heart_rate_resting", "bpm"),
    ("totalSteps", "steps_daily", "count"),
    ("activeKilocalories", "calories_active", "kcal"),
    ("totalKilocalories", "calories_total", "kcal"),
    ("vO2MaxValue", "vo2_max", "ml/kg/min"),
    ("floorsAscended", "floors_climbed", "count"),
    ("averageStressLevel", "stress_avg", "score"),
]
# sleep DTO: garmin key, metric_type, divisor, unit
SLEEP_METRICS = [
    ("sleepTimeSeconds", "sleep_duration", 60.0, "minutes"),
    ("deepSleepSeconds", "sleep_deep", 60.0, "minutes"),
    ("lightSleepSeconds", "sleep_light", 60.0, "minutes"),
    ("remSleepSeconds", "sleep_rem", 60.0, "minutes"),
    ("awakeSleepSeconds", "sleep_awake", 60.0, "minutes"),
    ("averageSpO2Value", "spo2_avg", 1.0, "pct"),
    ("averageRespirationValue", "respiration_avg", 1.0, "brpm"),
]
HRV_STATUS = [("BALANCED", 2.0), ("UNBALANCED", 1.0), ("LOW", 0.0)]  # else -1.0
ACTIVITY_METRICS = [
    ("duration", "workout_duration", "seconds"),
    ("distance", "workout_distance", "meters"),
    ("calories", "workout_calories", "kcal"),
    ("averageHR", "workout_avg_hr", "bpm"),
    ("maxHR", "workout_max_hr", "bpm"),
]
STRESS_SENTINEL = 127.0  # watch: "no reading"
WATCH_CAP_PER_TYPE = 60

META_TYPE = "map<string,string>"


# --- S10: raw daily extracts -> bronze envelope rows ------------------------

def garmin_to_bronze(raw: DataFrame, device_col: str = "device_id", date_col: str = "date",
                     id_col: str = "extract_id", ingested_col: str = "ingested_at") -> DataFrame:
    """One bronze row per non-null category of a daily extract.

    ``raw`` has one VARIANT column per extract key (``stats``, ``sleep`` ...).
    The categories are stacked with one ``explode`` of a (record_type, data)
    array; rows keep the Garmin writer's 5-column shape (user_id and
    source_platform NULL, mixed-case header keys, T9)."""
    cats = F.array(*[F.struct(F.lit(rt).alias("record_type"), F.col(key).alias("data"))
                     for key, rt in GARMIN_CATEGORIES])
    s = raw.select(id_col, device_col, date_col, ingested_col, F.explode(cats).alias("c"))
    s = s.filter(F.col("c.data").isNotNull() & ~F.is_variant_null(F.col("c.data")))
    body = F.to_variant_object(F.struct(
        F.lit(GARMIN_SOURCE).alias("source"), F.col(device_col).alias("device_id"),
        F.col(date_col).alias("date"), F.col("c.data").alias("data")))
    headers = F.to_variant_object(F.struct(
        F.lit("application/json").alias("Content-Type"), F.lit(GARMIN_SOURCE).alias("X-Platform"),
        F.col("c.record_type").alias("X-Record-Type"), F.col(device_col).alias("X-Device-Id"),
        F.date_format(ingested_col, "yyyy-MM-dd'T'HH:mm:ssxxx").alias("X-Upload-Timestamp")))
    return s.select(
        F.concat_ws("-", F.col(id_col), F.col("c.record_type")).alias("record_id"),
        F.col(ingested_col).alias("ingested_at"), body.alias("body"), headers.alias("headers"),
        F.col("c.record_type").alias("record_type"),
        F.lit(None).cast("string").alias("source_platform"), F.lit(None).cast("string").alias("user_id"))


# --- helpers ----------------------------------------------------------------

def _present(v: Column) -> Column:
    """Field present and not JSON null (Python ``is not None``)."""
    return v.isNotNull() & ~F.is_variant_null(v)


def _safe_float(v: Column) -> Column:
    """Bad text becomes 0.0 (``_safe_float``), present values only."""
    return F.coalesce(F.try_variant_get(v, "$", "double"), F.lit(0.0))


def _truthy(v: Column) -> Column:
    """Python truthiness of a scalar field (``a or b`` fallbacks): present,
    and not numeric zero, not empty text, not false."""
    d = F.try_variant_get(v, "$", "double")
    s = F.try_variant_get(v, "$", "string")
    return _present(v) & F.coalesce(d != 0, F.lit(True)) & F.coalesce(s != F.lit(""), F.lit(True))


def _event(metric: str | Column, value: Column, unit: str, ts: Column, meta: Column | None = None) -> Column:
    m = F.lit(metric) if isinstance(metric, str) else metric
    return F.struct(m.alias("metric_type"), value.cast("double").alias("value"), F.lit(unit).alias("unit"),
                    ts.alias("recorded_at"),
                    (meta if meta is not None else F.lit(None).cast(META_TYPE)).alias("metadata"))


def _direct(data: Column, key: str, metric: str, unit: str, ts: Column, divisor: float = 1.0) -> Column:
    v = vget(data, f"$.{key}", "variant")
    return F.when(_present(v), _event(metric, _safe_float(v) / F.lit(divisor), unit, ts))


def _pairs(data: Column, path: str) -> Column:
    """``[[millis, value], ...]`` -> array of (ms, value, ok) structs."""
    arr = vget(data, path, "array<variant>")
    return F.transform(arr, lambda e: F.struct(
        (F.size(F.try_variant_get(e, "$", "array<variant>")) >= 2).alias("ok"),
        F.try_variant_get(e, "$[0]", "bigint").alias("ms"),
        F.try_variant_get(e, "$[1]", "double").alias("v")))


# --- P20-P28 ------------------------------------------------------------------

def _daily_stats(data: Column, day: Column) -> Column:
    """P20."""
    evs = [_direct(data, k, m, u, day) for k, m, u in DAILY_STATS]
    moderate = F.coalesce(vget(data, "$.moderateIntensityMinutes", "double"), F.lit(0.0))
    vigorous = F.coalesce(vget(data, "$.vigorousIntensityMinutes", "double"), F.lit(0.0))
    meta = F.create_map(F.lit("moderate"), moderate.cast("bigint").cast("string"),
                        F.lit("vigorous"), vigorous.cast("bigint").cast("string"))
    evs.append(F.when((moderate > 0) | (vigorous > 0),
                      _event("intensity_minutes", moderate + vigorous, "minutes", day, meta)))
    return F.array(*evs)


def _series(data: Column, path: str, metric: str, unit: str, keep) -> Column:
    """One event per valid pair; ``keep(value)`` filters."""
    return F.transform(_pairs(data, path), lambda p: F.when(
        p["ok"] & p["ms"].isNotNull() & p["v"].isNotNull() & keep(p["v"]),
        _event(metric, p["v"], unit, F.timestamp_millis(p["ms"]))))


def _sleep(data: Column, day: Column) -> Column:
    """P22."""
    dto = vget(data, "$.dailySleepDTO", "variant")
    evs = [_direct(dto, k, m, u, day, d) for k, m, d, u in SLEEP_METRICS]
    evs.append(_direct(dto, "sleepScores.overall.value", "sleep_score", "score", day))
    return F.array(*evs)


def _hrv(data: Column, day: Column) -> Column:
    """P24."""
    summary = vget(data, "$.hrvSummary", "variant")
    status = vget(summary, "$.status", "variant")
    label = F.coalesce(F.try_variant_get(status, "$", "string"), F.to_json(status))
    code = None
    for name, val in HRV_STATUS:
        code = F.when(F.upper(label) == name, F.lit(val)) if code is None else code.when(F.upper(label) == name, F.lit(val))
    return F.array(
        _direct(summary, "weeklyAvg", "hrv_weekly_avg", "ms", day),
        _direct(summary, "lastNight5MinHigh", "hrv_last_night", "ms", day),
        F.when(_present(status), _event("hrv_status", code.otherwise(F.lit(-1.0)), "score", day,
                                        F.create_map(F.lit("status_label"), label))))


def _first_truthy(data: Column, a: str, b: str, metric: str, unit: str, day: Column) -> Column:
    """``a or b`` (0 counts as missing); emitted when the result exists."""
    va, vb = vget(data, f"$.{a}", "variant"), vget(data, f"$.{b}", "variant")
    chosen = F.when(_truthy(va), va).otherwise(vb)
    return F.array(F.when(_present(chosen), _event(metric, _safe_float(chosen), unit, day)))


def _body_battery(data: Column, day: Column) -> Column:
    """List of pairs -> max/min of values > 0; object -> highest/lowest."""
    is_list = vget(data, "$", "array<variant>").isNotNull()
    vals = F.filter(F.transform(_pairs(data, "$"), lambda p: F.when(p["ok"], p["v"])),
                    lambda v: v.isNotNull() & (v > 0))
    listed = F.array(F.when(F.size(vals) > 0, _event("body_battery_high", F.array_max(vals), "score", day)),
                     F.when(F.size(vals) > 0, _event("body_battery_low", F.array_min(vals), "score", day)))
    obj = F.array(_direct(data, "bodyBatteryHighestValue", "body_battery_high", "score", day),
                  _direct(data, "bodyBatteryLowestValue", "body_battery_low", "score", day))
    return F.when(is_list, listed).otherwise(obj)


def _activity_fields(a: Column, ingested: Column) -> list[Column]:
    """P28, per activity object: the shared fields, projected once."""
    atype = vget(a, "$.activityType", "variant")
    type_key = F.when(vget(atype, "$", "map<string,variant>").isNotNull(),
                      F.coalesce(vget(atype, "$.typeKey", "string"), F.lit("unknown"))).otherwise(F.lit("unknown"))

    def text(key: str) -> Column:  # str(activity.get(key, ""))
        v = vget(a, f"$.{key}", "variant")
        return (F.when(v.isNull(), F.lit("")).when(F.is_variant_null(v), F.lit("None"))
                .otherwise(F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v))))

    local, gmt = vget(a, "$.startTimeLocal", "variant"), vget(a, "$.startTimeGMT", "variant")
    start_txt = F.try_variant_get(F.when(_truthy(local), local).otherwise(gmt), "$", "string")
    ts = F.coalesce(parse_ts(F.regexp_replace(start_txt, "Z$", "+00:00")), ingested)  # T16
    meta = F.create_map(F.lit("activity_type"), type_key, F.lit("activity_name"), text("activityName"),
                        F.lit("activity_id"), text("activityId"))
    return [ts.alias("_ts"), meta.alias("_meta"),
            *[vget(a, f"$.{k}", "variant").alias(f"_m{i}") for i, (k, _m, _u) in enumerate(ACTIVITY_METRICS)]]


def _activity_events() -> Column:
    """Up to five metric events from the projected activity fields."""
    return F.array(*[F.when(_present(F.col(f"_m{i}")),
                            _event(m, _safe_float(F.col(f"_m{i}")), u, F.col("_ts"), F.col("_meta")))
                     for i, (_k, m, u) in enumerate(ACTIVITY_METRICS)])


CATEGORY_EVENTS = {
    "daily_stats": lambda data, day, ing: _daily_stats(data, day),
    "heart_rates": lambda data, day, ing: _series(data, "$.heartRateValues", "heart_rate_intraday", "bpm",
                                                  lambda v: v > 0),
    "sleep": lambda data, day, ing: _sleep(data, day),
    "stress": lambda data, day, ing: _series(data, "$.stressValuesArray", "stress_level", "score", lambda v: v >= 0),
    "hrv": lambda data, day, ing: _hrv(data, day),
    "spo2": lambda data, day, ing: _first_truthy(data, "averageSpO2", "averageSpO2Value", "spo2", "pct", day),
    "body_battery": lambda data, day, ing: _body_battery(data, day),
    "respiration": lambda data, day, ing: _first_truthy(data, "avgWakingRespirationValue", "avgSleepRespirationValue",
                                                        "respiration_rate", "brpm", day),
}


def garmin_events(bronze: DataFrame) -> DataFrame:
    """All Garmin cloud categories as HealthEvent rows.

    Garmin rows are recognised by the body envelope (``source``), not by
    record_type alone: Garmin ``sleep`` shares its record_type with HealthKit
    (T9).  The category document is projected once per row; then one branch
    per category, unioned -- each branch scans only its own ``record_type``
    partition and keeps an expression small enough for whole-stage codegen.
    Activities are a two-level ``explode`` (activity, then metric) so the
    per-activity expressions run in generated code, not inside a lambda."""
    data = vget("body", "$.data", "variant")
    g = (bronze.filter(body_str("$.source") == F.lit(GARMIN_SOURCE))
         .select("record_type", "ingested_at", body_str("$.device_id").alias("device_id"),
                 F.to_timestamp(F.try_to_date(body_str("$.date"))).alias("day"), data.alias("data")))
    d, day, ing = F.col("data"), F.col("day"), F.col("ingested_at")
    # an empty object or list yields no candidate in any builder (the
    # reference's "if not data: return"), so only presence is filtered here
    g = g.filter(_present(d))
    keep = ("device_id", "ingested_at")
    parts = []
    for rt, build in CATEGORY_EVENTS.items():
        parts.append(g.filter(F.col("record_type") == rt)
                     .select(*keep, F.explode(F.filter(build(d, day, ing), lambda e: e.isNotNull())).alias("e")))
    acts = (g.filter(F.col("record_type") == "activities")
            .select(*keep, F.explode(vget(d, "$", "array<variant>")).alias("a"))
            .filter(vget("a", "$", "map<string,variant>").isNotNull())  # non-object entries are skipped
            .select(*keep, *_activity_fields(F.col("a"), ing)))
    parts.append(acts.select(*keep, F.explode(F.filter(_activity_events(), lambda e: e.isNotNull())).alias("e")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(GARMIN_SOURCE).alias("source"), "device_id", "e.metric_type", "e.value", "e.unit",
                      "e.recorded_at", "ingested_at", "e.metadata").select(*HEALTH_EVENT_COLUMNS)


def garmin_daily_view(bronze: DataFrame) -> DataFrame:
    """Typed daily-stats columns straight from the variant body."""
    return (bronze.filter(F.col("record_type") == "daily_stats")
            .selectExpr("body:date::STRING AS day",
                        "try_variant_get(body, '$.data.restingHeartRate', 'int') AS resting_hr",
                        "try_variant_get(body, '$.data.totalSteps', 'int') AS steps",
                        "try_variant_get(body, '$.data.totalKilocalories', 'int') AS total_calories",
                        "try_variant_get(body, '$.data.activeKilocalories', 'int') AS active_calories",
                        "try_variant_get(body, '$.data.floorsAscended', 'int') AS floors",
                        "try_variant_get(body, '$.data.averageStressLevel', 'int') AS avg_stress",
                        "try_variant_get(body, '$.data.vO2MaxValue', 'double') AS vo2_max"))


def _round(x: Column, digits: int) -> Column:
    return F.round(x.cast("decimal(38,10)"), digits).cast("double")


def garmin_sleep_view(bronze: DataFrame) -> DataFrame:
    """Hours and minutes of the night's stages and its score."""
    seconds = lambda name: F.try_variant_get("body", f"$.data.dailySleepDTO.{name}", "int")
    minutes = {"deep_min": "deepSleepSeconds", "light_min": "lightSleepSeconds", "rem_min": "remSleepSeconds"}
    return bronze.filter(F.col("record_type") == "sleep").select(
        body_str("$.date").alias("day"), _round(seconds("sleepTimeSeconds") / 3600, 1).alias("sleep_hours"),
        *[_round(seconds(c) / 60, 0).alias(n) for n, c in minutes.items()],
        F.try_variant_get("body", "$.data.dailySleepDTO.sleepScores.overall.value", "int").alias("sleep_score"))


def garmin_hrv_view(bronze: DataFrame) -> DataFrame:
    """Weekly average, last night and status of heart-rate variability."""
    get = lambda name, kind: F.try_variant_get("body", f"$.data.hrvSummary.{name}", kind)
    return bronze.filter(F.col("record_type") == "hrv").select(
        body_str("$.date").alias("day"), get("weeklyAvg", "double").alias("hrv_weekly_avg_ms"),
        get("lastNight5MinHigh", "double").alias("hrv_last_night_ms"), get("status", "string").alias("hrv_status"))


# --- P30, P31: watch batches --------------------------------------------------

def explode_watch_batch(bronze: DataFrame) -> DataFrame:
    """CIQ ``records[]`` -> HealthEvent rows; stress 127 is a sentinel."""
    recs = vget("body", "$.records", "array<struct<metric_type:string,value:double,unit:string,"
                                     "recorded_at:string,device_id:string,source:string>>")
    w = bronze.filter(body_str("$.source") == F.lit(WATCH_SOURCE)).select("ingested_at", F.explode(recs).alias("r"))
    w = w.filter(~((F.col("r.metric_type") == "stress_level") & (F.col("r.value") == STRESS_SENTINEL)))
    return w.select(F.col("r.source").alias("source"), F.col("r.device_id").alias("device_id"),
                    F.col("r.metric_type").alias("metric_type"), F.col("r.value").alias("value"),
                    F.col("r.unit").alias("unit"), parse_ts(F.col("r.recorded_at")).alias("recorded_at"),
                    "ingested_at", F.lit(None).cast(META_TYPE).alias("metadata"))


def incremental_since(events: DataFrame, since: DataFrame | str, cap: int | None = None) -> DataFrame:
    """Per device and metric, only samples newer than the stored
    high-water mark; with ``cap`` (a watch's buffer holds
    ``WATCH_CAP_PER_TYPE``) only the newest ``cap`` of each.  ``since`` is a timestamp literal or a (device_id, since) frame.
    ``row_number() <= cap`` is planned with a map-side WindowGroupLimit."""
    from pyspark.sql import Window
    if isinstance(since, str):
        fresh = events.filter(F.col("recorded_at") > F.to_timestamp(F.lit(since)))
    else:
        fresh = (events.join(since.select("device_id", F.col("since").alias("_since")), "device_id", "left")
                 .filter(F.col("_since").isNull() | (F.col("recorded_at") > F.col("_since"))).drop("_since"))
    if cap is None:
        return fresh
    w = Window.partitionBy("device_id", "metric_type").orderBy(F.col("recorded_at").desc(), F.col("value").desc())
    return fresh.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= cap).drop("_rn")
