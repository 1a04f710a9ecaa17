"""Bind the driver's ``events`` to the other platforms' landing shapes.

* Garmin cloud: each event becomes one daily extract with a single category
  (``k % 10`` picks it), turned into bronze by ``garmin_to_bronze`` (S10);
* Garmin watch: each event becomes one Connect IQ batch with four records
  (one a stress sentinel 127 for a third of them);
* Health Connect: the five Android record shapes, like the HealthKit
  binding (view -> samples, click -> workouts, signup -> sleep,
  purchase -> daily_summaries, error -> deletes).

Every document is built with ``to_json(struct)`` -> ``parse_json``; ``k``
(0-99) and ``j = k // 10`` drive the edge cases the normalisers must meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dims import HC_EXERCISE_NAMES, HC_SLEEP_STAGES, name_expr
from ..functions.variant import iso_z
from ..operators.garmin import GARMIN_CATEGORIES, WATCH_SOURCE, garmin_to_bronze
from ..schemas import BRONZE_COLUMNS
from .bindings import EVENT_RECORD_TYPES, k_col

HC_PLATFORM = "android_health_connect"
HC_ORIGIN = "com.google.android.apps.fitness"
# Health Connect record classes landed by the binding; the last is not a
# sample class the mapper knows (P12 skips it).
HC_CLASSES = ["StepsRecord", "DistanceRecord", "ActiveCaloriesBurnedRecord", "BasalMetabolicRateRecord",
              "HeartRateRecord", "RestingHeartRateRecord", "HeartRateVariabilityRmssdRecord",
              "OxygenSaturationRecord", "Vo2MaxRecord", "NutritionRecord"]
HC_INSTANT_CLASSES = ["BasalMetabolicRateRecord", "RestingHeartRateRecord", "HeartRateVariabilityRmssdRecord",
                      "OxygenSaturationRecord", "Vo2MaxRecord"]
HC_EXERCISE_CODES = [56, 8, 73, 80, 35, 9999]
HC_ZONES = ["America/Los_Angeles", "Europe/Berlin", "UTC"]
HRV_STATUS_TEXT = ["BALANCED", "unbalanced", "LOW", "POOR"]


def _base(events: DataFrame) -> DataFrame:
    k = k_col()
    return events.select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"),
                         (k / 10).cast("int").alias("j"), F.col("ts").cast("timestamp").alias("_t"))


def _pick(values: list, idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx + 1)


def _min(n) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"))


def _json(c: Column) -> Column:
    return F.to_json(c)


# --- Garmin cloud -----------------------------------------------------------

def garmin_raw_extracts(events: DataFrame) -> DataFrame:
    """One daily extract per event (only the ``k % 10`` category set)."""
    e = _base(events)
    k, j, t = F.col("k"), F.col("j"), F.col("_t")
    ms = F.unix_millis(F.date_trunc("second", t))
    cat = k % 10

    def pair(a: Column, b: Column | None) -> Column:
        return F.array(a.cast("double"), b.cast("double")) if b is not None else F.array(a.cast("double"))

    stats = _json(F.struct(
        (50 + j).alias("restingHeartRate"), (k * 100).alias("totalSteps"), F.col("value").alias("activeKilocalories"),
        (F.col("value") + 1500).alias("totalKilocalories"), F.when(j % 3 != 0, 40 + j).alias("vO2MaxValue"),
        j.alias("floorsAscended"), (k % 50).alias("averageStressLevel"),
        F.when(j % 2 == 0, F.lit(0)).otherwise(j * 3).alias("moderateIntensityMinutes"),
        F.when(j % 3 == 0, F.lit(0)).otherwise(j).alias("vigorousIntensityMinutes")))
    heart = _json(F.struct(F.array(
        pair(ms, 60 + j), pair(ms + 60000, F.when(j % 2 == 0, F.lit(0)).otherwise(70 + j)),
        pair(ms + 120000, F.lit(None)), pair(ms + 180000, None)).alias("heartRateValues")))
    sleep = _json(F.struct(F.struct(
        (25200 + k * 60).alias("sleepTimeSeconds"), (3600 + j * 60).alias("deepSleepSeconds"),
        F.lit(10800).alias("lightSleepSeconds"), (5400 + j * 30).alias("remSleepSeconds"),
        (j * 60).alias("awakeSleepSeconds"), (95 + j % 4).alias("averageSpO2Value"),
        F.lit(14.5).alias("averageRespirationValue"),
        F.when(j % 5 != 0, F.struct(F.struct((60 + j).alias("value")).alias("overall"))).alias("sleepScores"),
    ).alias("dailySleepDTO")))
    stress = _json(F.struct(F.array(pair(ms, 20 + j), pair(ms + 180000, F.lit(-1)), pair(ms + 360000, F.lit(-2)),
                                    pair(ms + 540000, 40 + j)).alias("stressValuesArray")))
    hrv = _json(F.struct(F.struct((40 + j).alias("weeklyAvg"), (50 + j).alias("lastNight5MinHigh"),
                                  _pick(HRV_STATUS_TEXT, j % 4).alias("status")).alias("hrvSummary")))
    spo2 = _json(F.struct(F.when(j % 3 == 0, F.lit(0)).otherwise(90 + j).alias("averageSpO2"),
                          F.lit(97).alias("averageSpO2Value")))
    battery = F.when(j % 2 == 0, _json(F.array(pair(ms, 80 - j), pair(ms + 60000, F.lit(0)), pair(ms + 120000, 30 + j)))
                     ).otherwise(_json(F.struct((90 - j).alias("bodyBatteryHighestValue"),
                                                 (10 + j).alias("bodyBatteryLowestValue"))))
    steps = _json(F.array(F.struct(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.S").alias("startGMT"), k.alias("steps"))))
    resp = _json(F.struct(F.when(j % 2 == 0, F.lit(0)).otherwise(15 + j).alias("avgWakingRespirationValue"),
                          F.lit(13).alias("avgSleepRespirationValue")))
    run = _json(F.struct(F.col("event_id").alias("activityId"), F.struct(F.lit("running").alias("typeKey")).alias("activityType"),
                         F.lit("Run").alias("activityName"), F.date_format(t, "yyyy-MM-dd HH:mm:ss").alias("startTimeLocal"),
                         (k * 60).alias("duration"), (k * 100).alias("distance"), F.col("value").alias("calories"),
                         (120 + j).alias("averageHR"), (160 + j).alias("maxHR")))
    walk = _json(F.struct((F.col("event_id") * 10).alias("activityId"), F.lit("walking").alias("activityType"),
                          iso_z(t).alias("startTimeGMT"), F.lit(600).alias("duration")))
    acts = F.when(j % 2 == 0, F.concat(F.lit("["), run, F.lit("]"))).otherwise(F.concat(F.lit("["), run, F.lit(","), walk, F.lit("]")))
    docs = [stats, heart, sleep, stress, hrv, spo2, battery, steps, resp, acts]
    cols = [F.when(cat == i, F.parse_json(doc)).alias(key) for i, ((key, _rt), doc) in enumerate(zip(GARMIN_CATEGORIES, docs))]
    return e.select(
        F.concat(F.lit("g"), F.col("event_id").cast("string")).alias("extract_id"),
        F.concat(F.lit("garmin-"), F.col("user_id").cast("string")).alias("device_id"),
        F.date_format(t, "yyyy-MM-dd").alias("date"),
        (F.to_timestamp(F.to_date(t)) + F.make_dt_interval(F.lit(1), F.lit(7))).alias("ingested_at"),
        *cols)


def garmin_bronze(events: DataFrame) -> DataFrame:
    return garmin_to_bronze(garmin_raw_extracts(events)).select(*BRONZE_COLUMNS)


# --- Garmin watch -----------------------------------------------------------

def watch_bronze(events: DataFrame) -> DataFrame:
    e = _base(events)
    k, j, t = F.col("k"), F.col("j"), F.col("_t")
    dev = F.concat(F.lit("watch-"), F.col("user_id").cast("string"))

    def rec(metric: str, value: Column, unit: str, when: Column) -> Column:
        return F.struct(F.lit(metric).alias("metric_type"), value.cast("double").alias("value"), F.lit(unit).alias("unit"),
                        iso_z(when).alias("recorded_at"), dev.alias("device_id"), F.lit(WATCH_SOURCE).alias("source"))

    one_min = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(1))
    records = F.array(rec("heart_rate_intraday", 60 + j, "bpm", t),
                      rec("stress_level", F.when(k % 3 == 0, F.lit(127)).otherwise(j * 5), "score", t - one_min),
                      rec("body_battery_current", 50 + j, "score", t - one_min - one_min),
                      rec("steps_intraday", k * 10, "count", t))
    body = F.struct(records.alias("records"), dev.alias("device_id"), F.lit(WATCH_SOURCE).alias("source"),
                    iso_z(t).alias("upload_timestamp"))
    headers = F.struct(F.lit("application/json").alias("Content-Type"), F.lit("garmin_connect_iq").alias("X-Platform"),
                       F.lit("samples").alias("X-Record-Type"), dev.alias("X-Device-Id"))
    return e.select(F.concat(F.lit("w"), F.col("event_id").cast("string")).alias("record_id"),
                    (t + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(5))).alias("ingested_at"),
                    F.parse_json(F.to_json(body)).alias("body"), F.parse_json(F.to_json(headers)).alias("headers"),
                    F.lit("samples").alias("record_type"), F.lit(None).cast("string").alias("source_platform"),
                    F.lit(None).cast("string").alias("user_id"))


# --- Health Connect -----------------------------------------------------------

def hc_bronze(events: DataFrame) -> DataFrame:
    e = _base(events).filter(F.col("event_type").isin(list(EVENT_RECORD_TYPES)))
    k, j, t = F.col("k"), F.col("j"), F.col("_t")
    hid = F.concat(F.lit("h"), F.col("event_id").cast("string"))
    zone = F.when(k % 2 == 1, F.lit("-08:00")).otherwise(F.lit("+00:00"))
    common = [F.lit(HC_ORIGIN).alias("data_origin"), iso_z(t).alias("last_modified_time")]
    cls = _pick(HC_CLASSES, k % len(HC_CLASSES))
    instant = cls.isin(HC_INSTANT_CLASSES)
    hr_samples = F.transform(F.sequence(F.lit(0), k % 3), lambda i: F.struct(
        iso_z(t + _min(i)).alias("time"), (60 + i + j).cast("bigint").alias("beats_per_minute")))
    sample = F.struct(
        hid.alias("id"), cls.alias("type"),
        F.when(cls != "HeartRateRecord", F.col("value")).alias("value"),
        F.when(cls == "HeartRateRecord", hr_samples).alias("samples"),
        iso_z(t).alias("start_time"), F.when(instant, iso_z(t)).otherwise(iso_z(t + _min(k))).alias("end_time"),
        zone.alias("start_zone_offset"), zone.alias("end_zone_offset"), *common)
    code = _pick(HC_EXERCISE_CODES, k % len(HC_EXERCISE_CODES))
    workout = F.struct(
        hid.alias("id"), F.when(k % 4 != 0, name_expr(HC_EXERCISE_NAMES, code)).alias("exercise_type"),
        code.alias("exercise_type_code"), F.when(k % 2 == 1, F.lit("Morning")).alias("title"),
        iso_z(t).alias("start_time"), iso_z(t + _min(k)).alias("end_time"), zone.alias("start_zone_offset"),
        (k * 60.0).alias("duration_seconds"), *common)
    plan = [(4, 0, 120), (5, 120, 200), (6, 200, 260)]
    stage_list = [F.struct(F.when(k % 5 != 0, name_expr(HC_SLEEP_STAGES, F.lit(c))).alias("stage"),
                           F.lit(c).alias("stage_code"), iso_z(t + _min(a)).alias("start_time"),
                           iso_z(t + _min(b)).alias("end_time")) for c, a, b in plan]
    stage_list.append(F.struct(F.when(k % 5 != 0, F.lit("awake")).alias("stage"), F.lit(1).alias("stage_code"),
                               iso_z(t + _min(260)).alias("start_time"), iso_z(t + _min(260 + k % 20)).alias("end_time")))
    sleep = F.struct(hid.alias("id"), iso_z(t).alias("start_time"), iso_z(t + _min(260 + k % 20)).alias("end_time"),
                     ((260 + k % 20) * 60.0).alias("duration_seconds"), *common, F.array(*stage_list).alias("stages"))
    daily = F.struct(F.date_format(t, "yyyy-MM-dd").alias("date"), _pick(HC_ZONES, k % 3).alias("timezone"),
                     (k * 100).cast("bigint").alias("total_steps"), F.col("value").alias("active_calories_burned_kcal"),
                     (k * 50.0).alias("total_distance_meters"),
                     F.when(k % 2 == 0, k / 2.0).alias("exercise_duration_minutes"))
    delete = F.struct(F.concat(F.lit("h"), (F.col("event_id") - 1).cast("string")).alias("id"),
                      cls.alias("record_type"), iso_z(t).alias("deleted_time"))
    et = F.col("event_type")
    body = (F.when(et == "view", F.to_json(sample)).when(et == "click", F.to_json(workout))
            .when(et == "signup", F.to_json(sleep)).when(et == "purchase", F.to_json(daily)).otherwise(F.to_json(delete)))
    rtype = (F.when(et == "view", F.lit("samples")).when(et == "click", F.lit("workouts"))
             .when(et == "signup", F.lit("sleep")).when(et == "purchase", F.lit("daily_summaries"))
             .otherwise(F.lit("deletes")))
    headers = F.struct(F.lit("application/x-ndjson").alias("content-type"), F.lit(HC_PLATFORM).alias("x-platform"),
                       rtype.alias("x-record-type"),
                       F.concat(F.lit("pixel-"), F.col("user_id").cast("string")).alias("x-device-id"))
    return e.select(F.concat(F.lit("a"), F.col("event_id").cast("string")).alias("record_id"),
                    (t + F.make_dt_interval(F.lit(0), (F.col("event_id") % 5).cast("int"))).alias("ingested_at"),
                    F.parse_json(body).alias("body"), F.parse_json(F.to_json(headers)).alias("headers"),
                    rtype.alias("record_type"), F.lit(HC_PLATFORM).alias("source_platform"),
                    F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("user_id"))
