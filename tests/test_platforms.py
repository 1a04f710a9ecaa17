"""Health Connect, Garmin cloud and watch normalisers on literal rows
(fixtures F6-F10)."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from conftest import make_bronze
from vitalake.functions.dims import HC_EXERCISE_NAMES, code_dim, lookup_name
from vitalake.operators import garmin, health_connect as hc

HC = "android_health_connect"


def test_f6_hc_sample_and_f8_heart_rate_flatten(spark):
    f6 = {"id": "test-003", "type": "StepsRecord", "value": 500.0, "unit": "steps", "start_time": "2026-04-16T08:00:00Z",
          "end_time": "2026-04-16T09:00:00Z", "data_origin": "com.google.fitness", "last_modified_time": "2026-04-16T09:00:00Z"}
    hr = {"id": "hr-1", "type": "HeartRateRecord", "start_time": "2026-04-16T08:00:00Z", "end_time": "2026-04-16T08:02:00Z",
          "samples": [{"time": "2026-04-16T08:00:00Z", "beats_per_minute": 61},
                      {"time": "2026-04-16T08:01:00Z", "beats_per_minute": 63}], "data_origin": "x"}
    unknown = {"id": "n-1", "type": "NutritionRecord", "value": 1.0, "start_time": "2026-04-16T08:00:00Z"}
    b = make_bronze(spark, [{"record_id": f"a{i}", "body": x, "record_type": "samples", "source_platform": HC}
                            for i, x in enumerate([f6, hr, unknown])])
    rows = {r.hk_uuid: r for r in hc.hc_samples(spark, b).collect()}
    assert set(rows) == {"test-003", "hr-1-0", "hr-1-1"}  # P12 skips unknown classes
    assert rows["test-003"].hk_unit == "steps" and rows["test-003"].value == 500.0
    assert rows["hr-1-1"].value == 63.0 and rows["hr-1-1"].start_at == rows["hr-1-1"].end_at == dt.datetime(2026, 4, 16, 8, 1)
    assert rows["hr-1-0"].hk_unit == "bpm"


def test_f8_exercise_codes(spark):
    codes = spark.createDataFrame([(56,), (8,), (73,), (80,), (35,), (9999,)], "c bigint")
    out = lookup_name(codes, code_dim(spark, HC_EXERCISE_NAMES), "c", "name").orderBy("c").collect()
    got = {r.c: r.name for r in out}
    assert got == {56: "running", 8: "biking", 73: "swimming_pool", 80: "yoga", 35: "hiking", 9999: "unknown_9999"}


def test_f8_hc_workout_duration_and_sleep_names(spark):
    w = {"id": "w1", "exercise_type_code": 56, "start_time": "2026-04-16T08:00:00Z", "end_time": "2026-04-16T08:30:00.500Z",
         "data_origin": "x"}
    s = {"id": "s1", "start_time": "2026-04-15T22:30:00Z", "end_time": "2026-04-16T00:45:00Z", "duration_seconds": 8100.0,
         "stages": [{"stage_code": 4, "start_time": "2026-04-15T22:30:00Z", "end_time": "2026-04-15T23:15:00Z"},
                    {"stage": "deep", "stage_code": 5, "start_time": "2026-04-15T23:15:00Z", "end_time": "2026-04-16T00:00:00Z"},
                    {"stage_code": 42, "start_time": "2026-04-16T00:00:00Z", "end_time": "2026-04-16T00:45:00Z"}]}
    b = make_bronze(spark, [{"record_id": "a", "body": w, "record_type": "workouts", "source_platform": HC},
                            {"record_id": "b", "body": s, "record_type": "sleep", "source_platform": HC}])
    wo = hc.hc_workouts(spark, b).collect()[0]
    assert wo.activity_type == "running" and wo.duration_seconds == 1800.5  # P19 from the times
    stages = sorted(r.sleep_stage for r in hc.hc_sleep_stages(spark, b).collect())
    assert stages == ["deep", "light", "unknown_42"]


def test_f7_daily_summary_and_r28(spark):
    f7 = {"date": "2026-04-16", "timezone": "America/Los_Angeles", "total_steps": 8472,
          "active_calories_burned_kcal": 312.5, "total_distance_meters": 6240.0, "exercise_duration_minutes": 35.2}
    b = make_bronze(spark, [{"record_id": "d", "body": f7, "record_type": "daily_summaries", "source_platform": HC}])
    r = hc.hc_daily_summaries(b).collect()[0]
    assert (r.summary_date, r.total_steps, r.active_calories_burned_kcal) == (dt.date(2026, 4, 16), 8472, 312.5)
    samples = spark.createDataFrame([
        ("u", "StepsRecord", 100.0, dt.datetime(2026, 4, 16, 3, 0), "-08:00"),  # local day 04-15
        ("u", "StepsRecord", 50.0, dt.datetime(2026, 4, 18, 12, 0), "-08:00"),
        ("u", "DistanceRecord", 7.0, dt.datetime(2026, 4, 18, 12, 0), "-08:00")],
        "user_id string, hk_type string, value double, start_at timestamp, zone_offset string")
    out = {r.day: r for r in hc.daily_summary_from_samples(samples).collect()}
    assert sorted(out) == [dt.date(2026, 4, 15), dt.date(2026, 4, 16), dt.date(2026, 4, 17), dt.date(2026, 4, 18)]
    assert out[dt.date(2026, 4, 16)].total_steps == 0.0  # zero-filled gap day
    assert out[dt.date(2026, 4, 18)].total_distance_meters == 7.0


def _garmin(spark, record_type, data, date="2026-04-15"):
    body = {"source": "garmin_connect", "device_id": "dev", "date": date, "data": data}
    return make_bronze(spark, [{"record_id": "g", "body": body, "record_type": record_type, "source_platform": None,
                                "user_id": None, "headers": {"X-Platform": "garmin_connect"}}])


def _events(spark, rt, data):
    return [(r.metric_type, r.value, r.unit, r.recorded_at, r.metadata)
            for r in garmin.garmin_events(_garmin(spark, rt, data)).orderBy("metric_type", "recorded_at").collect()]


def test_f9_garmin_edge_cases(spark):
    day = dt.datetime(2026, 4, 15)
    stats = _events(spark, "daily_stats", {"restingHeartRate": 52, "totalSteps": "bad", "moderateIntensityMinutes": 0,
                                           "vigorousIntensityMinutes": 0})
    assert ("heart_rate_resting", 52.0, "bpm", day, None) in stats
    assert ("steps_daily", 0.0, "count", day, None) in stats  # T15: bad text -> 0.0
    assert not any(m == "intensity_minutes" for m, *_ in stats)  # both 0 -> none
    mv = _events(spark, "daily_stats", {"moderateIntensityMinutes": 10.7, "vigorousIntensityMinutes": 0})
    assert mv == [("intensity_minutes", 10.7, "minutes", day, {"moderate": "10", "vigorous": "0"})]
    hr = _events(spark, "heart_rates", {"heartRateValues": [[1776211200000, 60], [1776211260000, 0],
                                                            [1776211320000, None], [1776211380000]]})
    assert [(m, v) for m, v, *_ in hr] == [("heart_rate_intraday", 60.0)]
    stress = _events(spark, "stress", {"stressValuesArray": [[1776211200000, -1], [1776211260000, 25]]})
    assert [(m, v) for m, v, *_ in stress] == [("stress_level", 25.0)]
    hrv = _events(spark, "hrv", {"hrvSummary": {"status": "poor", "weeklyAvg": 41}})
    assert ("hrv_status", -1.0, "score", day, {"status_label": "poor"}) in hrv
    spo2 = _events(spark, "spo2", {"averageSpO2": 0, "averageSpO2Value": 96})
    assert spo2 == [("spo2", 96.0, "pct", day, None)]
    bb_list = _events(spark, "body_battery", [[1, 80], [2, 0], [3, 35], [4, None], {"x": 1}])
    assert [(m, v) for m, v, *_ in bb_list] == [("body_battery_high", 80.0), ("body_battery_low", 35.0)]
    bb_obj = _events(spark, "body_battery", {"bodyBatteryHighestValue": 90, "bodyBatteryLowestValue": 12})
    assert [(m, v) for m, v, *_ in bb_obj] == [("body_battery_high", 90.0), ("body_battery_low", 12.0)]
    assert _events(spark, "steps", [{"steps": 10}]) == []  # no normaliser (T17)
    acts = _events(spark, "activities", [{"activityId": 7, "activityType": {"typeKey": "running"}, "activityName": "Run",
                                          "startTimeGMT": "2026-04-15T07:00:00Z", "duration": 600, "maxHR": None}])
    assert acts == [("workout_duration", 600.0, "seconds", dt.datetime(2026, 4, 15, 7, 0),
                     {"activity_type": "running", "activity_name": "Run", "activity_id": "7"})]


def test_s10_garmin_to_bronze(spark):
    raw = spark.createDataFrame([("e1", "dev", "2026-04-15", dt.datetime(2026, 4, 16, 7), json.dumps({"totalSteps": 5}),
                                  json.dumps({"dailySleepDTO": {}}))],
                                "extract_id string, device_id string, date string, ingested_at timestamp, s string, sl string")
    cols = [F.lit(None).cast("variant").alias(k) for k, _ in garmin.GARMIN_CATEGORIES if k not in ("stats", "sleep")]
    raw = raw.select("extract_id", "device_id", "date", "ingested_at", F.parse_json("s").alias("stats"),
                     F.parse_json("sl").alias("sleep"), *cols)
    b = garmin.garmin_to_bronze(raw).collect()
    assert sorted(r.record_type for r in b) == ["daily_stats", "sleep"]
    assert all(r.user_id is None and r.source_platform is None for r in b)


def test_f10_watch_batch_drops_stress_sentinel(spark):
    body = {"device_id": "w", "source": "garmin_connect_iq", "upload_timestamp": "2026-04-15T08:00:00Z", "records": [
        {"metric_type": "stress_level", "value": 127, "unit": "score", "recorded_at": "2026-04-15T08:00:00Z",
         "device_id": "w", "source": "garmin_connect_iq"},
        {"metric_type": "stress_level", "value": 30, "unit": "score", "recorded_at": "2026-04-15T08:01:00Z",
         "device_id": "w", "source": "garmin_connect_iq"},
        {"metric_type": "heart_rate_intraday", "value": 61, "unit": "bpm", "recorded_at": "2026-04-15T08:02:00Z",
         "device_id": "w", "source": "garmin_connect_iq"}]}
    b = make_bronze(spark, [{"record_id": "w1", "body": body, "record_type": "samples", "source_platform": None}])
    ev = garmin.explode_watch_batch(b)
    assert sorted((r.metric_type, r.value) for r in ev.collect()) == [("heart_rate_intraday", 61.0), ("stress_level", 30.0)]
    inc = garmin.incremental_since(ev, "2026-04-15T08:01:30Z", cap=60).collect()
    assert [(r.metric_type, r.value) for r in inc] == [("heart_rate_intraday", 61.0)]
