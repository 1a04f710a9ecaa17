"""Literal-row tests of the silver and gold operators (fixtures F1-F5) and
the semantic traps they keep or fix on purpose."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from conftest import cardio_by_outer_joins, make_bronze
from vitalake.operators import gold, silver
from vitalake.plans.medallion import Medallion

F1 = {"uuid": "00000000-0000-4000-8000-000000000001", "type": "HKQuantityTypeIdentifierStepCount", "value": 8432,
      "unit": "count", "start_date": "2026-01-15T08:00:00Z", "end_date": "2026-01-15T08:30:00Z",
      "source_name": "com.apple.health", "source_bundle_id": "com.apple.Health"}
F2 = {"uuid": "00000000-0000-4000-8000-000000000002", "activity_type": "running", "activity_type_raw": 37,
      "start_date": "2026-01-15T06:30:00Z", "end_date": "2026-01-15T07:15:00Z", "duration_seconds": 2700,
      "total_energy_burned_kcal": 412, "total_distance_meters": 8420, "source_name": "Apple Watch"}
F3 = {"uuid": "00000000-0000-4000-8000-000000000003", "start_date": "2026-01-14T23:00:00Z",
      "end_date": "2026-01-15T06:30:00Z", "stages": [
          {"uuid": "s1", "stage": "asleepCore", "start_date": "2026-01-14T23:15:00Z", "end_date": "2026-01-15T01:00:00Z"},
          {"uuid": "s2", "stage": "asleepDeep", "start_date": "2026-01-15T01:00:00Z", "end_date": "2026-01-15T03:00:00Z"},
          {"uuid": "s3", "stage": "asleepREM", "start_date": "2026-01-15T03:00:00Z", "end_date": "2026-01-15T05:00:00Z"}]}
F4 = {"date": "2026-04-14", "active_energy_burned_kcal": 487, "active_energy_burned_goal_kcal": 500,
      "exercise_minutes": 28, "exercise_minutes_goal": 30, "stand_hours": 9, "stand_hours_goal": 12}
F5 = {"uuid": "A1B2C3D4-0001-0000-0000-000000000000", "sample_type": "HKQuantityTypeIdentifierHeartRate"}


def _bronze(spark):
    return make_bronze(spark, [
        {"record_id": "r1", "body": F1, "record_type": "samples"},
        {"record_id": "r2", "body": F2, "record_type": "workouts"},
        {"record_id": "r3", "body": F3, "record_type": "sleep"},
        {"record_id": "r4", "body": F4, "record_type": "activity_summaries"},
        {"record_id": "r5", "body": F5, "record_type": "deletes"},
    ])


def test_f1_sample_and_utc_parse(spark):
    s = silver.samples(_bronze(spark)).collect()
    assert len(s) == 1
    r = s[0]
    assert r.hk_uuid == F1["uuid"] and r.hk_type == F1["type"] and r.value == 8432.0
    # T3: 'Z' is UTC (session pinned to UTC), not the session's local zone
    assert r.start_at == dt.datetime(2026, 1, 15, 8, 0) and r.end_at == dt.datetime(2026, 1, 15, 8, 30)


def test_f2_weekly_workout(spark):
    w = gold.weekly_workout_summary(silver.workouts(_bronze(spark))).collect()[0]
    assert w.workout_count == 1 and w.total_duration_min == 45.0 and w.total_energy_kcal == 412
    assert w.total_distance_m == 8420 and abs(w.avg_speed_m_per_s - 8420 / 2700) < 1e-12
    assert w.distinct_activity_types == 1 and w.week_start == dt.datetime(2026, 1, 12)


def test_f3_sleep_nightly(spark):
    n = gold.sleep_nightly(silver.sleep_stages(_bronze(spark))).collect()[0]
    assert n.sleep_night == dt.date(2026, 1, 14)
    assert (n.core_sleep_min, n.deep_sleep_min, n.rem_sleep_min) == (105.0, 120.0, 120.0)
    assert (n.awake_min, n.in_bed_min, n.total_tracked_min, n.sleep_sessions) == (0.0, 0.0, 345.0, 1)


def test_f4_ring_ratios(spark):
    m = Medallion(_bronze(spark))
    r = m.activity_enriched.collect()[0]
    assert (r.move_ring_ratio, r.exercise_ring_ratio, r.stand_ring_ratio) == (0.974, 0.933, 0.75)
    assert r.total_steps is None  # T10: no steps that day


def test_f5_delete_and_t7_collision(spark):
    b = _bronze(spark)
    d = silver.deletes(b).collect()[0]
    assert (d.deleted_uuid, d.deleted_sample_type) == (F5["uuid"], F5["sample_type"])
    # A delete carrying the uuid of an earlier sample loses in the events table
    sample = {**F1, "uuid": "X"}
    b2 = make_bronze(spark, [
        {"record_id": "a", "ingested_at": "2026-01-16T00:00:00Z", "body": sample, "record_type": "samples"},
        {"record_id": "b", "ingested_at": "2026-01-16T01:00:00Z", "body": {"uuid": "X", "sample_type": "t"},
         "record_type": "deletes"}])
    ev = silver.events(b2).collect()
    assert [(e.event_id, e.record_type) for e in ev] == [("X", "samples")]


def test_t1_heart_rate_substring(spark):
    base = {"value": 50, "start_date": "2026-01-15T08:00:00Z", "end_date": "2026-01-15T08:00:00Z"}
    b = make_bronze(spark, [
        {"record_id": "h1", "body": {**base, "uuid": "1", "type": "HKQuantityTypeIdentifierHeartRate", "value": 60},
         "record_type": "samples"},
        {"record_id": "h2", "body": {**base, "uuid": "2", "type": "HKQuantityTypeIdentifierHeartRateVariabilitySDNN",
                                     "value": 40}, "record_type": "samples"}])
    s = silver.samples(b)
    ref = gold.cardio_vitals_daily(s).collect()[0]
    assert ref.heart_rate_avg == 50.0 and ref.hrv_sdnn_avg == 40.0  # HRV leaks into HR (reference)
    strict = gold.cardio_vitals_daily(s, strict=True).collect()[0]
    assert strict.heart_rate_avg == 60.0
    joined = cardio_by_outer_joins(spark, s).collect()[0]
    assert joined.heart_rate_avg == ref.heart_rate_avg and joined.heart_rate_max == ref.heart_rate_max


def test_t2_bad_text_is_null_not_failure(spark):
    b = make_bronze(spark, [{"record_id": "x", "record_type": "samples",
                             "body": {"uuid": "1", "type": "T", "value": "abc", "start_date": "not a date"}}])
    r = silver.samples(b).collect()[0]
    assert r.value is None and r.start_at is None


def test_t5_rings_key_and_t11_null_day(spark):
    day = {"record_type": "activity_summaries", "body": F4}
    b = make_bronze(spark, [{"record_id": "a", **day, "ingested_at": "2026-04-14T10:00:00Z"},
                            {"record_id": "b", **day, "ingested_at": "2026-04-14T11:00:00Z"}])
    assert silver.activity_rings(b).count() == 2  # reference keys on record_id
    latest = silver.activity_rings(b, natural_key=True).collect()
    assert [r.record_id for r in latest] == ["b"]
    nb = make_bronze(spark, [{"record_id": "n", "record_type": "samples",
                              "body": {"uuid": "1", "type": "HKQuantityTypeIdentifierStepCount", "value": 5}}])
    rows = gold.daily_steps(silver.samples(nb)).collect()
    assert rows[0].day is None and rows[0].total_steps == 5.0  # T11: NULL-day group kept


def test_t14_workout_value_is_duration_and_w5_first_arrival(spark):
    b = make_bronze(spark, [
        {"record_id": "late", "ingested_at": "2026-01-16T05:00:00Z", "body": F2, "record_type": "workouts"},
        {"record_id": "early", "ingested_at": "2026-01-16T01:00:00Z", "body": F2, "record_type": "workouts"}])
    ev = silver.events(b).collect()
    assert len(ev) == 1 and ev[0].record_id == "early" and ev[0].value_number == 2700.0
    assert silver.workouts(b).collect()[0].record_id == "early"


def test_sleep_stage_without_uuid_gets_sha(spark):
    body = {**F3, "stages": [{**F3["stages"][0], "uuid": None}]}
    st = silver.sleep_stages(make_bronze(spark, [{"record_id": "r9", "body": body, "record_type": "sleep"}])).collect()[0]
    import hashlib
    expect = hashlib.sha256(f"r9|asleepCore|{F3['stages'][0]['start_date']}".encode()).hexdigest()
    assert st.stage_uuid == expect


def test_views_and_labels(spark):
    from vitalake.functions.labels import display_label, hk_family, metric_short
    df = spark.createDataFrame([("HKQuantityTypeIdentifierHeartRateVariabilitySDNN",),
                                ("HKCategoryTypeIdentifierSleepAnalysis",), ("",)], "hk_type string")
    out = df.select(metric_short().alias("s"), display_label().alias("l"), hk_family().alias("f")).collect()
    assert out[0].s == "HeartRateVariabilitySDNN" and out[0].f == "heart_rate"
    assert out[0].l == "Heart Rate Variability S D N N"
    assert out[1].l == "Sleep Analysis" and out[1].f == "other"
    assert out[2].l == ""


def test_sleep_last_nights_window(spark):
    rows = [("u1", dt.date(2026, 1, d)) for d in range(1, 11)]
    df = spark.createDataFrame(rows, "user_id string, sleep_night date")
    out = gold.sleep_last_nights(df, 3).collect()
    assert sorted(r.sleep_night.day for r in out) == [8, 9, 10]
