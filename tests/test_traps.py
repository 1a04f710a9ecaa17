"""Traps T12, T13, T16, T20, T21 as literal rows."""

from __future__ import annotations

import datetime as dt

from conftest import cardio_by_outer_joins, make_bronze
from vitalake.operators import garmin, gold, ops, silver


def test_t12_null_user_split_in_join_form(spark):
    base = {"start_date": "2026-01-15T08:00:00Z", "end_date": "2026-01-15T08:00:00Z"}
    rows = [{"record_id": "a", "user_id": None, "record_type": "samples",
             "body": {**base, "uuid": "1", "type": "HKQuantityTypeIdentifierRestingHeartRate", "value": 55}},
            {"record_id": "b", "user_id": None, "record_type": "samples",
             "body": {**base, "uuid": "2", "type": "HKQuantityTypeIdentifierOxygenSaturation", "value": 0.97}}]
    s = silver.samples(make_bronze(spark, rows))
    assert gold.cardio_vitals_daily(s).count() == 1        # one-pass: one NULL-user row
    assert cardio_by_outer_joins(spark, s).count() == 2  # outer joins never match NULL keys


def test_t13_night_is_session_start_date(spark):
    body = {"start_date": "2026-01-15T00:30:00Z", "end_date": "2026-01-15T07:00:00Z",
            "stages": [{"uuid": "s", "stage": "asleepCore", "start_date": "2026-01-15T00:30:00Z",
                        "end_date": "2026-01-15T07:00:00Z"}]}
    n = gold.sleep_nightly(silver.sleep_stages(make_bronze(spark, [{"record_id": "r", "body": body,
                                                                     "record_type": "sleep"}]))).collect()[0]
    assert n.sleep_night == dt.date(2026, 1, 15)  # a 00:30 bedtime counts for the next date


def test_t16_activity_time_falls_back_to_ingested_at(spark):
    body = {"source": "garmin_connect", "device_id": "d", "date": "2026-04-15",
            "data": [{"activityId": 1, "activityType": {"typeKey": "run"}, "startTimeLocal": "not a time", "duration": 60}]}
    b = make_bronze(spark, [{"record_id": "g", "body": body, "record_type": "activities",
                             "ingested_at": "2026-04-16T07:00:00Z", "source_platform": None}])
    e = garmin.garmin_events(b).collect()[0]
    assert e.recorded_at == dt.datetime(2026, 4, 16, 7, 0)  # deterministic, not "now"


def test_t20_sleep_resend_new_event_but_stages_dedupe(spark):
    body = {"start_date": "2026-01-14T23:00:00Z", "end_date": "2026-01-15T06:00:00Z",
            "stages": [{"uuid": "s1", "stage": "asleepCore", "start_date": "2026-01-14T23:00:00Z",
                        "end_date": "2026-01-15T06:00:00Z"}]}
    b = make_bronze(spark, [{"record_id": "r1", "body": body, "record_type": "sleep", "ingested_at": "2026-01-15T07:00:00Z"},
                            {"record_id": "r2", "body": body, "record_type": "sleep", "ingested_at": "2026-01-15T08:00:00Z"}])
    assert silver.events(b).count() == 2        # no session uuid: each resend is a new event
    assert silver.sleep_stages(b).count() == 1  # stage uuids dedupe


def test_t21_sync_stats_success_only(spark):
    log = spark.createDataFrame([("samples", dt.datetime(2026, 1, 1, 8), 10, True),
                                 ("samples", dt.datetime(2026, 1, 1, 9), 5, False)],
                                "record_type string, timestamp timestamp, record_count int, success boolean")
    ok = ops.sync_stats_from_log(log, success_only=True).collect()[0]
    every = ops.sync_stats_from_log(log, success_only=False).collect()[0]
    assert (ok.records, ok.last_sync_at.hour) == (10, 8)
    assert (every.records, every.last_sync_at.hour) == (15, 9)
