"""NULL and hot keys, session rules, and the stored layers."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import make_bronze
from vitalake import session
from vitalake.functions.labels import SEED_DEVICE_ID
from vitalake.operators import deletes, sessions
from vitalake.plans import registry
from vitalake.sources import bronze_store

SF = "/root/testdata/sf0.001"


def _sessions_by_hand(rows, gap=1800):
    out = []
    users = {u for u, *_ in rows}
    for u in users:
        prev, seq = None, 0
        for _, a, b, k in sorted((r for r in rows if r[0] == u), key=lambda r: r[1:]):
            seq += prev is None or (a - prev).total_seconds() > gap
            prev = b
            out.append((u, k, seq))
    return sorted(out, key=repr)


def test_w2_null_user_and_a_user_with_a_third_of_the_rows(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [(u, t + dt.timedelta(minutes=m * step), t + dt.timedelta(minutes=m * step + 5), f"{u}-{m}")
            for u, n, step in ((None, 40, 17), ("anonymous", 90, 3), ("a", 40, 41), ("b", 30, 36)) for m in range(n)]
    df = spark.createDataFrame(rows, "user_id string, start_at timestamp, end_at timestamp, uuid string")
    for bucket in (60, 3600):
        got = sessions.sessionize(df, bucket_seconds=bucket).collect()
        assert sorted(((r.user_id, r.uuid, r.session_seq) for r in got), key=repr) == _sessions_by_hand(rows)
    assert sessions.sleep_sessions(df).filter("user_id IS NULL").agg(F.sum("stage_count")).first()[0] == 40


def test_j5_both_header_cases_and_rows_that_cannot_match(spark):
    rows = [{"record_id": "a", "body": {}, "headers": {"x-device-id": "d1"}, "user_id": "u1", "record_type": "samples"},
            {"record_id": "b", "body": {}, "headers": {"X-Device-Id": "d1"}, "user_id": None, "record_type": "samples"},
            {"record_id": "c", "body": {}, "headers": {}, "user_id": "u3", "record_type": "samples"},
            {"record_id": "d", "body": {}, "headers": {"x-device-id": SEED_DEVICE_ID}, "user_id": "seed", "record_type": "samples"}]
    rows = [r if r["user_id"] else {**r, "user_id": None} for r in rows]
    b = make_bronze(spark, rows)
    out = deletes.attribute_user_by_device(b, deletes.device_registry(b, SEED_DEVICE_ID), SEED_DEVICE_ID)
    assert {r.record_id: r.resolved_user_id for r in out.collect()} == {"a": "u1", "b": "u1", "c": "u3", "d": "seed"}


class _Cluster:
    """A session whose master is a cluster and whose checkpoint folder is not named."""

    class conf:
        get = staticmethod(lambda key, default=None: None)

    class sparkContext:
        master = "spark://head:7077"
        getCheckpointDir = staticmethod(lambda: None)


def test_a_cluster_must_name_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(_Cluster)


def test_local_session_keeps_a_given_number_of_partitions(spark):
    assert session.get_spark(shuffle_partitions=4).conf.get("spark.sql.shuffle.partitions") == "4"
    assert spark.conf.get(session.STATE_STORE_CONF) == session.ROCKSDB


def test_tiles_read_one_stored_table_with_the_window_in_the_scan(spark):
    for name in ("vw_activity_45d", "app_steps_leaderboard"):
        plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "day" in plan.split("PushedFilters")[1].split("]")[0]
    assert "record_type" not in registry.queries()["dash_06_silver_gold_volumes"](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_stored_layers_equal_the_lazy_ones(spark):
    stored, lazy = registry.stored(spark, SF), registry.medallion(spark, SF)
    for name in ("daily_steps", "sleep_nightly", "ingest_daily"):
        a, b = getattr(stored, name), getattr(lazy, name)
        assert a.schema.names == b.schema.names
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_windows_cut_rows(spark):
    whole = {"vw_activity_45d": "activity_enriched", "dash_02_hk_quantity_30d": "hk_quantity_daily", "dash_05_ring_adherence": "rings",
             "dash_10_activity_60d": "activity_enriched", "dash_11_sleep_90d": "sleep_nightly", "dash_12_ingest_by_type_90d": "ingest_daily",
             "vw_workouts_12w": "weekly_workouts"}
    m = registry.stored(spark, SF)
    for name, table in whole.items():
        assert 0 < registry.queries()[name](spark, SF).count() < getattr(m, table).count(), name


def test_bronze_files_follow_the_data(spark, tmp_path):
    b = registry.medallion(spark, SF).bronze
    plan = bronze_store.spread(spark, b)._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE" in plan
