"""Streaming dedup modes and late data (F16), batch = stream, and the
sessionisation rules (W2, X8)."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from vitalake.operators.sessions import session_windows, sleep_sessions


def _stream_dedup(spark, tmp_path, mode):
    src = tmp_path / f"src-{mode}"
    src.mkdir()
    files = [[("a", "2026-01-01 00:00:00"), ("b", "2026-01-01 01:00:00")],
             [("c", "2026-01-20 00:00:00")],
             [("a", "2026-01-01 00:00:00"), ("z", "2026-01-01 02:00:00"), ("d", "2026-01-20 02:00:00")]]
    schema = "id string, t timestamp"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    wm = stream.withWatermark("t", "48 hours")
    out = {"exact": wm.dropDuplicates(["id"]), "with_time": wm.dropDuplicates(["id", "t"]),
           "bounded": wm.dropDuplicatesWithinWatermark(["id"])}[mode]
    q = out.writeStream.format("memory").queryName(f"dedup_{mode}").outputMode("append") \
        .option("checkpointLocation", str(tmp_path / f"ck-{mode}")).start()
    for i, rows in enumerate(files):
        spark.createDataFrame([(a, dt.datetime.fromisoformat(b)) for a, b in rows], schema) \
            .coalesce(1).write.mode("append").parquet(str(src))
        q.processAllAvailable()
    q.processAllAvailable()  # one more batch so the advanced watermark evicts state
    state = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    ids = sorted(r.id for r in spark.sql(f"SELECT id FROM dedup_{mode}").collect())
    q.stop()
    return ids, state


def test_f16_dedup_modes_and_late_data(spark, tmp_path):
    exact = _stream_dedup(spark, tmp_path, "exact")
    with_time = _stream_dedup(spark, tmp_path, "with_time")
    bounded = _stream_dedup(spark, tmp_path, "bounded")
    for ids, _ in (exact, with_time, bounded):
        assert ids == ["a", "b", "c", "d"]  # z is 19 days late: dropped; a resent: dropped
    assert exact[1] == 4  # T4: dropDuplicates(id) never evicts
    assert with_time[1] == 2 and bounded[1] == 2


def test_backlog_in_many_batches_loses_no_row(spark, tmp_path):
    """30 days in one file a day, newest first, one file a micro-batch: the keys of the batch form."""
    from conftest import make_bronze
    from vitalake.operators import silver
    from vitalake.sources.bronze_store import read_bronze, write_bronze
    from vitalake.streaming import medallion as streaming

    path = str(tmp_path / "bronze")
    for day in range(30, 0, -1):
        rows = [{"record_id": f"r{day}-{k}", "record_type": "samples", "ingested_at": f"2026-01-{day:02d}T0{k}:00:00Z",
                 "body": {"uuid": f"s{day}" if k < 2 else f"s{day % 7}", "type": "x", "value": 1.0}} for k in range(3)]
        write_bronze(make_bronze(spark, rows).coalesce(1), path, "append")
    want = sorted(r.hk_uuid for r in silver.samples(read_bronze(spark, path)).select("hk_uuid").collect())
    assert want == sorted(f"s{k}" for k in range(31))
    for dedup in ("exact", "bounded"):
        root = streaming.run_available_now(spark, path, str(tmp_path / dedup), dedup, ("samples",), max_files_per_trigger=1)
        assert sorted(r.hk_uuid for r in streaming.read_sink(spark, root, "samples").collect()) == want


def test_silver_flows_have_no_size_switch():
    import inspect
    from vitalake.streaming import medallion as streaming

    for f in (streaming.run_available_now, streaming.start_silver_flows):
        assert inspect.signature(f).parameters["max_files_per_trigger"].default is None


def _single_window(df, gap=1800):
    w = Window.partitionBy("user_id").orderBy("start_at", "end_at", "uuid")
    prev = F.lag("end_at").over(w)
    flag = F.when(prev.isNull() | ((F.unix_seconds("start_at") - F.unix_seconds(prev)) > gap), 1).otherwise(0)
    d = df.withColumn("_f", flag).withColumn("session_seq", F.sum("_f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return d.groupBy("user_id", "session_seq").agg(F.min("start_at").alias("session_start_at"),
                                                    F.max("end_at").alias("session_end_at"),
                                                    F.count(F.lit(1)).alias("stage_count"))


def test_w2_bucketed_equals_single_window(spark):
    rnd = random.Random(7)
    rows = []
    for u in ("u1", "u2"):
        t = dt.datetime(2026, 1, 1, 22)
        for i in range(300):
            t += dt.timedelta(minutes=rnd.choice([0, 5, 29, 30, 31, 90, 600, 1500]))
            length = dt.timedelta(minutes=rnd.choice([1, 20, 45, 240]))
            rows.append((u, f"{u}-{i}", t, t + length))
    rows.append(("u1", "nested", dt.datetime(2026, 1, 1, 22, 1), dt.datetime(2026, 1, 1, 22, 2)))
    df = spark.createDataFrame(rows, "user_id string, uuid string, start_at timestamp, end_at timestamp")
    got = sorted(tuple(r) for r in sleep_sessions(df).collect())
    want = sorted(tuple(r) for r in _single_window(df).select("user_id", "session_seq", "session_start_at",
                                                              "session_end_at", "stage_count").collect())
    assert got == want
    assert len({r[1] for r in got if r[0] == "u1"}) > 10  # the fixture crosses many day buckets


def test_x8_session_window_matches_w2_without_nesting(spark):
    rows = [("u", "a", dt.datetime(2026, 1, 1, 23, 0), dt.datetime(2026, 1, 2, 1, 0)),
            ("u", "b", dt.datetime(2026, 1, 2, 1, 30), dt.datetime(2026, 1, 2, 3, 0)),   # gap exactly 30 min: merges
            ("u", "c", dt.datetime(2026, 1, 2, 3, 31), dt.datetime(2026, 1, 2, 4, 0))]   # 31 min: new session
    df = spark.createDataFrame(rows, "user_id string, uuid string, start_at timestamp, end_at timestamp")
    w2 = sorted((r.session_start_at, r.session_end_at, r.stage_count) for r in sleep_sessions(df).collect())
    x8 = sorted((r.session_start_at, r.session_end_at, r.stage_count) for r in session_windows(df).collect())
    assert w2 == x8 and len(w2) == 2


def test_w2_bucket_size_does_not_change_sessions(spark):
    from vitalake.operators.sessions import sessionize
    rnd = random.Random(11)
    rows, t = [], dt.datetime(2026, 1, 1)
    for i in range(400):  # one hot user
        t += dt.timedelta(seconds=rnd.choice([10, 600, 1799, 1800, 1801, 7200]))
        rows.append(("hot", f"h{i}", t, t + dt.timedelta(seconds=rnd.choice([5, 300, 3600]))))
    df = spark.createDataFrame(rows, "user_id string, uuid string, start_at timestamp, end_at timestamp")
    results = []
    for b, d in ((60, 1440), (3600, 24), (86400, 1), (60, 7), (7, 3)):
        results.append(sorted((r.uuid, r.session_seq, r.stage_no) for r in sessionize(df, bucket_seconds=b, buckets=d).collect()))
    assert all(r == results[0] for r in results)
    ordered, seen = sorted(rows, key=lambda r: (r[2], r[3], r[1])), {}
    want, last = [], None
    for _, uuid, start, end in ordered:
        seq = (1 if last is None else seq + ((start - last).total_seconds() > 1800))
        seen[seq] = seen.get(seq, 0) + 1
        want.append((uuid, seq, seen[seq]))
        last = end
    assert results[0] == sorted(want)
    assert max(r[1] for r in results[0]) > 5  # many sessions, most spanning several buckets


def test_w2_shuffles_stage_rows_once_and_keeps_null_users(spark):
    from vitalake.operators.sessions import session_documents, sessionize
    t = dt.datetime(2026, 1, 1)
    rows = [(u, f"{u}{k}", t + dt.timedelta(minutes=40 * k), t + dt.timedelta(minutes=40 * k + 15), f"s{k}") for u in ("a", None, "") for k in range(4)]
    df = spark.createDataFrame(rows, "user_id string, uuid string, start_at timestamp, end_at timestamp, sleep_stage string")
    plan = sessionize(df)._jdf.queryExecution().executedPlan().toString()
    carrying = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "_u" in x]
    assert len(carrying) >= 3
    assert all("coalesce" not in x and "isnull" not in x for x in carrying)
    docs = session_documents(df).collect()
    assert sorted((str(r.user_id), len(r.stages)) for r in docs) == sorted((str(u), 4) for u in ("a", None, ""))
    assert all([x.stage for x in r.stages] == ["s0", "s1", "s2", "s3"] for r in docs)
