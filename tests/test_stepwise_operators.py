"""X7, X8, S11 and P31 worked off in steps: any split gives the batch result, replays and crashes change nothing."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from vitalake.operators.garmin import incremental_since
from vitalake.operators.marks import Deliveries
from vitalake.operators.sessions import sleep_sessions
from vitalake.sources.backfill import Backfill, day_range
from vitalake.sources.snapshots import SnapshotTable
from vitalake.streaming.late_rows import LateGate
from vitalake.streaming.open_sessions import OpenSessions

T0 = dt.datetime(2026, 1, 1)
ROW = "record_id string, key string, ingested_at timestamp"


def _rows(spark, rows):
    return spark.createDataFrame([(r, k, None if h is None else T0 + dt.timedelta(hours=h)) for r, k, h in rows], ROW)


def _gate(spark, path):
    return LateGate(spark, str(path), _parse_datatype_string(ROW), "key", 36 * 3600)


def test_x7_landed_is_kept_duplicates_and_late(spark, tmp_path):
    gate = _gate(spark, tmp_path / "g")
    first = [("a1", "a", 0), ("a2", "a", 1), ("b1", "b", 10), ("n1", "n", None)]
    assert gate.take(_rows(spark, first), 0) == {"landed": 4, "kept": 3, "late": 0, "duplicates": 1}
    second = [("a3", "a", 5), ("c1", "c", 60)]  # a again, inside the watermark of the first batch (10 h - 36 h)
    assert gate.take(_rows(spark, second), 1) == {"landed": 2, "kept": 1, "late": 0, "duplicates": 1}
    third = [("d1", "d", 23), ("d2", "d", 24), ("b2", "b", 61), ("c2", "c", 62), ("n2", "n", None)]  # the watermark is at 24 h now
    assert gate.take(_rows(spark, third), 2) == {"landed": 5, "kept": 3, "late": 1, "duplicates": 1}
    assert gate.take(_rows(spark, third), 2) == {}  # replayed
    assert sorted(r.record_id for r in gate.rows("late").collect()) == ["d1"]
    assert sorted(r.record_id for r in gate.rows().collect()) == ["a1", "b1", "b2", "c1", "d2", "n1", "n2"]
    total = gate.totals()
    assert total == {"landed": 11, "kept": 7, "late": 1, "duplicates": 3}
    assert gate.take(_rows(spark, []), 3) == {"landed": 0, "kept": 0, "late": 0, "duplicates": 0}


def test_x7_as_a_stream_whose_watermark_moves(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rng = random.Random(4)
    batches = [[(f"{b}-{k}", f"k{rng.randrange(30)}", 40 * b + rng.randrange(-90, 40)) for k in range(25)] for b in range(4)]
    for b in batches:
        _rows(spark, b).coalesce(1).write.mode("append").parquet(str(src))
    gate = _gate(spark, tmp_path / "g")
    stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(str(src))
    gate.follow(stream, str(tmp_path / "ck")).awaitTermination()
    kept, late, high = {}, [], None
    for b in batches:
        mark = None if high is None else high - 36
        fine = [r for r in b if mark is None or r[2] >= mark]
        late += [r[0] for r in b if mark is not None and r[2] < mark]
        for r, k, h in sorted(fine, key=lambda r: (r[2], r[0])):
            if not any(kk == k and (mark is None or hh >= mark) for kk, hh in kept.values()):
                kept[r] = (k, h)
        high = max([r[2] for r in b] + ([high] if high is not None else []))
    assert late and sorted(r.record_id for r in gate.rows("late").collect()) == sorted(late)
    assert sorted(r.record_id for r in gate.rows().collect()) == sorted(kept)
    assert gate.totals()["landed"] == 100


STAGE = "user_id string, stage_uuid string, stage_start_at timestamp, stage_end_at timestamp, ingested_at timestamp"


def _stages(seed, n=160):
    rng = random.Random(seed)
    rows = []
    for u in ("a", None, "b"):
        t = T0
        for k in range(n):
            t += dt.timedelta(minutes=rng.choice([1, 5, 29, 30, 31, 45, 200]))
            rows.append((u, f"{u}{k}", t, t + dt.timedelta(minutes=rng.choice([1, 10, 30, 120])), t))
    return rows


@pytest.mark.parametrize("parts", [1, 3, 6])
def test_x8_any_split_equals_the_batch_sessions(spark, tmp_path, parts):
    rows = _stages(parts)
    rows.append(("a", "nested", T0 + dt.timedelta(minutes=40), T0 + dt.timedelta(minutes=41), T0))
    rng = random.Random(9)
    arrival = lambda r: r[2] + dt.timedelta(hours=rng.random() * 5)  # noqa: E731  # up to five hours late and out of order
    ordered = [r for _, _, r in sorted((arrival(r), r[1], r) for r in rows for _ in range(1 + (rng.random() < 0.1)))] if parts > 1 else rows
    state = OpenSessions(spark, str(tmp_path / "s"), delay_seconds=6 * 3600)
    size = -(-len(ordered) // parts)
    for k in range(parts):
        batch = spark.createDataFrame(ordered[k * size:(k + 1) * size], STAGE)
        state.take(batch, k)
        state.take(batch, k)  # replayed
    names = ["user_id", "session_seq", "session_start_at", "session_end_at", "stage_count"]
    want = sleep_sessions(spark.createDataFrame(rows, STAGE), start="stage_start_at", end="stage_end_at", tie="stage_uuid")
    got = sorted((tuple(r) for r in state.sessions().select(*names).collect()), key=repr)
    assert got == sorted((tuple(r) for r in want.select(*names).collect()), key=repr)
    held = state.table.read()
    assert held.filter("_part_of = 'late'").count() == 0
    if parts > 1:
        assert held.filter("_part_of = 'closed'").count() > 20  # most sessions are closed; few rows stay open
        assert held.filter("_part_of = 'open'").count() < len(rows) / 2


def test_x8_rows_behind_the_watermark_are_set_aside(spark, tmp_path):
    state = OpenSessions(spark, str(tmp_path / "s"), delay_seconds=3600)
    hour = lambda h: T0 + dt.timedelta(hours=h)
    state.take(spark.createDataFrame([("u", "x", hour(0), hour(1), hour(1)), ("u", "y", hour(9), hour(10), hour(10))], STAGE), 0)
    state.take(spark.createDataFrame([("u", "z", hour(1), hour(2), hour(11)), ("u", "w", hour(10), hour(11), hour(11)), ("u", None, None, None, None)], STAGE), 1)
    assert [r.stage_uuid for r in state.table.read().filter("_part_of = 'late'").collect()] == ["z"]
    assert sorted((r.session_seq, r.stage_count) for r in state.sessions().collect()) == [(1, 1), (2, 2)]


def test_x8_a_batch_is_numbered_once_by_tasks_that_follow_its_rows(spark, tmp_path):
    state, sc, before = OpenSessions(spark, str(tmp_path / "s"), delay_seconds=6 * 3600), spark.sparkContext, spark.conf.get("spark.sql.shuffle.partitions")
    batch = spark.createDataFrame(_stages(3), STAGE).coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    sc.setJobGroup("x8-tasks", "one batch")
    try:
        state.take(batch, 0)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", before)
    stages = {s for j in sc.statusTracker().getJobIdsForGroup("x8-tasks") for s in sc.statusTracker().getJobInfo(j).stageIds}
    done = [i for i in map(sc.statusTracker().getStageInfo, stages) if i is not None]
    assert sum(i.numCompletedTasks for i in done) < 200  # no stage has a task per shuffle partition
    assert not list((tmp_path / "s" / "work").iterdir())
    assert state.table.read().filter("_part_of = 'closed'").count() > 20


def test_x8_a_row_that_starts_with_the_last_closed_one_stays_open(spark, tmp_path):
    state = OpenSessions(spark, str(tmp_path / "s"), delay_seconds=3600)
    hour = lambda h: T0 + dt.timedelta(hours=h)
    # "x" ends before it starts, so "y", with the same start, opens a session of its own
    rows = [("u", "x", hour(3), hour(1), hour(3)), ("u", "y", hour(3), hour(9), hour(3)), ("u", "z", hour(8), hour(10), hour(8))]
    state.take(spark.createDataFrame(rows, STAGE), 0)
    want = sleep_sessions(spark.createDataFrame(rows, STAGE), start="stage_start_at", end="stage_end_at", tie="stage_uuid")
    assert sorted((r.session_seq, r.stage_count) for r in state.sessions().collect()) == sorted((r.session_seq, r.stage_count) for r in want.collect()) == [(1, 1), (2, 2)]


def test_s11_failed_days_are_reported_and_retried_alone(spark, tmp_path):
    asked = []
    data = spark.createDataFrame([(dt.date(2026, 1, d), f"{d}-{k}") for d in range(1, 8) if d != 3 for k in range(d)], "day date, id string")

    def extract(broken):
        def run(days):
            asked.append(sorted(r.day.day for r in days.collect()))
            return data.join(days, "day").withColumn("error", F.when(F.dayofmonth("day").isin(broken) & F.col("id").endswith("-1"), F.lit("timeout")))
        return run

    job = Backfill(spark, str(tmp_path / "b"), data.schema, max_attempts=3)
    first = {r.day.day: (r.status, r.attempts, r.rows, r.error) for r in job.run("2026-01-01", "2026-01-08", extract([2, 5])).collect()}
    assert first[2] == ("failed", 1, 0, "timeout") and first[3] == ("landed", 1, 0, None) and first[7] == ("landed", 1, 7, None)
    assert job.sink.read().count() == 1 + 4 + 6 + 7
    second = {r.day.day: r.status for r in job.run("2026-01-01", "2026-01-08", extract([5])).collect()}
    assert second == {2: "landed", 5: "failed"}
    job.run("2026-01-04", "2026-01-08", extract([5]))
    assert job.run("2026-01-01", "2026-01-08", extract([])).count() == 0  # day 5 has no attempt left
    assert asked == [[1, 2, 3, 4, 5, 6, 7], [2, 5], [5]]
    assert {r.day.day: r.attempts for r in job.ledger.read().collect()} == {1: 1, 2: 2, 3: 1, 4: 1, 5: 3, 6: 1, 7: 1}
    with pytest.raises(ValueError):
        day_range(spark, "2026-01-02", "2026-01-02")


def test_s11_a_run_that_dies_between_its_commits_is_repeated(spark, tmp_path, monkeypatch):
    data = spark.createDataFrame([(dt.date(2026, 1, d), f"{d}") for d in (1, 2)], "day date, id string")
    extract = lambda days: data.join(days, "day").withColumn("error", F.lit(None).cast("string"))
    job = Backfill(spark, str(tmp_path / "b"), data.schema)
    real = SnapshotTable.commit
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "commit", lambda self, *a, **k: real(self, *a, **k) if self.root.endswith("rows") else (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            job.run("2026-01-01", "2026-01-03", extract)
    assert job.ledger.read().count() == 0 and job.sink.read().count() == 2
    assert {r.status for r in job.run("2026-01-01", "2026-01-03", extract).collect()} == {"landed"}
    assert job.sink.read().count() == 2  # landed once, not twice


EVENT = "device_id string, metric_type string, value double, recorded_at timestamp"


def test_p31_each_sample_is_delivered_once(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    rows = [(rng.choice(["d1", "d2", None]), rng.choice(["hr", "steps"]), float(k), T0 + dt.timedelta(minutes=rng.randrange(400))) for k in range(120)]
    rows.append(("d1", "hr", -1.0, None))
    whole = spark.createDataFrame(rows, EVENT)
    out = Deliveries(spark, str(tmp_path / "d"), whole.schema)
    for cut in (100, 100, 250, 400):
        seen = whole.filter(F.col("recorded_at").isNull() | (F.col("recorded_at") <= F.lit(T0 + dt.timedelta(minutes=cut))))
        if cut == 250:
            with monkeypatch.context() as m:  # the delivery dies before its commit: no mark has moved
                m.setattr(SnapshotTable, "_publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    out.deliver(seen)
        out.deliver(seen)
    assert sorted(r.value for r in out.delivered().collect()) == sorted(float(r[2]) for r in rows if r[3])
    assert out.fresh(whole).count() == 0
    marks = {(r.device_id, r.metric_type): r.since for r in out.marks().collect()}
    assert marks[(None, "hr")] == max(r[3] for r in rows if r[:2] == (None, "hr") and r[3])
    later = spark.createDataFrame([("d1", "hr", 5.0, T0 + dt.timedelta(days=2)), ("d1", "hr", 6.0, T0)], EVENT)
    assert [r.value for r in incremental_since(out.fresh(later), "2026-01-01 00:00:00").collect()] == [5.0]


def test_p3_the_cast_reads_instants_before_the_pattern(spark):
    from vitalake.functions.variant import ISO_INSTANT, parse_ts
    texts = ["2024-01-15T10:20:30Z", "2024-01-15T10:20:30.123Z", "2024-01-15T10:20:30.123456+05:30", "2024-01-15T10:20:30-08:00", "2024-01-15T10:20:30.5Z",
             "2024-01-15", "2024-01-15 10:20:30", "2024-02-30T00:00:00Z", "2024-01-15T24:00:00Z", "2024-01-15T10:20Z", "0001-01-01T00:00:00Z", "9999-12-31T23:59:59Z",
             "12024-01-15T10:20:30Z", "2024-01-15T10:20:30+19:00", "2024-01-15T10:20:30-00:00", "2024-01-15T10:20:30+18:00", " 2024-01-15T10:20:30Z ", "", "x", None,
             "2024-01-15T10:20:30.1234567Z", "2024-01-15T10:20:30+0530", "2024-01-15T10:20:30+05", "2024-1-5T1:2:3Z", "10:20:30", "2024-01-15t10:20:30z", "1700000000"]
    rows = spark.createDataFrame([(t,) for t in texts], "c string")
    pattern_first = F.coalesce(F.try_to_timestamp("c", F.lit(ISO_INSTANT)), F.try_to_timestamp("c"))
    got = rows.select("c", F.unix_micros(parse_ts("c")).alias("a"), F.unix_micros(pattern_first).alias("b")).collect()
    assert [(r.c, r.a) for r in got] == [(r.c, r.b) for r in got] and sum(r.a is not None for r in got) > 8
    plan = rows.select(parse_ts("c").alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(c" in plan.split("gettimestamp")[0]  # the formatter comes second


def test_p31_the_buffer_is_taken_apart_once(spark, monkeypatch):
    from vitalake.operators import garmin
    from vitalake.plans import state_queries
    plans, plain = [], Deliveries.fresh

    def watched(self, events, version=None):
        plans.append(events._jdf.queryExecution().optimizedPlan().toString())
        return plain(self, events, version)

    monkeypatch.setattr(Deliveries, "fresh", watched)
    out = state_queries.watch_delivered(spark, "/root/testdata/sf0.001")
    want = garmin.explode_watch_batch(state_queries.landed_bronze(spark, "/root/testdata/sf0.001", "watch"))
    assert out.count() == want.filter("recorded_at IS NOT NULL").count() and len(plans) == 4
    assert not any("variant_get" in p or "Generate" in p for p in plans)
