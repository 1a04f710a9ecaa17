"""S9, X6 and X4 on versioned tables: crashes at each step, conflicts, replays, expired tokens."""

from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from conftest import make_bronze
from vitalake.operators import gold, silver
from vitalake.plans.incremental import ROLLUPS, IncrementalGold
from vitalake.schemas import BRONZE
from vitalake.sources.snapshots import CommitConflict, SnapshotTable, replace_where
from vitalake.streaming.change_feed import KeyedState

T0 = dt.datetime(2026, 1, 1)


def _table(spark, path) -> SnapshotTable:
    schema = _parse_datatype_string("id long, kind string, user string")
    assert isinstance(schema, StructType)
    return SnapshotTable(spark, str(path), "kind", schema)


def _rows(spark, rows):
    return spark.createDataFrame(rows, "id long, kind string, user string")


def _ids(table, version=None):
    return sorted(r.id for r in table.read(version).collect())


def _seeded(spark, path):
    table = _table(spark, path)
    table.append(_rows(spark, [(1, "a", "u"), (2, "a", "v"), (3, "b/=%", "u"), (4, None, "v"), (5, "", "u"), (6, "c", "v")]))
    return table


def test_s9_replaces_rows_in_one_version(spark, tmp_path):
    table = _seeded(spark, tmp_path / "t")
    before = set(table.folders())
    removed = replace_where(table, F.col("user") == "u", _rows(spark, [(10, "a", "u"), (11, "d", "w")]))
    assert removed == 3 and table.version() == 2
    assert _ids(table) == [2, 4, 6, 10, 11]
    assert _ids(table, 1) == [1, 2, 3, 4, 5, 6]  # a reader of the old version is not disturbed
    assert len(before & set(table.folders())) == 1  # "c" has no matching row: its files stay
    assert _ids(_table(spark, tmp_path / "t")) == _ids(table)
    assert sorted(r.id for r in table.read(parts=["a", "zz"]).collect()) == [2, 10]
    assert replace_where(table, F.col("user") == "nobody", _rows(spark, [])) == 0 and table.version() == 2
    assert replace_where(table, F.lit(True), _rows(spark, [])) == 5 and _ids(table) == []
    table.append(_rows(spark, [(20, "a", None)]))
    assert _ids(table) == [20]


@pytest.mark.parametrize("step", ["write", "commit", "_publish"])
def test_s9_a_writer_that_dies_leaves_the_old_rows(spark, tmp_path, monkeypatch, step):
    table = _seeded(spark, tmp_path / "t")

    def die(self, *a, **k):
        if step == "write":  # dies with a part of the data on disk
            type(self).write_whole(self, a[0].limit(1))
        raise KeyboardInterrupt

    monkeypatch.setattr(SnapshotTable, "write_whole", SnapshotTable.write, raising=False)
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, step, die)
        with pytest.raises(KeyboardInterrupt):
            replace_where(table, F.col("user") == "u", _rows(spark, [(10, "a", "u")]))
    assert table.version() == 1 and _ids(table) == [1, 2, 3, 4, 5, 6]
    assert replace_where(table, F.col("user") == "u", _rows(spark, [(10, "a", "u")])) == 3  # the next writer is not in its way
    assert _ids(table) == [2, 4, 6, 10]
    table.vacuum(keep=1)
    assert _ids(table) == [2, 4, 6, 10] and table.versions() == [2]


def test_s9_second_of_two_writers_is_refused(spark, tmp_path):
    one = _seeded(spark, tmp_path / "t")
    two = _table(spark, tmp_path / "t")
    base = two.version()
    replace_where(one, F.col("id") == 1, _rows(spark, []))
    with pytest.raises(CommitConflict):
        replace_where(two, F.col("id") == 2, _rows(spark, []), base=base)
    assert _ids(two) == [2, 3, 4, 5, 6]
    with pytest.raises(ValueError):
        one.replace(_rows(spark, [(9, "elsewhere", "u")]), ["a"])
    assert not [f for f in (tmp_path / "t" / "log").iterdir() if "draft" in f.name and not f.name.endswith(".crc")]


def test_s9_on_bronze_keeps_variants(spark, tmp_path):
    rows = [{"record_id": f"r{i}", "body": {"uuid": f"u{i}"}, "headers": {"x-device-id": "d" if i % 2 else "e"},
             "record_type": ["samples", "sleep"][i % 2]} for i in range(6)]
    table = SnapshotTable(spark, str(tmp_path / "b"), "record_type", BRONZE)
    table.append(make_bronze(spark, rows))
    again = make_bronze(spark, rows).filter("record_id = 'r1'").withColumn("record_id", F.lit("new"))
    assert replace_where(table, F.try_variant_get("headers", "$['x-device-id']", "string") == "d", again) == 3
    got = sorted((r.record_id, str(r.body)) for r in table.read().collect())
    assert [g[0] for g in got] == ["new", "r0", "r2", "r4"] and '"u1"' in got[0][1]


# --- X6 -------------------------------------------------------------------------

SCHEMA = "id string, kind string, v int, t timestamp"


def _state(spark, path, **k) -> KeyedState:
    return KeyedState(spark, str(path), _parse_datatype_string(SCHEMA), "id", F.unix_micros("t"), ["v"], **{"buckets": 8, **k})


def _changes(spark, rows):
    """(op, id, kind, v, hour)"""
    data = [(op, i, kind, v, T0 + dt.timedelta(hours=h)) for op, i, kind, v, h in rows]
    return spark.createDataFrame(data, "op string, id string, kind string, v int, t timestamp")


def _live(state):
    return sorted((r.id, r.v) for r in state.rows().collect())


def test_x6_stream_of_several_batches(spark, tmp_path):
    src = tmp_path / "changes"
    src.mkdir()
    batches = [[("upsert", "a", "k", 1, 0), ("upsert", "b", "k", 1, 0), ("upsert", "a", "k", 2, 1), ("upsert", None, "k", 2, 1)],
               [("delete", "b", None, None, 2), ("upsert", "c", "k", 1, 0)],
               [("upsert", "a", "k", 0, -5),  # an older version: loses
                ("delete", "c", None, None, 1), ("upsert", "c", "k", 3, 2), ("delete", "e", None, None, 0)],  # a delete before its record ...
               [("upsert", "e", "k", 1, 3)]]  # ... still removes it
    for b in batches:
        _changes(spark, b).coalesce(1).write.mode("append").parquet(str(src))
    state = _state(spark, tmp_path / "state")
    stream = spark.readStream.schema(_changes(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    state.follow(stream, str(tmp_path / "ck")).awaitTermination()
    assert _live(state) == [("a", 2)]
    assert state.table.manifest()["meta"]["epoch"] == 3
    # replayed from the start (its own checkpoint lost): every epoch is known, nothing is written
    version = state.table.version()
    state.follow(stream, str(tmp_path / "ck2")).awaitTermination()
    assert state.table.version() == version and _live(state) == [("a", 2)]


def test_x6_any_batches_give_the_batch_form(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice(["upsert"] * 4 + ["delete"]), f"i{rng.randrange(60)}", "k", rng.randrange(99), rng.randrange(500)) for _ in range(300)]
    want = {}
    dead = {i for op, i, *_ in rows if op == "delete"}
    for op, i, _, v, h in rows:
        if op == "upsert" and i not in dead:
            want[i] = max(want.get(i, (-1, -1)), (h, v))
    for parts in (1, 4):
        state = _state(spark, tmp_path / f"s{parts}")
        for k in range(parts):
            c = _changes(spark, rows[k::parts])
            state.apply(c.filter("op = 'upsert'").drop("op"), c.filter("op = 'delete'").select("id", "t"))
        assert _live(state) == sorted((i, v) for i, (_, v) in want.items())


def test_x6_writes_grow_with_the_change_and_tombstones_expire(spark, tmp_path):
    state = _state(spark, tmp_path / "s", keep_tombstones=10 * 3600 * 1_000_000)
    c = _changes(spark, [("upsert", f"i{k}", "k", k, 0) for k in range(200)])
    none = c.filter("false").select("id", "t")
    state.apply(c.drop("op"), none)
    before = set(state.table.folders())
    assert len(before) == 8
    one = _changes(spark, [("delete", "i7", None, None, 1)])
    state.apply(one.filter("false").drop("op"), one.select("id", "t"))
    assert len(set(state.table.folders()) - before) == 1  # one bucket rewritten, the others' files stay
    assert state.table.read().filter("_dead").count() == 1
    late = _changes(spark, [("upsert", f"i{k}", "k", k, 30) for k in range(200) if k != 7])
    state.apply(late.drop("op"), none)
    assert state.table.read().filter("_dead").count() == 0 and len(_live(state)) == 199
    versions = state.table.versions()
    state.table.vacuum(keep=1)
    assert len(versions) == 3 and len(_live(state)) == 199


def test_x6_tokens_and_expiry(spark, tmp_path):
    state = _state(spark, tmp_path / "s")
    hour = lambda h: int((T0 + dt.timedelta(hours=h) - dt.datetime(1970, 1, 1)).total_seconds()) * 1_000_000
    first = [("upsert", "a1", "A", 1, 0), ("upsert", "a2", "A", 1, 1), ("upsert", "b1", "B", 1, 1)]
    reads = []

    def full_read(live):
        def read(types):
            reads.append(sorted(types))
            return _changes(spark, [r for r in live if r[2] in types]).drop("op")
        return read

    how = state.sync(_changes(spark, first), full_read(first), type_col="kind")
    assert how == {"A": "full", "B": "full"} and state.tokens() == {"A": hour(1), "B": hour(1)}
    log = first + [("upsert", "a1", "A", 2, 3), ("delete", "b1", "B", None, 4), ("upsert", "b2", "B", 5, 4)]
    how = state.sync(_changes(spark, log), full_read([]), type_col="kind")
    assert how == {"A": "changes", "B": "changes"} and _live(state) == [("a1", 2), ("a2", 1), ("b2", 5)]
    assert state.sync(_changes(spark, log), full_read([]), type_col="kind") == {"A": "none", "B": "none"}
    # the log forgot how a2 was deleted and a1 changed; B goes on from its token
    short = [("upsert", "a3", "A", 9, 20), ("upsert", "b3", "B", 6, 21)]
    live = [("upsert", "a1", "A", 7, 9), ("upsert", "a3", "A", 9, 20)]
    how = state.sync(_changes(spark, short), full_read(live), {"A": hour(15), "B": hour(2)}, type_col="kind")
    assert how == {"A": "full", "B": "changes"} and reads[1:] == [["A"]]
    assert _live(state) == [("a1", 7), ("a3", 9), ("b2", 5), ("b3", 6)]
    assert state.tokens() == {"A": hour(20), "B": hour(21)}


def test_x6_a_failed_pull_moves_neither_rows_nor_tokens(spark, tmp_path, monkeypatch):
    state = _state(spark, tmp_path / "s")
    rows = [("upsert", "a", "A", 1, 0)]
    state.sync(_changes(spark, rows), lambda t: _changes(spark, rows).drop("op"), type_col="kind")
    tokens = state.tokens()
    more = _changes(spark, rows + [("upsert", "b", "A", 1, 5)])
    with monkeypatch.context() as m:
        m.setattr(SnapshotTable, "_publish", lambda *a: (_ for _ in ()).throw(OSError("disk")))
        with pytest.raises(OSError):
            state.sync(more, None, type_col="kind")
    assert state.tokens() == tokens and _live(state) == [("a", 1)]
    real, calls = SnapshotTable._publish, []

    def overtaken(self, version, text):
        calls.append(version)
        if len(calls) == 1:  # another writer publishes this version first
            real(self, version, json.dumps(self.manifest(version - 1) | {"version": version}))
        real(self, version, text)

    monkeypatch.setattr(SnapshotTable, "_publish", overtaken)
    state.sync(more, None, type_col="kind")
    assert calls == [2, 3] and _live(state) == [("a", 1), ("b", 1)]


# --- X4 -------------------------------------------------------------------------

def _samples(spark, days, seed=3):
    rng = random.Random(seed)
    rows = []
    for d in days:
        for k in range(30):
            at = T0 + dt.timedelta(days=d, minutes=rng.randrange(1440))
            kind = rng.choice(["HKQuantityTypeIdentifierStepCount", "HKQuantityTypeIdentifierHeartRate", "HKQuantityTypeIdentifierRestingHeartRate"])
            rows.append((f"{d}-{k}", rng.choice(["u", "v", None]), kind, rng.choice([None, float(rng.randrange(90))]), at))
    return spark.createDataFrame(rows, "record_id string, user_id string, hk_type string, value double, start_at timestamp")


def _table_of(df):
    return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()), key=repr)


def test_x4_new_day_reads_and_rewrites_that_day_only(spark, tmp_path):
    g = IncrementalGold(spark, str(tmp_path / "gold"))
    old, new = _samples(spark, range(10)), _samples(spark, [10], 4)
    full = {"hk_quantity_daily": gold.hk_quantity_daily, "daily_steps": gold.daily_steps, "hr_intraday": gold.heart_rate_intraday_daily,
            "family_weekly": gold.hk_family_weekly}
    for name, build in full.items():
        g.update(name, old, 0)
        before = set(g.table(name).folders())
        touched = g.update(name, new, 1)
        assert len(touched) == 1 and len(set(g.table(name).folders()) - before) == 1
        want = build(old.union(new))
        assert _table_of(g.read(name).select(*want.columns)) == _table_of(want), name
        assert g.update(name, new, 1) == []  # a replay after the commit adds nothing
        assert _table_of(g.read(name).select(*want.columns)) == _table_of(want)
        again = g.update(name, _samples(spark, [3], 8), 2)  # late rows of an old day
        want = build(old.union(new).union(_samples(spark, [3], 8)))
        assert len(again) == 1 and _table_of(g.read(name).select(*want.columns)) == _table_of(want)


def test_x4_distinct_sets_merge(spark, tmp_path):
    rows = [{"record_id": f"s{k}", "ingested_at": f"2026-01-{10 + k % 3}T05:00:00Z", "user_id": "u", "record_type": "sleep",
             "body": {"start_date": "2026-01-09T22:00:00Z", "end_date": "2026-01-10T05:00:00Z",
                      "stages": [{"uuid": f"{k}-{i}", "stage": st, "start_date": f"2026-01-09T2{2 + i}:00:00Z", "end_date": f"2026-01-09T2{2 + i}:40:00Z"}
                                 for i, st in enumerate(["asleepCore", "awake"])]}} for k in range(5)]
    stages = silver.sleep_stages(make_bronze(spark, rows))
    assert stages.count() == 10
    g = IncrementalGold(spark, str(tmp_path / "g"))
    for k in range(3):  # the same records arrive in several batches
        g.update("sleep_nightly", stages.filter(F.pmod(F.hash("stage_uuid"), F.lit(3)) == k), k)
    want = gold.sleep_nightly(stages)
    assert _table_of(g.read("sleep_nightly").select(*want.columns)) == _table_of(want)
    assert g.read("sleep_nightly").first().sleep_sessions == 5


def test_x4_a_stream_keeps_several_tables(spark, tmp_path):
    sink = str(tmp_path / "sink")
    whole = _samples(spark, range(6))
    whole.repartition(5).write.parquet(sink)
    g = IncrementalGold(spark, str(tmp_path / "g"))
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 2).parquet(sink)
    g.follow(stream, ["daily_steps", "hr_intraday"], str(tmp_path / "ck")).awaitTermination()
    assert g.table("daily_steps").version() == 3
    _samples(spark, [7], 9).coalesce(1).write.mode("append").parquet(sink)
    g.follow(stream, ["daily_steps", "hr_intraday"], str(tmp_path / "ck")).awaitTermination()  # the next run takes the new file only
    want = gold.daily_steps(spark.read.parquet(sink))
    assert _table_of(g.read("daily_steps").select(*want.columns)) == _table_of(want)
    assert g.table("daily_steps").version() == 4
    assert set(ROLLUPS) >= {"daily_steps", "ingest_daily", "weekly_workouts"}


def test_x4_refresh_takes_only_what_is_new(spark, tmp_path):
    from vitalake.plans.medallion import Medallion
    from vitalake.plans.refresh import refresh_incremental
    from vitalake.sources.bronze_store import read_bronze, write_bronze

    def landed(days):
        rows = []
        for d in days:
            for k in range(6):
                kind = ["HKQuantityTypeIdentifierStepCount", "HKQuantityTypeIdentifierHeartRateVariabilitySDNN", "HKQuantityTypeIdentifierRestingHeartRate"][k % 3]
                at = f"2026-01-{d:02d}T0{k}:00:00Z"
                rows.append({"record_id": f"{d}-{k}", "ingested_at": at, "record_type": "samples", "user_id": f"u{k % 2}",
                             "body": {"uuid": f"s{d}-{k}", "type": kind, "unit": "x", "value": k + d, "start_date": at, "end_date": at}})
            rows.append({"record_id": f"w{d}", "ingested_at": f"2026-01-{d:02d}T09:00:00Z", "record_type": "workouts", "user_id": "u0",
                         "body": {"uuid": f"w{d}", "activity_type": "run", "start_date": f"2026-01-{d:02d}T08:00:00Z", "duration_seconds": 60.0 * d}})
            stage = {"uuid": f"z{d}", "stage": "asleepDeep", "start_date": f"2026-01-{d:02d}T01:00:00Z", "end_date": f"2026-01-{d:02d}T02:00:00Z"}
            rows.append({"record_id": f"sl{d}", "ingested_at": f"2026-01-{d:02d}T10:00:00Z", "record_type": "sleep", "user_id": "u1",
                         "body": {"start_date": stage["start_date"], "end_date": stage["end_date"], "stages": [stage]}})
        return make_bronze(spark, rows)

    path = str(tmp_path / "bronze")
    write_bronze(landed(range(5, 10)), path)
    first = refresh_incremental(spark, path, str(tmp_path / "out"))
    before = {name: set(first.table(name).folders()) for name in ROLLUPS}
    write_bronze(landed([20]), path, "append")
    again = refresh_incremental(spark, path, str(tmp_path / "out"))
    batch = Medallion(read_bronze(spark, path))
    for name in ROLLUPS:
        if name == "cardio_vitals_strict":
            want = gold.cardio_vitals_daily(batch.samples, True)
        else:
            want = getattr(batch, name)
        assert _table_of(again.read(name).select(*want.columns)) == _table_of(want), name
        new = set(again.table(name).folders())
        assert len(before[name]) > 1 or name.endswith("weekly") or name == "weekly_workouts"
        assert before[name] <= new and len(new - before[name]) == 1, name  # the new day (week) only


def test_stored_layers_keep_options_apart_and_follow_the_code(spark, tmp_path, monkeypatch):
    from vitalake.plans.medallion import Medallion, StoredMedallion
    from vitalake.sources import bronze_store
    rows = [{"record_id": f"r{k}", "record_type": "samples", "ingested_at": "2026-01-05T00:00:00Z",
             "body": {"uuid": f"s{k}", "type": t, "value": v, "start_date": "2026-01-05T01:00:00Z"}}
            for k, (t, v) in enumerate([("HKQuantityTypeIdentifierHeartRate", 60.0), ("HKQuantityTypeIdentifierHeartRateVariabilitySDNN", 10.0)])]
    bronze, root = make_bronze(spark, rows), str(tmp_path / "layers")
    for strict in (False, True, False):
        stored = StoredMedallion(bronze, root, strict_heart_rate=strict)
        fresh = Medallion(bronze, strict_heart_rate=strict)
        assert stored.cardio_vitals.first().heart_rate_avg == fresh.cardio_vitals.first().heart_rate_avg == (60.0 if strict else 35.0)
    monkeypatch.setattr(bronze_store, "code_version", lambda *m: "changed")
    monkeypatch.setattr(gold, "cardio_vitals_daily", lambda s, strict=False: s.select(F.lit(1.0).alias("heart_rate_avg"), F.to_date("start_at").alias("day")))
    assert StoredMedallion(bronze, root).cardio_vitals.first().heart_rate_avg == 1.0  # not the table of the old rule


def test_code_version_ignores_comments_and_docstrings(tmp_path):
    import ast
    from vitalake.sources.bronze_store import LANDED_BY, LAYERS_BY, _without_docs, code_version
    one, two, three = ('"""a"""\ndef f():\n    """b"""\n    return 1  # c\n', 'def f():\n    return 1\n', 'def f():\n    return 2\n')
    dump = lambda text: ast.dump(_without_docs(ast.parse(text)))
    assert dump(one) == dump(two) != dump(three)
    assert len(code_version(*LANDED_BY)) == 8 and code_version(*LANDED_BY) != code_version(*LAYERS_BY)


def test_input_key_sees_files_of_a_folder(spark, tmp_path):
    from vitalake.sources.bronze_store import _input_key
    path = tmp_path / "events.parquet"
    spark.range(5).coalesce(1).write.parquet(str(path))
    one = _input_key(spark, str(path))
    assert one == _input_key(spark, str(path))
    spark.range(2).coalesce(1).write.mode("append").parquet(str(path))
    assert _input_key(spark, str(path)) != one


# --- R23 in the write pass, R13 / R16 / R19 by bitmaps ----------------------------

def test_r23_a_failing_rule_leaves_the_table_unpublished(spark, tmp_path):
    from vitalake.operators.quality import QualityRefused, land_checked
    body = {"uuid": "u", "type": "t", "value": 1, "unit": "x", "start_date": "2026-01-01T00:00:00Z", "end_date": "2026-01-01T00:00:00Z", "source_name": "s"}
    headers = {"x-record-type": "samples", "x-platform": "apple_healthkit", "x-device-id": "d"}
    good = [{"record_id": f"r{k}", "body": body, "headers": headers, "record_type": "samples"} for k in range(4)]
    table = SnapshotTable(spark, str(tmp_path / "t"), "record_type", BRONZE)
    checks = {c[0]: c[1] for c in land_checked(table, make_bronze(spark, good), "apple_healthkit", expected_rows=4)}
    assert checks["rows_present"] and checks["single_user"] and not checks["record_types_present"] and table.version() == 1
    bad_rows = {"single_platform": {"source_platform": "other"}, "header_blocklist": {"headers": headers | {"cookie": "c"}},
                "sample_body_keys": {"body": {"uuid": "u"}}, "keys_present": {"record_id": None}}
    for rule, change in bad_rows.items():
        batch = make_bronze(spark, [*good[:2], good[2] | {k: v for k, v in change.items() if k != "record_id"}])
        if rule == "keys_present":
            batch = batch.withColumn("ingested_at", F.when(F.col("record_id") != "r2", F.col("ingested_at")))
        with pytest.raises(QualityRefused) as refused:
            land_checked(table, batch, "apple_healthkit")
        assert [c[0] for c in refused.value.checks if not c[1] and c[0] not in ("record_types_present", "single_user")] == [rule]
    with pytest.raises(QualityRefused):
        land_checked(table, make_bronze(spark, good), "apple_healthkit", expected_rows=5)
    assert table.version() == 1 and table.read().count() == 4
    assert table.manifest()["meta"]["checks"][0][:2] == ["rows_present", True]


def test_distinct_users_of_any_window_from_day_rows(spark, tmp_path):
    from vitalake.operators.distinct_users import UserDays
    rng = random.Random(6)
    rows = [(dt.date(2026, 1, 1 + rng.randrange(20)), rng.choice([None, *[f"u{k}" for k in range(50)]])) for _ in range(600)]
    frame = lambda r: spark.createDataFrame(r, "day date, user_id string")
    users = UserDays(spark, str(tmp_path / "u"))
    for k in range(3):
        users.update(frame(rows[k * 200:(k + 1) * 200]), k)
    assert users.update(frame(rows[:50]), 2) == []
    whole = frame(rows)
    for start, end in (("2026-01-01", "2026-01-20"), ("2026-01-05", "2026-01-05"), ("2026-01-03", "2026-01-09"), ("2027-01-01", "2027-02-01")):
        want = whole.filter(F.col("day").between(F.lit(start).cast("date"), F.lit(end).cast("date"))).agg(F.count_distinct("user_id")).first()[0]
        assert users.between(start, end).first().users == want
    per_day = {r.day: r.users for r in users.per_day().collect()}
    assert per_day == {r.day: r.n for r in whole.groupBy("day").agg(F.count_distinct("user_id").alias("n")).collect()}
    seen = {}
    for d, u in rows:
        seen.setdefault(d, set()).add(u)
    rolling = {r.window_end: r.users for r in users.rolling(7).collect()}
    assert rolling == {d: len(set().union(*(seen.get(d - dt.timedelta(days=k), set()) for k in range(7))) - {None}) for d in seen}
    numbers = users.users.read().collect()
    assert len({r.n for r in numbers}) == len({r.user_id for r in numbers}) == 50
    before = set(users.days.folders())
    assert users.update(frame([(dt.date(2026, 1, 3), "new"), (None, "x")]), 3) == ["2026-01-03"]
    assert len(set(users.days.folders()) - before) == 1 and users.between("2026-01-01", "2026-01-31").first().users == 51


def test_j1_on_bucketed_tables_needs_no_exchange(spark, tmp_path):
    from vitalake.plans.bucketed import BucketedStore, activity_enriched_bucketed
    rng = random.Random(1)
    rings = spark.createDataFrame(
        [(f"r{k}", rng.choice(["a", "b", None]), dt.date(2026, 1, 1 + k % 28), float(k), 500.0, 1.0, 30.0, k % 16, 12) for k in range(200)],
        "record_id string, user_id string, summary_date date, active_energy_burned_kcal double, active_energy_burned_goal_kcal double, "
        "exercise_minutes double, exercise_minutes_goal double, stand_hours long, stand_hours_goal long")
    steps = spark.createDataFrame([(u, dt.date(2026, 1, d), float(d), d) for u in ("a", "b") for d in range(1, 29, 2)],
                                  "user_id string, day date, total_steps double, sample_intervals long")
    out = activity_enriched_bucketed(BucketedStore(spark, str(tmp_path / "s"), 8), rings, steps)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        again = BucketedStore(spark, str(tmp_path / "s"), 99)  # another session's default: the layout is the stored one
        out = activity_enriched_bucketed(again, rings, steps)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    want = gold.activity_enriched_daily(rings, steps)
    assert _table_of(out.select(*want.columns)) == _table_of(want) and out.count() == 200


def test_j4_on_bucketed_tables_moves_no_facts(spark, tmp_path):
    from vitalake.operators.deletes import apply_deletes
    from vitalake.plans.bucketed import BucketedStore, live_bucketed
    facts = spark.createDataFrame([(f"f{k}" if k % 9 else None, k) for k in range(300)], "id string, v long")
    gone = spark.createDataFrame([(f"f{k}",) for k in range(0, 400, 7)] * 2 + [(None,)], "deleted_uuid string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for mode in ("remove", "flag"):
            out = live_bucketed(BucketedStore(spark, str(tmp_path / mode), 4), "facts", facts, gone, "id", mode)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
            want = apply_deletes(facts, gone, "id", mode)
            assert _table_of(out.select(*want.columns)) == _table_of(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def _files_for(table, user, start, end):
    """Data files whose statistics do not rule the user and the time span out, and all files."""
    import glob
    import pyarrow.parquet as pq
    hit = every = 0
    for folder in table.folders():
        for f in glob.glob(f"{folder}/*.parquet"):
            meta = pq.ParquetFile(f).metadata
            names = [meta.schema.column(k).name for k in range(meta.num_columns)]
            every += 1
            for g in range(meta.num_row_groups):
                u, t = (meta.row_group(g).column(names.index(c)).statistics for c in ("user_id", "ingested_at"))
                if u.min <= user <= u.max and t.min.replace(tzinfo=None) < end and t.max.replace(tzinfo=None) >= start:
                    hit += 1
                    break
    return hit, every


def test_s12_clustered_files_skip_more_as_the_table_grows(spark, tmp_path):
    from vitalake.sources import layout
    schema = _parse_datatype_string("record_id long, user_id string, ingested_at timestamp, kind string")
    start, end = T0 + dt.timedelta(days=60), T0 + dt.timedelta(days=90)
    old = spark.conf.get("spark.sql.parquet.outputTimestampType")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")  # statistics of times
    try:
        shares = []
        for size, files in ((4_000, 4), (16_000, 16), (64_000, 64)):
            rows = spark.range(size).select(
                F.col("id").alias("record_id"), F.concat(F.lit("u"), F.lpad((F.xxhash64("id") % 500 + 500).cast("string"), 3, "0")).alias("user_id"),
                (F.lit(T0) + F.make_dt_interval(hours=F.pmod(F.xxhash64("id", F.lit(1)), F.lit(24 * 360)).cast("int"))).alias("ingested_at"), F.lit("k").alias("kind"))
            table = SnapshotTable(spark, str(tmp_path / f"t{size}"), "kind", schema)
            for k in range(4):
                table.append(rows.filter(F.col("record_id") % 4 == k).repartition(files // 2 + 1))
            plain, n = _files_for(table, "u500", start, end)
            assert plain == n  # appended files say nothing
            total = sum(map(sum, layout.file_sizes(table).values()))
            assert layout.compact(table, target_bytes=-(-total // files)) and layout.compact(table, target_bytes=-(-total // files)) == {}
            hit, every = _files_for(table, "u500", start, end)
            shares.append(hit / every)
            assert every <= files and table.read().count() == size and table.read().select("record_id").distinct().count() == size
        assert shares[0] >= shares[1] >= shares[2] and shares[2] <= 0.15, shares
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", old)


def test_s12_compaction_plan_takes_small_files_only():
    from vitalake.sources.layout import plan_compaction
    mb = 1 << 20
    sizes = {"a": [mb] * 10, "b": [100 * mb] * 3, "c": [300 * mb], "d": [60 * mb] * 9, "e": [], "f": [mb]}
    assert plan_compaction(sizes, 128 * mb) == {"a": 1}
    assert plan_compaction(sizes, 300 * mb) == {"a": 1, "b": 1, "d": 2}


def test_x4_x6_micro_batches_do_not_grow_with_the_files(spark, tmp_path):
    from vitalake.plans import state_queries
    path = str(tmp_path / "sink")
    _samples(spark, range(6)).repartition(60).write.parquet(path)
    held = spark.read.parquet(path)
    n = len(held.inputFiles())
    assert n > 50 and -(-n // state_queries.step_files(held)) <= state_queries.STEPS
    g = IncrementalGold(spark, str(tmp_path / "g"))
    stream = spark.readStream.schema(held.schema).option("maxFilesPerTrigger", state_queries.step_files(held)).parquet(path)
    g.follow(stream, ["daily_steps"], str(tmp_path / "ck")).awaitTermination()
    assert 1 < g.table("daily_steps").version() <= state_queries.STEPS
    want = gold.daily_steps(held)
    assert _table_of(g.read("daily_steps").select(*want.columns)) == _table_of(want)


def test_s12_compaction_sorts_in_slices(spark, tmp_path, monkeypatch):
    from vitalake.sources import layout
    schema = _parse_datatype_string("record_id long, user_id string, ingested_at timestamp, kind string")
    rows = spark.range(20_000).select(F.col("id").alias("record_id"), F.lit("u").alias("user_id"),
                                      (F.lit(T0) + F.make_dt_interval(mins=F.pmod(F.xxhash64("id"), F.lit(90_000)).cast("int"))).alias("ingested_at"),
                                      F.when(F.col("id") % 4 > 0, F.lit("k")).alias("kind"))
    table = SnapshotTable(spark, str(tmp_path / "t"), "kind", schema)
    for k in range(4):
        table.append(rows.filter(F.col("record_id") % 4 == k))
        table.append(rows.filter(F.col("record_id") % 4 == k).withColumn("record_id", -F.col("record_id") - 1))
    largest, plain = [], layout.clustered

    def watched(rows, files, *rest):
        out = plain(rows, files, *rest)
        held = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
        largest.append((max(held), sum(held)))
        return out

    monkeypatch.setattr(layout, "clustered", watched)
    monkeypatch.setattr(layout, "SLICE_BYTES", 8 << 10)
    plan = layout.compact(table)
    assert sorted(plan.values()) == [1, 1] and sum(n for _, n in largest) == 40_000
    assert all(most <= total / 8 for most, total in largest), largest  # no task sorts the rows of a whole file
    assert all(len(v) == 1 for v in layout.file_sizes(table).values()) and layout.compact(table) == {}
    assert table.read().count() == 40_000 and table.read().select("record_id").distinct().count() == 40_000
    assert table.read().filter("kind IS NULL").count() == 10_000
