"""NDJSON landing (F11), header/user rules, NDJSON writing, batching and
the table chores (S1-S17)."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import functions as F

from vitalake.sources import landing
from vitalake.sources.bronze_store import read_bronze, write_bronze


def _requests(spark, payload, headers):
    return spark.createDataFrame([("req1", dt.datetime(2026, 4, 16, 9), headers, payload)], landing.REQUEST_SCHEMA)


F11 = "\n".join([
    json.dumps({"uuid": "a", "type": "T", "value": 1}),
    "   ",
    "{bad",
    json.dumps({"uuid": "b", "type": "T", "value": 2, "demo_user_id": "  demo-user-7  "}),
])


def test_f11_parse_and_build(spark):
    headers = {"x-record-type": " Samples ", "x-platform": "Apple_HealthKit", "authorization": "Bearer abc",
               "cookie": "c", "x-forwarded-email": "me@example.com", "x-device-id": "d1"}
    req = _requests(spark, F11.replace("\n", "\r\n", 1), headers)
    good, errors = landing.parse_requests(req)
    assert [e.message for e in errors.collect()] == ["Line 2: invalid JSON"]  # blank lines removed before numbering
    b = landing.build_bronze(good).orderBy("user_id").collect()
    assert len(b) == 2
    assert {r.record_type for r in b} == {"samples"} and {r.source_platform for r in b} == {"apple_healthkit"}
    # Bearer -> anonymous; per-line override trimmed and removed from the body
    assert [r.user_id for r in b] == ["anonymous", "demo-user-7"]
    body_b = json.loads(str(b[1].body))
    assert "demo_user_id" not in body_b and body_b["uuid"] == "b"
    hdr = json.loads(str(b[0].headers))
    assert "authorization" not in hdr and "cookie" not in hdr and hdr["x-ingest-channel"] == "rest_app"
    log = landing.request_log(req).collect()[0]
    assert (log.record_count, log.http_status_code, log.success) == (2, 200, True)


def test_user_from_email_and_line_limit(spark):
    req = _requests(spark, "\n".join(['{"a":1}'] * 5), {"x-record-type": "samples", "x-forwarded-email": "me@x"})
    good, errors = landing.parse_requests(req, max_lines=4)
    assert good.count() == 0
    assert errors.collect()[0].message == "Too many NDJSON lines (5). Maximum allowed is 4."
    good, _ = landing.parse_requests(req)
    assert {r.user_id for r in landing.build_bronze(good).collect()} == {"me@x"}
    missing = _requests(spark, '{"a":1}', {"x-record-type": "  "})
    g2, e2 = landing.parse_requests(missing)
    assert landing.build_bronze(g2).count() == 0
    assert landing.request_log(missing).collect()[0].http_status_code == 400


def test_replay_safe_record_ids(spark):
    req = _requests(spark, F11, {"x-record-type": "samples"})
    good, _ = landing.parse_requests(req)
    a = sorted(r.record_id for r in landing.build_bronze(good).collect())
    b = sorted(r.record_id for r in landing.build_bronze(good).collect())
    assert a == b and len(set(a)) == 2


def test_s16_ndjson_sorted_keys_nulls_omitted(spark, tmp_path):
    df = spark.createDataFrame([("x", None, 2.5)], "zeta string, alpha string, mid double")
    assert df.select(landing.ndjson_line(df)).first()[0] == '{"mid":2.5,"zeta":"x"}'
    assert spark.createDataFrame([], "a int").select(landing.ndjson_line(spark.createDataFrame([], "a int"))).count() == 0


def test_s17_batch_chunks_match_single_window(spark):
    rows = [("t1" if i % 3 else "t2", dt.datetime(2026, 1, 1) + dt.timedelta(hours=7 * i), f"r{i:03d}") for i in range(50)]
    df = spark.createDataFrame(rows, "record_type string, ingested_at timestamp, record_id string")
    got = {r.record_id: r.batch_no for r in landing.batch_chunks(df, 4).collect()}
    expect = {}
    for t in ("t1", "t2"):
        ordered = sorted((r for r in rows if r[0] == t), key=lambda r: (r[1], r[2]))
        expect.update({r[2]: i // 4 for i, r in enumerate(ordered)})
    assert got == expect


def test_s11_backfill_and_s9_replace(spark, tmp_path):
    landed = spark.createDataFrame([("2026-04-01",), ("2026-04-03",)], "date string")
    missing = [r.missing_day for r in landing.backfill_days(spark, "2026-04-01", "2026-04-05", landed).orderBy("missing_day").collect()]
    assert missing == [dt.date(2026, 4, 2), dt.date(2026, 4, 4)]
    import pytest
    with pytest.raises(ValueError):
        landing.backfill_days(spark, "2026-04-05", "2026-04-05", landed)
    path = str(tmp_path / "bronze")
    base = spark.createDataFrame([(f"r{i}", dt.datetime(2026, 4, 1), '{"a":1}', json.dumps({"x-device-id": "demo-notebook-seed" if i < 2 else "d"}),
                                   "samples", "p", "u") for i in range(4)],
                                 "record_id string, ingested_at timestamp, b string, h string, record_type string, source_platform string, user_id string")
    base = base.select("record_id", "ingested_at", F.parse_json("b").alias("body"), F.parse_json("h").alias("headers"),
                       "record_type", "source_platform", "user_id")
    write_bronze(base, path)
    seed = F.try_variant_get("headers", "$['x-device-id']", "string") == "demo-notebook-seed"
    new = base.filter(seed).withColumn("record_id", F.concat(F.col("record_id"), F.lit("-new")))
    removed = landing.replace_rows(spark, path, seed, new)
    assert removed == 2
    assert sorted(r.record_id for r in read_bronze(spark, path).collect()) == ["r0-new", "r1-new", "r2", "r3"]


def test_s12_create_evolve_and_s15_drop(spark, tmp_path):
    spark.sql("DROP TABLE IF EXISTS vl_test_bronze")
    landing.create_bronze(spark, "vl_test_bronze", str(tmp_path / "t"))
    landing.create_bronze(spark, "vl_test_bronze", str(tmp_path / "t"))  # idempotent
    landing.evolve_bronze(spark, "vl_test_bronze", {"device_id": "STRING"})
    assert "device_id" in spark.table("vl_test_bronze").columns
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2, "y")], "x int, z string")
    assert landing.union_evolving([a, b]).orderBy("x").collect()[0].z is None
    stmts = landing.drop_medallion(spark)
    assert stmts[0].startswith("DROP VIEW") and stmts[-1].endswith("bronze_stream")
    spark.sql("DROP TABLE IF EXISTS vl_test_bronze")


def test_request_size_limit(spark, tmp_path):
    d = tmp_path / "req" / "x_record_type=samples" / "x_platform=p"
    d.mkdir(parents=True)
    (d / "small.txt").write_text('{"a":1}\n{"a":2}\n')
    (d / "big.txt").write_text('{"a":1}\n' * 40)
    root = str(tmp_path / "req")
    req = landing.read_request_files(spark, root, max_bytes=100)
    assert req.count() == 1
    good, _ = landing.parse_requests(req)
    assert good.count() == 2
    big = landing.oversized_request_files(spark, root, max_bytes=100).collect()
    assert len(big) == 1 and big[0].bytes == 320


def test_nothing_is_lost_for_its_size(spark, tmp_path):
    d = tmp_path / "req" / "x_record_type=samples" / "x_platform=p"
    d.mkdir(parents=True)
    line = '{"uuid":"%07d","pad":"' + "x" * 500 + '"}'
    (d / "big.txt").write_text("\r\n\n".join(line % i for i in range(25_000)) + "\n{bad\n")  # over 10 MB and 10 000 lines
    (d / "small.txt").write_text('{"uuid":"s"}')
    root = str(tmp_path / "req")
    whole = landing.read_request_lines(spark, root)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))  # the large file in many blocks
    try:
        by_line = landing.read_request_lines(spark, root, whole_bytes=1000)
        names = ("request_id", "line_no", "line")
        assert sorted(tuple(r[n] for n in names) for r in by_line.collect()) == sorted(tuple(r[n] for n in names) for r in whole.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    good, errors = landing.parse_lines(whole)
    assert good.count() == 25_001 and [r.message for r in errors.collect()] == ["Line 25001: invalid JSON"]
    bronze = landing.build_bronze(good)
    plan = bronze._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("FileScan") == 1
    log = {r.record_count: r for r in landing.request_log(landing.read_request_files(spark, root)).collect()}
    assert log[25_000].error_count == 1 and log[25_000].success and log[1].error_count == 0
    user = "u" * 300
    req = _requests(spark, json.dumps({"demo_user_id": user}), {"x-record-type": "samples"})
    assert landing.build_bronze(landing.parse_requests(req)[0]).first().user_id == user


def test_r25_log_by_line_equals_the_log_of_whole_requests(spark, tmp_path):
    for name, text in {"a": '{"x":1}\n\n{bad\n{"x":2}\n', "b": "", "c": "\n  \n", "d": "{bad\n" * 40, "e": '{"x":1}'}.items():
        d = tmp_path / "req" / f"x_record_type={'' if name == 'x' else 'samples'}" / "x_platform=p" / f"x_request={name}" / "x_received=20260101000000"
        d.mkdir(parents=True)
        (d / "r.txt").write_text(text)
    root = str(tmp_path / "req")
    names = ["request_id", "record_type", "timestamp", "record_count", "error_count", "http_status_code", "success", "message"]
    whole = landing.request_log(landing.read_request_files(spark, root))
    for whole_bytes in (64 << 20, 10):  # all files as rows, then the large ones by line
        lines = landing.read_request_lines(spark, root, whole_bytes)
        log = landing.request_log_by_line(landing.list_requests(spark, root), lines)
        got = {r.request_id: tuple(r) for r in log.select(*names).collect()}
        want = {r.request_id: tuple(r) for r in whole.select(*names).collect()}
        assert got == want and set(got) == {"a", "c", "d", "e"}
        assert "b" not in got and "b" not in want  # a file without bytes is none to either reader
        assert got["d"][4] == 40 and got["d"][7].count("Line") == landing.LOGGED_ERRORS
    empty = landing.list_requests(spark, root).filter("request_id = 'e'").selectExpr("'z' AS request_id", "received_at", "headers", "0L AS bytes")
    log = landing.request_log_by_line(empty, landing.read_request_lines(spark, root)).first()
    assert (log.record_count, log.http_status_code, log.message) == (0, 400, "Request body is empty")
    plan = landing.list_requests(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]


def test_s9_emptied_type_and_later_overwrite(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows = [("a", "u1", "samples"), ("b", "u2", "samples"), ("c", "u1", "deletes"), ("d", "u1", None)]
    base = spark.createDataFrame(rows, "record_id string, user_id string, record_type string").select(
        "record_id", F.lit(dt.datetime(2026, 4, 1)).alias("ingested_at"), F.parse_json(F.lit('{"a":1}')).alias("body"),
        F.parse_json(F.lit("{}")).alias("headers"), "record_type", F.lit("p").alias("source_platform"), "user_id")
    write_bronze(base, path)
    new = base.filter("record_id = 'a'").withColumn("record_id", F.lit("a2"))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    assert landing.replace_rows(spark, path, F.col("user_id") == "u1", new) == 3
    assert sorted(r.record_id for r in read_bronze(spark, path).collect()) == ["a2", "b"]  # the deletes partition is gone
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    write_bronze(base.filter("record_id = 'b'"), path)
    assert [r.record_id for r in read_bronze(spark, path).collect()] == ["b"]


def test_s17_nulls_and_one_instant(spark):
    t = dt.datetime(2026, 1, 1)
    rows = [("t1", t, f"r{i:03d}") for i in range(40)] + [(None, t, "n1"), (None, None, "n2"), ("t1", None, "n0")]
    df = spark.createDataFrame(rows, "record_type string, ingested_at timestamp, record_id string")
    for splits in (1, 5, 64):
        got = {r.record_id: r.batch_no for r in landing.batch_chunks(df, 7, splits=splits).collect()}
        ordered = ["n0", *(f"r{i:03d}" for i in range(40))]
        assert got == {r: i // 7 for i, r in enumerate(ordered)} | {"n2": 0, "n1": 0}


def test_s17_one_instant_is_spread_and_numbers_sort_as_numbers(spark):
    t = dt.datetime(2026, 1, 1)
    df = spark.range(3000).select(F.lit("t").alias("record_type"), F.lit(t).alias("ingested_at"), (F.col("id") * 7 % 3000).alias("n"))
    out = landing.batch_chunks(df, 100)
    assert {r.n: r.batch_no for r in out.collect()} == {k: k // 100 for k in range(3000)}
    marks = landing._range_marks(df.select("n"), 64)
    assert len(marks) > 40 and marks == sorted(marks)
    sizes = [sum(a <= k < b for k in range(3000)) for a, b in zip([-1, *marks], [*marks, 3000])]
    assert max(sizes) < 300  # no window holds the instant


def test_s8_append_staging_and_s14_publish(spark, tmp_path):
    path = str(tmp_path / "bronze")
    staged = spark.createDataFrame(
        [("s1", dt.datetime(2026, 4, 1), '{"uuid":"a","nested":{"x":[1,2]}}', '{"x-device-id":"demo-notebook-seed"}',
          "samples", "apple_healthkit", "u1")],
        "record_id string, ingested_at timestamp, body_json string, headers_json string, record_type string, "
        "source_platform string, user_id string")
    landing.append_json_staging(staged, path)
    landing.append_json_staging(staged.withColumn("record_id", F.lit("s2")), path)
    rows = read_bronze(spark, path).orderBy("record_id").collect()
    assert [r.record_id for r in rows] == ["s1", "s2"]
    assert json.loads(str(rows[0].body))["nested"] == {"x": [1, 2]}
    spark.sql(f"CREATE DATABASE IF NOT EXISTS vl_pub LOCATION '{tmp_path / 'db'}'")
    landing.publish(spark, {"gold_x": read_bronze(spark, path).select("record_id")},
                    {"vw_x": read_bronze(spark, path).select("user_id")}, schema="vl_pub")
    assert spark.table("vl_pub.gold_x").count() == 2 and spark.table("vw_x").count() == 2
    spark.sql("DROP TABLE IF EXISTS vl_pub.gold_x")
    spark.sql("DROP DATABASE IF EXISTS vl_pub")


def test_s1_packed_requests_read_as_one_file_each(spark, tmp_path):
    from vitalake.sources.bindings import bronze_from_dir
    bronze = bronze_from_dir(spark, "/root/testdata/sf0.001").cache()
    packed, tree = str(tmp_path / "packed"), tmp_path / "tree"
    landing.land_request_files(bronze, packed, rows_per_request=20, part_lines=3)  # most bodies in several parts
    n = spark.read.parquet(packed).select("x_request").distinct().count()
    files = list((tmp_path / "packed").rglob("*.parquet"))
    assert n >= 50 and len(files) <= spark.sparkContext.defaultParallelism  # not a file a request
    # the same bodies as a file each
    for r in landing.packed_requests(spark, packed).orderBy("x_request", "part").collect():
        d = tree / "/".join(f"{c}={r[c]}" for c in r.__fields__ if c.startswith("x_"))
        d.mkdir(parents=True, exist_ok=True)
        with open(d / "r.txt", "a") as f:
            f.write(r.payload)
    assert max(r.parts for r in spark.read.parquet(packed).select("parts").collect()) > 1
    whole = str(tmp_path / "whole")
    landing.land_request_files(bronze, whole, rows_per_request=20)  # a row a request
    text = F.to_json("headers").alias("h")
    readers = {"lines": lambda p: landing.read_request_lines(spark, p).select("request_id", "received_at", "line_no", "line", text),
               "files": lambda p: landing.read_request_files(spark, p).select("request_id", "received_at", "payload", text),
               "list": lambda p: landing.list_requests(spark, p).select("request_id", "received_at", "bytes", text),
               "limit": lambda p: landing.read_request_files(spark, p, max_bytes=2000).select("request_id", "payload")}
    for name, read in readers.items():
        want = sorted(tuple(r) for r in read(str(tree)).collect())
        assert sorted(tuple(r) for r in read(packed).collect()) == want and len(want) >= 5, name
        assert sorted(tuple(r) for r in read(whole).collect()) == want, name
    big = landing.oversized_request_files(spark, packed, max_bytes=2000).collect()
    assert {r.request_id for r in big} == {r.request_id for r in landing.list_requests(spark, str(tree)).filter("bytes > 2000").collect()} and big


def _packed(spark, path, bodies, part_lines):
    """Packed requests of the given bodies, cut after every ``part_lines`` line ends."""
    rows = []
    for name, body in bodies.items():
        lines = body.splitlines(keepends=True) or [""]
        parts = ["".join(lines[k:k + part_lines]) for k in range(0, len(lines), part_lines)]
        rows += [(None if name == "n" else "samples", "p", name, "20260101000000", len(parts), len(body), k, p) for k, p in enumerate(parts)]
    spark.createDataFrame(rows, "x_record_type string, x_platform string, x_request string, x_received string, parts int, bytes long, part int, payload string"
                          ).coalesce(1).write.parquet(path)


def test_r25_log_by_part_equals_the_log_of_whole_requests(spark, tmp_path):
    bodies = {"a": '{"x":1}\n\n{bad\n{"x":2}\n', "b": "", "c": "\n  \n", "d": "{bad\n" * 40, "e": '{"x":1}', "n": '{"x":1}\n{bad\n',
              "r": '{"x":1}\r\n\r\n{bad\r\n  \r\n{bad\n', "s": '{"x":1}\n' * 30 + "{bad\n" * 3 + "\n" + "{bad\n" * 25}
    names = ["request_id", "record_type", "timestamp", "record_count", "error_count", "http_status_code", "success", "message"]
    for part_lines in (1, 7, 1000):
        root = str(tmp_path / f"packed{part_lines}")
        _packed(spark, root, bodies, part_lines)
        for most in (1, landing.LOGGED_ERRORS):
            log = landing.request_log_by_part(landing.packed_requests(spark, root), most)
            whole = landing.request_log(landing.read_request_files(spark, root), most)
            got = {r.request_id: tuple(r) for r in log.select(*names).collect()}
            assert got == {r.request_id: tuple(r) for r in whole.select(*names).collect()} and set(got) == set(bodies)
            assert got["d"][4] == 40 and got["d"][7].count("Line") == most and got["s"][3:5] == (30, 28)
    # with a row a request no line is shuffled, and each is checked once, also under a filter on the outcome
    log = landing.read_request_log(spark, root, landing.with_credentials)
    plan = log.filter("success").select("record_count", "message")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("FileScan") == 1 and plan.count("parseJson") == 1
    assert "cookie" not in log.first().request_headers


def test_s1_lines_end_at_plain_and_at_windows_line_ends(spark, tmp_path):
    root = str(tmp_path / "packed")
    _packed(spark, root, {"w": '{"a":1}\r\n  \r\n{bad\r\n', "u": '{"a":1}\n  \n{bad\n', "m": '{"a":1}\n \r\n{bad\r'}, 1000)
    lines = {(r.request_id, r.line_no): r.line for r in landing.read_request_lines(spark, root).collect()}
    assert lines == {("w", 1): '{"a":1}', ("w", 2): "{bad", ("u", 1): '{"a":1}', ("u", 2): "{bad", ("m", 1): '{"a":1}', ("m", 2): "{bad\r"}
    plan = landing.read_request_lines(spark, root)._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains" in plan  # the expression only where a body has such a line end


def test_request_files_are_landed_in_one_shuffle_without_the_stored_bronze(spark, tmp_path):
    from vitalake.plans import registry
    from vitalake.sources.bronze_store import _exists, bronze_path_for
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").write.parquet(str(tmp_path / "events.parquet"))
    path = registry._landing(spark, str(tmp_path))
    assert _exists(spark, f"{path}/_SUCCESS") and not _exists(spark, bronze_path_for(spark, str(tmp_path)))
    assert "Exchange hashpartitioning(record_type" in _written(spark, lambda: landing.land_request_files(registry.bronze_from_dir(spark, str(tmp_path)), str(tmp_path / "r")))


def test_w4_newest_requests_read_no_body(spark, tmp_path):
    from vitalake.plans import registry
    root = str(tmp_path / "packed")
    _packed(spark, root, {"a": "{}\n", "b": "{}\n{}\n"}, 1)
    newest = registry._newest_requests(spark, root)
    assert "payload" not in newest._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in newest.collect()] == [("samples", "b")]


def _written(spark, write) -> str:
    """The plan of the only query that ``write`` runs."""
    plans = []
    from pyspark.sql import DataFrameWriter
    was = DataFrameWriter.parquet

    def parquet(self, *a, **b):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString())
        return was(self, *a, **b)
    DataFrameWriter.parquet = parquet
    try:
        write()
    finally:
        DataFrameWriter.parquet = was
    assert len(plans) == 1 and plans[0].count("Exchange") == 1
    return plans[0]
