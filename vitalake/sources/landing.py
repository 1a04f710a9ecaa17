"""NDJSON landing into bronze, and the table chores around it.

A *request* is one NDJSON payload with its headers:
``(request_id string, received_at timestamp, headers map<string,string>,
payload string)`` -- read from landed files (one file = one request body,
headers from the path) or built by a caller.  The HTTP route's rules are
applied as column expressions:

* S1 ``parse_requests`` -- split on ``\\r?\\n``, drop blank lines, number the
  rest, ``try_parse_json`` each; bad lines become ``Line N: invalid JSON``
  errors.  The HTTP route's line and size limits protect a server; landed data
  is never dropped for its size, so they are options, off by default;
* S3 header blocklist, S4 user from headers, S5 per-line ``demo_user_id``
  override, S6 record type from ``x-record-type`` (lower/trim, non-empty);
* S2 ``build_bronze`` -- the 7-column row; ``record_id`` is sha256 of
  (request, line) so replaying a landed file never duplicates it.

Every line carries its request's columns through the explode: building
bronze is one scan without a shuffle.  A file up to ``WHOLE_FILE`` bytes is read
as one row; a longer one (a compacted file) is read line by line and numbered
from counts by block, so no task holds it whole.

A folder per request costs a listing each, which at some hundred thousand requests
takes longer than all the work on them.  So the readers also take *packed* requests:
parquet files of many requests each, the same ``x_*`` values as columns, the raw
body in rows of at most ``PART_LINES`` lines (``land_request_files``).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import CHANNEL_REST
from ..schemas import BLOCKED_HEADERS, BRONZE_COLUMNS, KNOWN_RECORD_TYPES

# Fixed values (must equal the reference).
MAX_NDJSON_LINES = 10000
MAX_REQUEST_BYTES = 10 * 1024 * 1024
DEMO_USER_KEY = "demo_user_id"
#: files up to this many bytes are read as one row each
WHOLE_FILE = 64 * 1024 * 1024
#: lines of a body that one row of packed requests holds at most
PART_LINES = 1000
#: parse errors that a request's log message quotes
LOGGED_ERRORS = 20
REQUEST_SCHEMA = "request_id string, received_at timestamp, headers map<string,string>, payload string"


# --- S3, S4, S6 --------------------------------------------------------------

def strip_headers(headers: Column) -> Column:
    """S3: drop credential headers (keys compared lower-case)."""
    return F.map_filter(headers, lambda k, v: ~F.lower(k).isin(BLOCKED_HEADERS) & v.isNotNull())


def resolve_user(headers: Column) -> Column:
    """Bearer token -> ``anonymous`` (no validation yet); else
    ``x-forwarded-email``; else ``anonymous``."""
    auth = F.try_element_at(headers, F.lit("authorization"))
    email = F.try_element_at(headers, F.lit("x-forwarded-email"))
    return (F.when(auth.startswith("Bearer "), F.lit("anonymous"))
            .when(email.isNotNull() & (F.length(email) > 0), email)
            .otherwise(F.lit("anonymous")))


def record_type_of(headers: Column) -> Column:
    """lower/trim of ``x-record-type``; NULL when missing or empty."""
    rt = F.lower(F.trim(F.try_element_at(headers, F.lit("x-record-type"))))
    return F.when(F.length(rt) > 0, rt)


def platform_of(headers: Column) -> Column:
    p = F.lower(F.try_element_at(headers, F.lit("x-platform")))
    return F.when(F.length(p) > 0, p).otherwise(F.lit("unknown"))


# --- S1 ------------------------------------------------------------------------

def _lines(payload: Column) -> Column:
    text = F.coalesce(payload, F.lit(""))
    # a plain separator is found several times faster than an expression
    lines = F.when(F.contains(text, F.lit("\r")), F.split(text, "\r?\n")).otherwise(F.split(text, "\n"))
    return F.filter(lines, lambda l: F.length(F.trim(l)) > 0)


def request_lines(requests: DataFrame) -> DataFrame:
    """The non-blank lines of each request, numbered from 1, with the request's columns."""
    each = requests.select("request_id", "received_at", "headers", F.posexplode(_lines(F.col("payload"))).alias("_pos", "line"))
    return each.select("request_id", "received_at", "headers", (F.col("_pos") + 1).cast("int").alias("line_no"), "line")


def parse_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good lines with ``body``, errors) of numbered request lines."""
    each = lines.withColumn("body", F.try_parse_json("line")).drop("line")
    good = each.filter(F.col("body").isNotNull())
    bad = each.filter(F.col("body").isNull()).select(
        "request_id", "line_no", F.format_string("Line %d: invalid JSON", F.col("line_no")).alias("message"))
    return good, bad


def parse_requests(requests: DataFrame, max_lines: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(good lines, errors).  Good: request_id, received_at, headers,
    line_no, body (VARIANT).  Errors: request_id, line_no (NULL for
    request-level), message.  ``max_lines``: the HTTP route's limit; a request
    over it is rejected whole and reported."""
    if max_lines is None:
        return parse_lines(request_lines(requests))
    n = F.size(_lines(F.col("payload")))
    over = requests.filter(n > max_lines).select(
        "request_id", F.lit(None).cast("int").alias("line_no"),
        F.format_string(f"Too many NDJSON lines (%d). Maximum allowed is {max_lines}.", n).alias("message"))
    good, bad = parse_lines(request_lines(requests.filter(n <= max_lines)))
    return good, over.unionByName(bad)


# --- S5, S2 ------------------------------------------------------------------------

def override_user(body: Column, default_user: Column) -> tuple[Column, Column]:
    """A non-blank string ``demo_user_id`` becomes the user (trimmed, whole)
    and is removed from the body; other bodies pass unchanged."""
    raw = F.try_variant_get(body, f"$.{DEMO_USER_KEY}", "variant")
    is_str = F.schema_of_variant(raw) == F.lit("STRING")
    txt = F.trim(F.try_variant_get(raw, "$", "string"))
    use = raw.isNotNull() & is_str & (F.length(txt) > 0)
    user = F.when(use, txt).otherwise(default_user)
    as_map = F.try_variant_get(body, "$", "map<string,variant>")
    new_body = F.when(use, F.to_variant_object(F.map_filter(as_map, lambda k, _v: k != F.lit(DEMO_USER_KEY)))
                      ).otherwise(body)
    return new_body, user


def build_bronze(good: DataFrame) -> DataFrame:
    """S2 (+S3-S6): bronze rows for every good line of an accepted request
    (a request needs a record type; unknown types are landed and flagged by
    ``flag_unknown_type``).  One projection over the lines: no join, no shuffle."""
    headers = F.col("headers")
    rows = good.select(
        "request_id", "received_at", "line_no", "body", record_type_of(headers).alias("record_type"),
        platform_of(headers).alias("source_platform"), resolve_user(headers).alias("_user"),
        F.map_concat(F.map_filter(strip_headers(headers), lambda k, _v: k != F.lit("x-ingest-channel")),
                     F.create_map(F.lit("x-ingest-channel"), F.lit(CHANNEL_REST))).alias("_headers"),
    ).filter(F.col("record_type").isNotNull())
    body, user = override_user(F.col("body"), F.col("_user"))
    return rows.select(
        F.sha2(F.concat_ws(":", F.col("request_id"), F.col("line_no").cast("string")), 256).alias("record_id"),
        F.col("received_at").alias("ingested_at"), body.alias("body"),
        F.to_variant_object(F.col("_headers")).alias("headers"), "record_type", "source_platform",
        user.alias("user_id"),
    ).select(*BRONZE_COLUMNS)


def flag_unknown_type(bronze: DataFrame) -> DataFrame:
    """Mark record types outside the five known ones (kept, not dropped)."""
    return bronze.withColumn("is_known_type", F.col("record_type").isin(KNOWN_RECORD_TYPES))


# Fixed values (must equal the reference): messages of rejected requests.
NO_TYPE = "Missing X-Record-Type header"
EMPTY_BODY = "Request body is empty"
NO_RECORDS = "No valid records found in request body."
ONLY_ERRORS = "No valid records found. Parse errors: "


def _outcome(record_type: Column, empty: Column, good: Column, bad: Column, quoted: Column) -> tuple[Column, Column]:
    """Status and message of a request."""
    status = F.when(record_type.isNull() | empty | (good == 0), F.lit(400)).otherwise(F.lit(200))
    message = (F.when(record_type.isNull(), F.lit(NO_TYPE)).when(empty, F.lit(EMPTY_BODY))
               .when(good == 0, F.when(bad > 0, F.concat(F.lit(ONLY_ERRORS), quoted)).otherwise(F.lit(NO_RECORDS)))
               .otherwise(F.when(bad > 0, quoted)))
    return status, message


def request_log(requests: DataFrame, max_errors: int = LOGGED_ERRORS) -> DataFrame:
    """Per-request outcome (the sync/ingest log) with the payload: record_count,
    error_count, status, message.  Computed inside each request's row, so no shuffle;
    the message quotes the first ``max_errors`` errors, ``error_count`` has them all.
    For requests that fit a row; ``request_log_by_line`` has no such limit."""
    payload = F.coalesce(F.col("payload"), F.lit(""))
    checked = F.transform(_lines(payload), lambda l, i: F.struct((i + 1).alias("n"), F.try_parse_json(l).isNull().alias("bad")))
    r = requests.withColumn("_lines", checked)
    r = r.withColumn("_bad", F.filter("_lines", lambda x: x["bad"]))
    n, bad, rt = F.size("_lines") - F.size("_bad"), F.size("_bad"), record_type_of(F.col("headers"))
    quoted = F.array_join(F.transform(F.slice("_bad", 1, max_errors), lambda x: F.format_string("Line %d: invalid JSON", x["n"])), "; ")
    status, message = _outcome(rt, F.length(payload) == 0, n, bad, quoted)
    return r.select("request_id", rt.alias("record_type"), F.col("received_at").alias("timestamp"),
                    n.cast("int").alias("record_count"), bad.alias("error_count"), status.alias("http_status_code"),
                    (status == 200).alias("success"), message.alias("message"),
                    F.col("payload").alias("ndjson_payload"), strip_headers(F.col("headers")).alias("request_headers"))


def request_log_by_line(requests: DataFrame, lines: DataFrame, max_errors: int = LOGGED_ERRORS) -> DataFrame:
    """``request_log`` without the payload, from numbered lines: no request is held as a row, whatever its size.

    ``requests``: ``request_id, received_at, headers, bytes``, a row a request, also for those without
    a line.  Lines are reduced to counts before they are shuffled; of the errors only the first
    ``max_errors`` of a request travel (a row number with that limit, applied map-side first)."""
    checked = lines.select("request_id", "line_no", F.try_parse_json("line").isNull().alias("bad"))
    counts = checked.groupBy("request_id").agg(F.count_if(~F.col("bad")).alias("_good"), F.count_if(F.col("bad")).alias("_bad"))
    first = Window.partitionBy("request_id").orderBy("line_no")
    errors = (checked.filter("bad").select("request_id", "line_no", F.row_number().over(first).alias("_rn")).filter(F.col("_rn") <= max_errors)
              .groupBy("request_id").agg(F.array_sort(F.collect_list("line_no")).alias("_first")))
    return _log_rows(requests.join(counts, "request_id", "left").join(errors, "request_id", "left"))


def _log_rows(r: DataFrame) -> DataFrame:
    """The log's columns from ``request_id, received_at, headers, bytes``, the counts ``_good`` and ``_bad`` and the first bad lines ``_first``."""
    n, bad = F.coalesce("_good", F.lit(0)), F.coalesce("_bad", F.lit(0))
    rt = record_type_of(F.col("headers"))
    quoted = F.array_join(F.transform("_first", lambda k: F.format_string("Line %d: invalid JSON", k)), "; ")
    status, message = _outcome(rt, F.col("bytes") == 0, n, bad, quoted)
    return r.select("request_id", rt.alias("record_type"), F.col("received_at").alias("timestamp"), n.cast("int").alias("record_count"),
                    bad.cast("int").alias("error_count"), status.alias("http_status_code"), (status == 200).alias("success"), message.alias("message"),
                    strip_headers(F.col("headers")).alias("request_headers"))


def _checked_parts(parts: DataFrame, columns: list, max_errors: int) -> DataFrame:
    """``columns`` with the counts of good and bad lines of each part, and the numbers in it of its first ``max_errors`` bad ones."""
    names = parts.select(*columns).columns
    split = parts.select(*columns, _lines(F.col("payload")).alias("_lines"))
    bad = F.filter(F.transform("_lines", lambda l, i: F.when(F.try_parse_json(l).isNull(), i + 1)), lambda k: k.isNotNull())
    # a generated row: a filter on the log is not pushed below it, where it would check every line once more
    found = split.select(*names, F.inline(F.array(F.struct(F.size("_lines").alias("_n"), bad.alias("_found")))))
    return found.select(*names, (F.col("_n") - F.size("_found")).cast("bigint").alias("_good"), F.size("_found").cast("bigint").alias("_bad"),
                        F.slice("_found", 1, max_errors).alias("_first"))


def request_log_by_part(packed: DataFrame, max_errors: int = LOGGED_ERRORS, headers_of=None) -> DataFrame:
    """``request_log_by_line`` of packed requests, in one pass: the lines of a part (at most ``PART_LINES`` of them) are
    checked inside its row, so only the counts of requests of several parts are shuffled, and no line is.
    ``headers_of`` completes the headers first (``with_credentials``)."""
    out = _checked_parts(packed.filter("parts = 1"), [*_request_columns(packed), "bytes"], max_errors)
    many = _in_parts(packed)
    if many is not None:
        keys = [c for c in packed.columns if c.startswith("x_")]
        each = _checked_parts(many, [*keys, "bytes", "part"], max_errors)
        before = Window.partitionBy(*keys).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        earlier = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
        each = each.withColumns({"_before": earlier(F.col("_good") + F.col("_bad")), "_quoted": earlier(F.col("_bad"))})
        numbers = F.transform("_first", lambda k: (k + F.col("_before")).cast("int"))
        # a part after max_errors bad lines has none to quote: at most max_errors parts are collected
        quotes = F.when((F.col("_bad") > 0) & (F.col("_quoted") < max_errors), F.struct("part", numbers.alias("at")))
        whole = each.groupBy(*keys, "bytes").agg(F.sum("_good").alias("_good"), F.sum("_bad").alias("_bad"), F.sort_array(F.collect_list(quotes)).alias("_parts"))
        out = out.unionByName(whole.select(*_request_columns(whole), "bytes", "_good", "_bad", F.slice(F.flatten("_parts.at"), 1, max_errors).alias("_first")))
    return _log_rows(headers_of(out) if headers_of else out)


def _exists_success(spark: SparkSession, path: str) -> bool:
    from .bronze_store import _exists
    return _exists(spark, f"{path.rstrip('/')}/_SUCCESS")


# --- reading landed request files ---------------------------------------------

def _request_columns(files: DataFrame) -> list[Column]:
    """Id, time and headers of a request from its path: ``x_request=<id>`` and
    ``x_received=<yyyyMMddHHmmss>`` where the path has them (else a hash of the
    path, and the file's time); every other ``x_*`` directory is a header."""
    names = files.columns
    request_id = F.col("x_request").cast("string") if "x_request" in names else F.sha2(F.col("_metadata.file_path"), 256)
    received = (F.to_timestamp(F.col("x_received").cast("string"), "yyyyMMddHHmmss") if "x_received" in names
                else F.col("_metadata.file_modification_time"))
    pairs = [x for c in names if c.startswith("x_") and c not in ("x_request", "x_received")
             for x in (F.lit(c.replace("_", "-")), F.col(c).cast("string"))]
    return [request_id.alias("request_id"), received.alias("received_at"),
            F.create_map(*pairs, F.lit("content-type"), F.lit("application/x-ndjson")).alias("headers")]


def packed_requests(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows of packed requests (``x_*`` values, ``part`` of ``parts``, ``bytes`` of the whole body, ``payload`` of
    this part); None for a tree of request files."""
    from .bronze_store import _fs
    fs, pattern = _fs(spark, f"{path.rstrip('/')}/*.parquet")
    return spark.read.parquet(path) if fs.globStatus(pattern) else None


def _in_parts(packed: DataFrame) -> DataFrame | None:
    """The rows of requests of several parts; None where there are none (read from one small column)."""
    many = packed.filter("parts > 1")
    return None if many.select("parts").isEmpty() else many


def read_request_files(spark: SparkSession, path: str, max_bytes: int | None = None) -> DataFrame:
    """Request bodies landed as files under ``.../x_record_type=<t>/x_platform=<p>/``
    (one file = one request) or packed: one request of one row.  Nothing is left out
    for its size unless ``max_bytes`` asks for the HTTP route's limit
    (``oversized_request_files`` lists what it rejects)."""
    t = packed_requests(spark, path)
    if t is not None:
        if max_bytes is not None:
            t = t.filter(F.col("bytes") <= max_bytes)
        whole, many = t.filter("parts = 1").select(*_request_columns(t), "payload"), _in_parts(t)
        if many is None:
            return whole
        body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "payload"))), lambda p: p["payload"]), "")
        many = many.groupBy(*[c for c in t.columns if c.startswith("x_")]).agg(body.alias("payload"))
        return whole.unionByName(many.select(*_request_columns(many), "payload"))
    t = spark.read.text(path, wholetext=True)
    if max_bytes is not None:
        t = t.filter(F.col("_metadata.file_size") <= max_bytes)
    return t.select(*_request_columns(t), F.col("value").alias("payload"))


def list_requests(spark: SparkSession, path: str) -> DataFrame:
    """``request_id, received_at, headers, bytes`` of all request files, from file metadata only (the contents are
    pruned from the scan, also of packed requests)."""
    packed = packed_requests(spark, path)
    if packed is not None:
        return packed.filter("part = 0").select(*_request_columns(packed), "bytes")
    files = spark.read.format("binaryFile").load(path)
    return files.select(*_request_columns(files), F.col("length").alias("bytes"))


def read_request_lines(spark: SparkSession, path: str, whole_bytes: int = WHOLE_FILE) -> DataFrame:
    """Numbered lines of all request files (as ``request_lines``).  Files over
    ``whole_bytes`` are read by line: the rows of a block are numbered in their
    own order and offset by the counts of the file's earlier blocks; likewise the
    parts of a packed request."""
    packed = packed_requests(spark, path)
    if packed is not None:
        return _packed_lines(packed)
    lines = request_lines(read_request_files(spark, path, whole_bytes))
    if oversized_request_files(spark, path, whole_bytes).isEmpty():
        return lines
    t = spark.read.option("lineSep", "\n").text(path).filter(F.col("_metadata.file_size") > whole_bytes)
    rows = t.filter(F.length(F.trim(F.regexp_replace("value", "\r$", ""))) > 0).select(
        *_request_columns(t), F.regexp_replace("value", "\r$", "").alias("line"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))
    blocks = rows.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    large = rows.join(blocks, ["_file", "_block"]).select(
        "request_id", "received_at", "headers", (F.col("_before") + F.col("_row") - F.col("_first") + 1).cast("int").alias("line_no"), "line")
    return lines.unionByName(large)


def _packed_lines(packed: DataFrame) -> DataFrame:
    lines, many = request_lines(packed.filter("parts = 1").select(*_request_columns(packed), "payload")), _in_parts(packed)
    if many is None:
        return lines
    # one text key: a missing header is a value like any other
    many = many.withColumn("_k", F.to_json(F.struct(*[c for c in packed.columns if c.startswith("x_")])))
    before = Window.partitionBy("_k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = many.select("_k", "part", F.size(_lines(F.col("payload"))).alias("_n"))
    parts = many.join(counts.select("_k", "part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")), ["_k", "part"])
    rows = parts.select(*_request_columns(parts), "_before", F.posexplode(_lines(F.col("payload"))).alias("_pos", "line"))
    return lines.unionByName(rows.select("request_id", "received_at", "headers", (F.col("_before") + F.col("_pos") + 1).cast("int").alias("line_no"), "line"))


def read_request_log(spark: SparkSession, path: str, headers_of=None) -> DataFrame:
    """The log of all request files: by part where they are packed, else by line."""
    packed = packed_requests(spark, path)
    if packed is not None:
        return request_log_by_part(packed, headers_of=headers_of)
    requests = list_requests(spark, path)
    return request_log_by_line(headers_of(requests) if headers_of else requests, read_request_lines(spark, path))


def oversized_request_files(spark: SparkSession, path: str, max_bytes: int = MAX_REQUEST_BYTES) -> DataFrame:
    """Request files over the limit, listed from file metadata only (the
    ``binaryFile`` source prunes the content column)."""
    if packed_requests(spark, path) is not None:
        return (list_requests(spark, path).filter(F.col("bytes") > max_bytes)
                .select("request_id", "received_at", "bytes", F.lit(f"Payload too large (limit {max_bytes} bytes)").alias("message")))
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return (files.filter(F.col("length") > max_bytes)
            .select(F.sha2(F.col("path"), 256).alias("request_id"), F.col("modificationTime").alias("received_at"),
                    F.col("length").alias("bytes"),
                    F.lit(f"Payload too large (limit {max_bytes} bytes)").alias("message")))


# --- S16, S17: writing NDJSON ---------------------------------------------------

def ndjson_line(df: DataFrame, columns: list[str] | None = None) -> Column:
    """One JSON object per row, keys sorted, NULL fields omitted."""
    cols = sorted(columns or df.columns)
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def _range_marks(column: DataFrame, parts: int) -> list:
    """At most ``parts - 1`` values that cut a column into ranges of about equal size, from a sample of a
    bounded expected size (any marks give the same numbering)."""
    known = column.filter(F.col(column.columns[0]).isNotNull())
    total = known.count()
    held = sorted(r[0] for r in known.sample(min(1.0, 20.0 * parts / max(total, 1)), 7).collect())
    return sorted({held[len(held) * k // parts] for k in range(1, parts)}) if held else []


def batch_chunks(df: DataFrame, size: int, by: str = "record_type", order: str = "ingested_at",
                 bucket_seconds: int = 60, splits: int = 64) -> DataFrame:
    """Number records into batches of ``size`` per ``by`` group:
    ``batch_no = floor((rn - 1) / size)`` with ``rn`` the row number in
    ``order`` within the group.

    ``by`` has a handful of values (five record types), so one window over
    a group would put a fifth of the data in one task.  Instead the row
    number is computed per (group, time bucket, range of the tie-break column)
    and offset by the row count of what precedes it (a running sum over one row
    per such part); the result equals the single-window numbering.  The ranges,
    ``splits`` of them by sampled quantiles of the tie-break column, keep a bulk
    load that shares one time stamp from being one task's work."""
    rest = [c for c in df.columns if c not in (by, order)]
    at = F.coalesce(F.unix_micros(F.col(order)), F.lit(-(1 << 62)))  # NULL times come first
    minute = F.floor(at / F.lit(bucket_seconds * 1_000_000))
    key = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit(""))
    d = df.withColumns({"_k": key, "_b": minute})
    windows = ["_k", "_b"]
    if rest:
        tie = F.col(rest[0])
        # (time, range of the tie-break) keeps the order; NULL comes first
        marks = _range_marks(df.select(tie), splits)
        part = F.coalesce(sum(((tie >= F.lit(m)).cast("int") for m in marks), F.lit(0)), F.lit(-1))
        d = d.withColumns({"_t": at, "_s": part})
        windows = ["_k", "_b", "_t", "_s"]
    order_by = [F.col(order), *[F.col(c) for c in rest[:1]]]
    d = d.withColumn("_rn", F.row_number().over(Window.partitionBy(*windows).orderBy(*order_by)))
    counts = d.groupBy(*windows).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy("_k").orderBy(*windows[1:]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return (d.join(counts, windows).withColumn("batch_no", F.floor((F.col("_before") + F.col("_rn") - 1) / F.lit(size)).cast("bigint"))
            .select(*df.columns, "batch_no"))


def write_ndjson(df: DataFrame, path: str, partition_by: list[str] | None = None,
                 max_records_per_file: int | None = None, columns: list[str] | None = None) -> None:
    """S16 (+S17 files): NDJSON text files, optionally partitioned (header
    values in the path) and capped at ``max_records_per_file`` lines."""
    parts = partition_by or []
    out = df.select(*parts, ndjson_line(df, [c for c in (columns or df.columns) if c not in parts]).alias("value"))
    w = out.write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if parts:
        w = w.partitionBy(*parts)
    w.text(path)


# --- S8, S9, S11, S12, S15 -------------------------------------------------------

def append_json_staging(staged: DataFrame, path: str, body_col: str = "body_json",
                        headers_col: str = "headers_json") -> DataFrame:
    """Staged JSON strings -> parsed VARIANT columns, appended to bronze."""
    rows = staged.select(*[c for c in BRONZE_COLUMNS if c not in ("body", "headers")],
                         F.parse_json(body_col).alias("body"), F.parse_json(headers_col).alias("headers"))
    rows = rows.select(*BRONZE_COLUMNS)
    rows.write.mode("append").partitionBy("record_type").parquet(path)
    return rows


def replace_rows(spark: SparkSession, path: str, predicate: Column, new_rows: DataFrame) -> int:
    """Delete the rows matching ``predicate`` and append ``new_rows``.

    The record types touched by either are rewritten to a staging table of
    their own, which is then swapped in partition by partition (a rename each);
    a type left without rows loses its partition.  No session setting changes.
    Returns the number of rows removed."""
    import uuid

    from .bronze_store import _fs, read_bronze
    current = read_bronze(spark, path)
    matches = F.coalesce(predicate, F.lit(False))
    removed = current.filter(matches).count()
    touched = {r.record_type for r in (current.filter(matches).select("record_type")
                                       .unionByName(new_rows.select("record_type")).distinct().collect())}  # one row a type
    if not touched:
        return removed
    of_touched = F.col("record_type").isin([t for t in touched if t is not None])
    if None in touched:
        of_touched = of_touched | F.col("record_type").isNull()
    out = current.filter(of_touched & ~matches).unionByName(new_rows.select(*BRONZE_COLUMNS))
    root = path.rstrip("/")
    staging = f"{root}.replace-{uuid.uuid4().hex}"
    out.write.partitionBy("record_type").parquet(staging)
    fs, base = _fs(spark, root)
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = {f.getPath().getName() for d in (root, staging) for f in fs.listStatus(make(d)) if f.getPath().getName().startswith("record_type=")}
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for t in touched:
        name = escape("record_type", t)
        if name not in names:
            continue
        old, new = make(f"{root}/{name}"), make(f"{staging}/{name}")
        if fs.exists(old):
            fs.rename(old, make(f"{staging}/_old-{name}"))
        if fs.exists(new):
            fs.rename(new, old)
    fs.delete(make(staging), True)
    spark.catalog.refreshByPath(root)
    return removed


def backfill_days(spark: SparkSession, start: str, end: str, landed: DataFrame, day_col: str = "date") -> DataFrame:
    """Expected days of ``[start, end)`` (error when start >= end) and the
    days with no landed rows -- one job over ``sequence``, a left anti join."""
    s, e = _dt.date.fromisoformat(start), _dt.date.fromisoformat(end)
    if s >= e:
        raise ValueError(f"start {start} must be before end {end}")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(s), F.date_sub(F.lit(e), 1))).alias("day"))
    have = landed.select(F.try_to_date(F.col(day_col)).alias("day")).distinct()
    return days.join(have, "day", "left_anti").withColumnRenamed("day", "missing_day")


BRONZE_DDL = ("record_id STRING NOT NULL, ingested_at TIMESTAMP, body VARIANT, headers VARIANT, "
              "record_type STRING, source_platform STRING, user_id STRING")


def create_bronze(spark: SparkSession, table: str, location: str | None = None) -> None:
    """Idempotent bronze DDL (parquet, partitioned by record_type)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({BRONZE_DDL}) USING parquet PARTITIONED BY (record_type){loc}")


def evolve_bronze(spark: SparkSession, table: str, columns: dict[str, str]) -> None:
    """Additive evolution -- new columns only, old rows read NULL."""
    have = {f.name for f in spark.table(table).schema.fields}
    add = [f"{c} {t}" for c, t in columns.items() if c not in have]
    if add:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(add)})")


def union_evolving(frames: list[DataFrame]) -> DataFrame:
    """S12 read side: union of frames with differing column sets."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# The objects the medallion publishes (S15), dropped in order.
PUBLISHED_VIEWS = ["vw_activity_last_45d", "vw_sleep_last_30_sessions", "vw_workouts_recent"]
PUBLISHED_GOLD = ["gold_hk_quantity_daily", "gold_subject_daily", "gold_daily_steps", "gold_activity_enriched_daily",
                  "gold_sleep_nightly", "gold_weekly_workout_summary", "gold_cardio_vitals_daily",
                  "gold_heart_rate_intraday_daily", "gold_bronze_ingest_daily", "gold_hk_family_weekly"]
PUBLISHED_SILVER = ["silver_events", "silver_samples", "silver_workouts", "silver_sleep_stages",
                    "silver_activity_ring_daily", "silver_deletes"]
PUBLISHED_BRONZE = ["bronze_stream"]


def drop_medallion(spark: SparkSession, schema: str | None = None) -> list[str]:
    """Drop views, gold, silver, then the bronze stream table."""
    prefix = f"{schema}." if schema else ""
    stmts = [f"DROP VIEW IF EXISTS {prefix}{v}" for v in PUBLISHED_VIEWS]
    stmts += [f"DROP TABLE IF EXISTS {prefix}{t}" for t in PUBLISHED_GOLD + PUBLISHED_SILVER + PUBLISHED_BRONZE]
    for s in stmts:
        spark.sql(s)
    return stmts


def publish(spark: SparkSession, frames: dict[str, DataFrame], views: dict[str, DataFrame] | None = None,
            schema: str | None = None) -> None:
    """Write gold tables (overwrite) and publish views."""
    prefix = f"{schema}." if schema else ""
    for name, df in frames.items():
        df.write.mode("overwrite").saveAsTable(f"{prefix}{name}")
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)


# --- request files derived from a bronze table (used by the registry) ---------

def land_request_files(bronze: DataFrame, path: str, rows_per_request: int = 200, part_lines: int = PART_LINES) -> None:
    """Write a bronze table back out as packed NDJSON requests under a stated id
    and time: the events ``200 b`` to ``200 b + 199`` of a record type are request
    ``<type>-<b>``, received ``b`` minutes into 2024-02-01.  A line per document
    with its user as ``demo_user_id`` (blank for every 40th event, so the header
    fallback applies), a malformed line after every 25th and a blank line after
    every 30th.  The last event of each request is also sent alone and malformed
    (``<type>-<b>-x``, 30 seconds later): a request that is rejected whole.
    ``x_auth`` names the caller's credentials: token, email or none.  The number of
    files follows the bytes, not the requests; a body is cut into rows at line ends."""
    n = F.regexp_extract("record_id", "[0-9]+", 0).cast("bigint")
    rows = bronze.select("record_type", "source_platform", "record_id", "user_id", n.alias("n"), F.to_json("body").alias("json"))
    user = F.to_json(F.array(F.when(F.col("n") % 40 == 0, F.lit("  ")).otherwise(F.col("user_id"))))
    rows = rows.select("record_type", "source_platform", "record_id", "n", F.floor(F.col("n") / rows_per_request).cast("bigint").alias("b"),
                       user.alias("user"), F.expr("substring(json, 2)").alias("rest"))
    line = F.concat(F.lit('{"' + DEMO_USER_KEY + '":'), F.expr("substring(user, 2, length(user) - 2)"),
                    F.when(F.col("rest") != "}", F.lit(",")).otherwise(F.lit("")), F.col("rest"))
    # one shuffle, of a line an event: the lines added, the counts and the parts are all made behind it
    dealt = rows.select("record_type", "source_platform", "b", "n", "record_id", line.alias("line")).repartition("record_type", "source_platform", "b")
    n = F.col("n")
    kinds = F.array(F.lit(0), F.when(n % 25 == 0, F.lit(1)), F.when(n % 30 == 0, F.lit(2)), F.when(n % rows_per_request == rows_per_request - 1, F.lit(3)))
    out = dealt.select("record_type", "source_platform", "b", "n", "record_id", "line", F.explode(kinds).alias("i")).filter(F.col("i").isNotNull())
    value = F.when(F.col("i") == 0, F.col("line")).when(F.col("i") == 2, F.lit("   ")).otherwise(F.concat(F.lit("{bad "), n.cast("string")))
    out = out.select("record_type", "source_platform", "b", (F.col("i") == 3).alias("alone"), "n", "record_id", "i", F.concat(value, F.lit("\n")).alias("value"))
    request = ["record_type", "source_platform", "b", "alone"]
    whole = Window.partitionBy(*request)  # the lines of a request keep the events' order
    out = out.select(*request, "value", F.row_number().over(whole.orderBy("n", "record_id", "i")).alias("_rn"),
                     F.ceil(F.count(F.lit(1)).over(whole) / part_lines).cast("int").alias("parts"),
                     F.sum(F.octet_length("value")).over(whole).alias("bytes"))
    part = F.floor((F.col("_rn") - 1) / part_lines).cast("int").alias("part")
    body = F.sort_array(F.collect_list(F.struct("_rn", "value")))["value"]
    out = out.groupBy(*request, "parts", "bytes", part).agg(F.array_join(body, "").alias("payload"))
    seconds = F.col("b") * 60 + F.when(F.col("alone"), 30).otherwise(0)
    received = F.to_timestamp(F.lit("2024-02-01 00:00:00")) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    (out.select(
        F.col("record_type").alias("x_record_type"), F.col("source_platform").alias("x_platform"),
        F.concat("record_type", F.lit("-"), F.col("b").cast("string"), F.when(F.col("alone"), F.lit("-x")).otherwise(F.lit(""))).alias("x_request"),
        F.date_format(received, "yyyyMMddHHmmss").alias("x_received"),
        F.element_at(F.array(F.lit("token"), F.lit("email"), F.lit("none")), (F.col("b") % 3 + 1).cast("int")).alias("x_auth"),
        "parts", "bytes", "part", "payload")
     .write.mode("overwrite").option("compression", "zstd").parquet(path))


def with_credentials(requests: DataFrame) -> DataFrame:
    """The credential headers that ``x-auth`` stands for, and a cookie."""
    h = F.col("headers")
    auth = F.try_element_at(h, F.lit("x-auth"))
    own = F.create_map(F.lit("authorization"), F.when(auth == "token", F.lit("Bearer abc")),
                       F.lit("x-forwarded-email"), F.when(auth == "email", F.lit("sender@example.org")), F.lit("cookie"), F.lit("c=1"))
    rest = F.map_filter(h, lambda k, _v: k != F.lit("x-auth"))
    return requests.withColumn("headers", F.map_filter(F.map_concat(rest, own), lambda _k, v: v.isNotNull()))
