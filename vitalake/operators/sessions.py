"""Gap-based sleep sessionisation, exact and skew-safe.

Rule: per user, order samples by start; a sample opens a new session when
its start is more than ``gap`` after the *preceding sample's* end (not the
running maximum end).  Session = min start, max end and the ordered stages of
its samples.

A plain ``lag`` + running ``sum`` over ``Window.partitionBy(user)`` would
put one user's whole history in one task.  Instead the timeline is cut into
minutes and days (any sizes give the same result), so that even the one user
that all callers without credentials share is spread:

1. within (user, minute): which samples but the first open a session, and their
   running number -- window partitions bounded by one user-minute;
2. a row per (user, minute), from the same shuffle: its first start, last end,
   counts, and the place of its last opening sample; within (user, day) a window
   over these rows compares each minute with the one before;
3. a row per (user, day), likewise within the user: one row per day with data;
4. the sums before a day go back to its minutes, those before a minute to its
   samples: session number and place in the session are sums of three terms.

The key is one non-null text, so every step and join works on the same
partitioning: the samples are shuffled once, the other shuffles carry summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GAP_SECONDS = 30 * 60  # fixed value: 30-minute session gap


def sessionize(samples: DataFrame, user: str = "user_id", start: str = "start_at", end: str = "end_at",
               tie: str = "uuid", gap_seconds: int = GAP_SECONDS, bucket_seconds: int = 60, buckets: int = 1440) -> DataFrame:
    """Return ``samples`` with ``session_seq`` (1-based per user, a NULL user is a user like any other) and
    ``stage_no`` (1-based place in the session)."""
    columns = samples.columns

    def opens(at: Column, before: Column) -> Column:
        return F.unix_micros(at) - F.unix_micros(before) > F.lit(gap_seconds * 1_000_000)

    s = samples.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    s = s.withColumns({"_u": F.coalesce(F.concat(F.lit("="), F.col(user).cast("string")), F.lit("")),
                       "_m": F.floor(F.unix_seconds(F.col(start)) / F.lit(bucket_seconds))})
    order = [F.col(start), F.col(end), F.col(tie)]
    inside = Window.partitionBy("_u", "_m").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    s = s.withColumns({"_rn": F.row_number().over(inside), "_new": F.coalesce(opens(F.col(start), F.lag(end).over(inside)), F.lit(False)).cast("int")})
    s = s.withColumns({"_run": F.sum("_new").over(so_far), "_last": F.max(F.when(F.col("_new") == 1, F.col("_rn"))).over(so_far)})

    minutes = s.groupBy("_u", "_m").agg(
        F.min(start).alias("_first"), F.max_by(F.col(end), F.struct(*order)).alias("_end"), F.sum("_new").alias("_opened"),
        F.count(F.lit(1)).alias("_n"), F.max("_last").alias("_pos"))
    minutes = minutes.withColumn("_d", F.floor(F.col("_m") / F.lit(buckets)))
    minutes = _before(minutes, ["_u", "_d"], "_m", opens, F.lit(0))

    days = minutes.groupBy("_u", "_d").agg(
        F.min("_first").alias("_first"), F.max_by("_end", "_m").alias("_end"), F.sum(F.col("_opened") + F.col("_head")).alias("_opened"),
        F.sum("_n").alias("_n"), F.max("_own").alias("_pos"))
    # a user's first sample opens the first session
    days = _before(days, ["_u"], "_d", opens, F.lit(1)).select(
        "_u", "_d", F.col("_head").alias("_day_head"), F.col("_sessions").alias("_day_sessions"), F.col("_rows").alias("_day_rows"), F.col("_carry").alias("_day_carry"))

    # the first minute of a day opens a session if its day does
    j = minutes.join(days, ["_u", "_d"])
    head = F.col("_is_first") & (F.col("_day_head") == 1)
    minutes = j.select(
        "_u", "_m", (F.col("_sessions") + F.col("_day_sessions")).alias("_sessions"), (F.col("_rows") + F.col("_day_rows")).alias("_rows"),
        F.when((F.col("_head") == 1) | head, F.col("_rows") + F.col("_day_rows") + 1)
        .otherwise(F.coalesce(F.col("_carry") + F.col("_day_rows"), F.when(F.col("_day_head") == 1, F.col("_day_rows") + 1), F.col("_day_carry"))).alias("_open"))
    out = s.join(minutes, ["_u", "_m"])
    place = F.col("_rows") + F.col("_rn")
    return out.select(*columns, (F.col("_sessions") + F.col("_run")).cast("bigint").alias("session_seq"),
                      (place - F.coalesce(F.col("_rows") + F.col("_last"), F.col("_open")) + 1).cast("bigint").alias("stage_no"))


def _before(rows: DataFrame, keys: list[str], at: str, opens, if_first: Column) -> DataFrame:
    """What precedes each summary row within ``keys``: ``_head`` (1: its first sample opens a session), ``_sessions``
    (opened up to that first sample), ``_rows`` (samples before it), ``_carry`` (place of the last opening
    sample before it) and ``_own`` (place of the last one up to its end)."""
    w = Window.partitionBy(*keys).orderBy(at)
    earlier, so_far = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(Window.unboundedPreceding, 0)
    prior = F.lag("_end").over(w)
    rows = rows.withColumns({"_is_first": prior.isNull(), "_head": F.when(prior.isNull(), if_first).otherwise(opens(F.col("_first"), prior).cast("int")),
                             "_rows": F.coalesce(F.sum("_n").over(earlier), F.lit(0))})
    rows = rows.withColumn("_own", F.coalesce(F.col("_rows") + F.col("_pos"), F.when(F.col("_head") == 1, F.col("_rows") + 1)))
    return rows.withColumns({"_sessions": F.coalesce(F.sum("_opened").over(earlier), F.lit(0)) + F.sum("_head").over(so_far),
                             "_carry": F.max("_own").over(earlier)})


def sleep_sessions(samples: DataFrame, user: str = "user_id", start: str = "start_at", end: str = "end_at",
                   tie: str = "uuid", gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Session rows: user, session_seq, session_start_at, session_end_at, stage_count."""
    tagged = sessionize(samples.select(user, start, end, tie), user, start, end, tie, gap_seconds)
    return (tagged.groupBy(user, "session_seq")
            .agg(F.min(start).alias("session_start_at"), F.max(end).alias("session_end_at"),
                 F.count(F.lit(1)).alias("stage_count")))


def session_stages(samples: DataFrame, user: str = "user_id", start: str = "start_at", end: str = "end_at",
                   tie: str = "uuid", stage: str = "sleep_stage", gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """The ordered stages of every session, a row each: ``stage_no`` is the place in the session (a session of
    the shared user can hold any number of stages, so they are not gathered into one value)."""
    tagged = sessionize(samples.select(user, start, end, tie, stage), user, start, end, tie, gap_seconds)
    return tagged.select(user, "session_seq", "stage_no", F.col(stage).alias("stage"), F.col(start).alias("stage_start_at"), F.col(end).alias("stage_end_at"))


def session_documents(samples: DataFrame, user: str = "user_id", start: str = "start_at", end: str = "end_at",
                      tie: str = "uuid", stage: str = "sleep_stage", gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """One value per session with its stages in order, as a client uploads it; for users of one device,
    whose sessions are bounded by a night."""
    stages = session_stages(samples, user, start, end, tie, stage, gap_seconds)
    entry = F.struct("stage_no", "stage", "stage_start_at", "stage_end_at")
    return (stages.groupBy(user, "session_seq")
            .agg(F.min("stage_start_at").alias("session_start_at"), F.max("stage_end_at").alias("session_end_at"),
                 F.array_sort(F.collect_list(entry)).alias("stages")))


def session_windows(samples: DataFrame, user: str = "user_id", start: str = "start_at", end: str = "end_at",
                    gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """The streaming-friendly form, ``session_window`` with a per-row gap
    of (sample length + gap) so a sample extends its session to its own end
    plus the gap.  Equal to W2 unless a sample is nested inside an earlier,
    longer one (then W2 measures from the nested sample's end)."""
    length = F.unix_seconds(F.col(end)) - F.unix_seconds(F.col(start))
    gap = F.concat((length + F.lit(gap_seconds)).cast("string"), F.lit(" seconds"))
    return (samples.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
            .groupBy(user, F.session_window(F.col(start), gap).alias("w"))
            .agg(F.min(start).alias("session_start_at"), F.max(end).alias("session_end_at"),
                 F.count(F.lit(1)).alias("stage_count")))
