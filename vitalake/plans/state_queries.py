"""Queries over tables that are maintained in steps: each works the driver's
data off in several batches and returns what a single batch run would.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import SEED_DEVICE_ID
from ..functions.variant import header
from ..operators import deletes, garmin, silver
from ..operators.distinct_users import UserDays
from ..operators.marks import Deliveries
from ..operators.quality import QualityRefused, land_checked
from ..schemas import BRONZE
from ..session import checkpoint_dir, ensure_session
from ..sources import layout
from ..sources.backfill import Backfill
from ..sources.bronze_store import bronze_path_for, landed_bronze
from ..sources.snapshots import SnapshotTable, replace_where
from ..streaming import medallion as streaming
from ..streaming.change_feed import KeyedState
from ..streaming.late_rows import LateGate
from ..streaming.open_sessions import OpenSessions
from .bucketed import BucketedStore, activity_enriched_bucketed, live_bucketed
from .incremental import IncrementalGold
from .medallion import Medallion

#: files a micro-batch of these queries takes in at least, and micro-batches that the files landed so far make at
#: most: the files follow the data or the shuffle partitions, and each micro-batch rewrites the states it touches
STEP_FILES, STEPS = 4, 5


def step_files(rows: DataFrame) -> int:
    """Files a micro-batch takes in, so that the files of a stored table are worked off in several, but at most ``STEPS``."""
    return max(STEP_FILES, -(-len(rows.inputFiles()) // STEPS))


def _root(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark)}/state/{name}-{uuid.uuid4().hex[:12]}"


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_session(spark)
    return landed_bronze(spark, sf_dir)


def time_cuts(rows: DataFrame, parts: int, at: str = "ingested_at") -> list[int]:
    """Upper bounds (microseconds, inclusive) of ``parts`` equal spans of time; the last holds the newest row."""
    t = F.unix_micros(at)
    low, high = rows.agg(F.min(t), F.max(t)).first()
    if low is None:
        return []
    return [low + (high - low) * k // parts for k in range(1, parts)] + [high]


def bronze_reseeded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seed device's rows replaced in one version by a day-later copy of its samples."""
    bronze = _bronze(spark, sf_dir)
    table = SnapshotTable(spark, _root(spark, "reseeded"), "record_type", BRONZE)
    table.append(bronze)
    seed = header("x-device-id") == F.lit(SEED_DEVICE_ID)
    again = (bronze.filter(seed & (F.col("record_type") == "samples"))
             .withColumn("record_id", F.concat("record_id", F.lit("-again")))
             .withColumn("ingested_at", F.col("ingested_at") + F.expr("INTERVAL 1 DAY")))
    replace_where(table, seed, again)
    return table.read().select("record_id", "record_type", "user_id", "ingested_at")


def _samples_state(spark: SparkSession, name: str, like: DataFrame) -> KeyedState:
    return KeyedState(spark, _root(spark, name), like.schema, "hk_uuid", F.unix_micros("ingested_at"), ["record_id"])


def stream_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 streaming: sample upserts and delete notices of the bronze stream, merged micro-batch by
    micro-batch into the keyed state (order-free deletes)."""
    bronze = _bronze(spark, sf_dir)
    like = silver.samples(bronze, "none")
    path, files = bronze_path_for(spark, sf_dir), step_files(bronze)
    state = _samples_state(spark, "feed", like)
    ups = silver.samples(streaming.bronze_stream(spark, path, max_files_per_trigger=files), "none").withColumn("op", F.lit("upsert"))
    dels = (silver.deletes(streaming.bronze_stream(spark, path, max_files_per_trigger=files), "none")
            .select(F.col("deleted_uuid").alias("hk_uuid"), "ingested_at", F.lit("delete").alias("op")))
    q = state.follow(ups.unionByName(dels, allowMissingColumns=True), f"{state.table.root}-checkpoint")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return state.rows()


def change_feed_synced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6 with tokens: four pulls from the change log of the samples, a token per sample type.  Before
    the third pull the log loses, for every third type, all but its newest changes, so that the
    tokens of these types expire and they are read again in full."""
    bronze = _bronze(spark, sf_dir)
    ups = silver.samples(bronze, "none")
    # a feed names the type of the record that is gone; the test rows do not, so it is looked up
    kinds = ups.groupBy("hk_uuid").agg(F.max("hk_type").alias("kind"))
    dels = (silver.deletes(bronze, "none").join(kinds, F.col("deleted_uuid") == F.col("hk_uuid"), "left").drop("hk_uuid")
            .withColumn("deleted_sample_type", F.coalesce("kind", "deleted_sample_type")).drop("kind"))
    state = _samples_state(spark, "synced", ups)
    seq = F.unix_micros("ingested_at")
    cuts = time_cuts(bronze, 4)
    for k, cut in enumerate(cuts):
        seen_ups, seen_dels = ups.filter(seq <= cut), dels.filter(seq <= cut)
        log = (seen_ups.withColumns({"type": F.col("hk_type"), "op": F.lit("upsert")})
               .unionByName(seen_dels.select(F.col("deleted_uuid").alias("hk_uuid"), "ingested_at", F.col("deleted_sample_type").alias("type"),
                                             F.lit("delete").alias("op")), allowMissingColumns=True))
        floors = {}
        if k == 2:
            floors = {t: cut - (cuts[2] - cuts[1]) // 2 for t in sorted(state.tokens())[::3]}
            lost = [(F.col("type") == t) & (seq < floor) for t, floor in floors.items()]
            for some in lost:
                log = log.filter(~F.coalesce(some, F.lit(False)))

        def full_read(types: list[str], u: DataFrame = seen_ups, d: DataFrame = seen_dels) -> DataFrame:
            return deletes.current_state(u.filter(F.col("hk_type").isin(types)), d, "hk_uuid", ("ingested_at", "record_id"))

        state.sync(log, full_read, floors, "type", "hk_type")
    return state.rows() if cuts else ups


def _in_steps(table: str, source: str, at: str = "ingested_at", parts: int = 3):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = getattr(Medallion(_bronze(spark, sf_dir)), source)
        gold, low = IncrementalGold(spark, _root(spark, f"gold-{table}")), None
        for k, cut in enumerate(time_cuts(rows, parts, at)):
            t = F.unix_micros(at)
            gold.update(table, rows.filter(t <= cut if low is None else (t > low) & (t <= cut)), k)
            low = cut
        return gold.read(table)
    run.__doc__ = f"X4: ``{table}`` folded together from {parts} arrivals of ``{source}``."
    return run


def stream_gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of new silver samples keeps the daily quantities up to date, several micro-batches."""
    _bronze(spark, sf_dir)
    root = streaming.run_available_now(spark, bronze_path_for(spark, sf_dir), flows=("samples",), dedup="exact")
    sink = f"{root}/tables/samples"
    like = spark.read.parquet(sink)
    gold = IncrementalGold(spark, _root(spark, "gold"))
    rows = spark.readStream.schema(like.schema).option("maxFilesPerTrigger", step_files(like)).parquet(sink)
    q = gold.follow(rows, ["hk_quantity_daily", "daily_steps"], f"{gold.root}-checkpoint")
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return gold.read("hk_quantity_daily")


#: days of one arrival window, and how many days every 17th record is delayed
ARRIVAL_DAYS, DELAY_DAYS = 4, 6
LATE_SECONDS = 36 * 3600


def samples_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples arriving in windows of four days, every 17th record six days late: kept and late rows
    with the window they came in (what is missing are duplicates)."""
    rows = silver.samples(_bronze(spark, sf_dir), "none")
    number = F.regexp_extract("record_id", "[0-9]+", 0).cast("long")
    arrives = F.unix_seconds("ingested_at") + F.when(number % 17 == 0, DELAY_DAYS * 86400).otherwise(0)
    window = F.floor(arrives / (ARRIVAL_DAYS * 86400))
    gate = LateGate(spark, _root(spark, "late"), rows.schema, "hk_uuid", LATE_SECONDS)
    for w in sorted(r[0] for r in rows.select(window).distinct().collect() if r[0] is not None):  # a row a window
        gate.take(rows.filter(window == w), w)
    columns = ["record_id", "hk_uuid", "ingested_at", F.col("_epoch").alias("arrival")]
    return (gate.rows("kept").select(F.lit("kept").alias("kind"), *columns)
            .unionByName(gate.rows("late").select(F.lit("late").alias("kind"), *columns)))


def stream_sleep_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions by W2's rule from five arrivals of raw stage rows, resent stages included."""
    bronze = _bronze(spark, sf_dir)
    state, t = OpenSessions(spark, _root(spark, "sessions")), F.unix_micros("ingested_at")
    low = None
    for k, cut in enumerate(time_cuts(silver.sleep_stages(bronze, "none"), 5)):
        # the arrival is chosen before its documents are taken apart
        state.take(silver.sleep_stages(bronze.filter(t <= cut if low is None else (t > low) & (t <= cut)), "none"), k)
        low = cut
    return state.sessions()


def backfill_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of January backfilled from the bronze table.  In the first run the source cannot read every
    fifth day; the second run is given the same range and takes those days alone."""
    bronze = _bronze(spark, sf_dir).select(F.to_date("ingested_at").alias("day"), "record_id", "record_type", "user_id")
    job = Backfill(spark, _root(spark, "backfill"), bronze.schema)

    def extract(days: DataFrame, broken: bool) -> DataFrame:
        bad = (F.dayofmonth("day") % 5 == 0) & F.lit(broken)
        return bronze.join(F.broadcast(days), "day", "left_semi").withColumn("error", F.when(bad, F.lit("source not readable")))

    job.run("2024-01-01", "2024-02-01", lambda days: extract(days, True))
    job.run("2024-01-01", "2024-02-01", lambda days: extract(days, False))
    held = job.sink.read().groupBy("day").agg(F.count(F.lit(1)).alias("held"))
    return job.ledger.read().join(held, "day", "left").select("day", "status", "attempts", "rows", F.coalesce("held", F.lit(0)).alias("held"))


def watch_delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P31 with stored marks: three deliveries from a growing buffer, the second one repeated.
    The buffer holds the records as rows: each batch document is taken apart once, not in every delivery."""
    ensure_session(spark)
    buffer = _root(spark, "watch-buffer")
    garmin.explode_watch_batch(landed_bronze(spark, sf_dir, "watch")).write.parquet(buffer)
    events = spark.read.parquet(buffer)
    out, t = Deliveries(spark, _root(spark, "watch"), events.schema), F.unix_micros("recorded_at")
    for cut in [c for k, c in enumerate(time_cuts(events, 3, "recorded_at")) for _ in range(1 + (k == 1))]:
        out.deliver(events.filter(t <= cut))
    return out.delivered().withColumn("metadata_json", F.to_json("metadata")).drop("metadata")


def quality_gated_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R23 in the write pass: the bronze rows of the first half of the time are landed and published; a second
    batch, in which the seed device names another platform, is refused.  All checks of both batches."""
    bronze = _bronze(spark, sf_dir)
    cuts = time_cuts(bronze, 2)
    table = SnapshotTable(spark, _root(spark, "gated"), "record_type", BRONZE)
    t, results = F.unix_micros("ingested_at"), []
    strange = F.when(header("x-device-id") == SEED_DEVICE_ID, F.lit("other")).otherwise(F.col("source_platform"))
    for k, rows in enumerate([bronze.filter(t <= cuts[0]), bronze.filter(t > cuts[0]).withColumn("source_platform", strange)] if cuts else []):
        try:
            checks = land_checked(table, rows, "apple_healthkit")
        except QualityRefused as refused:
            checks = refused.checks
        results += [(k, *c, table.version() == k + 1) for c in checks]
    published = table.read().agg(F.count(F.lit(1)).alias("rows_published"))
    out = spark.createDataFrame(results, "batch int, check string, passed boolean, detail string, published boolean")
    return out.join(F.broadcast(published))  # one row


def active_users_rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct users with activity in the seven days up to each day, from day bitmaps that three
    arrivals built."""
    rings = Medallion(_bronze(spark, sf_dir)).rings.select("ingested_at", F.col("summary_date").alias("day"), "user_id")
    users, t, low = UserDays(spark, _root(spark, "users")), F.unix_micros("ingested_at"), None
    for k, cut in enumerate(time_cuts(rings, 3)):
        users.update(rings.filter(t <= cut if low is None else (t > low) & (t <= cut)), k)
        low = cut
    return users.rolling(7)


def g_activity_enriched_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1/G4 on rings and steps stored in buckets of (user_id, day): the join needs no shuffle."""
    m = Medallion(_bronze(spark, sf_dir))
    store = BucketedStore(spark, _root(spark, "bucketed"), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return activity_enriched_bucketed(store, m.rings, m.daily_steps)


def samples_live_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 on samples and delete feed stored in buckets of the id: the anti-join needs no shuffle."""
    m = Medallion(_bronze(spark, sf_dir))
    store = BucketedStore(spark, _root(spark, "bucketed"), buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
    return live_bucketed(store, "samples", m.samples, m.deletes, "hk_uuid")


def clustered_bronze_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze landed in six appends, compacted into clustered files, then read for some users and days."""
    bronze = _bronze(spark, sf_dir)
    table, t, low = SnapshotTable(spark, _root(spark, "clustered"), "record_type", BRONZE), F.unix_micros("ingested_at"), None
    for cut in time_cuts(bronze, 6):
        table.append(bronze.filter(t <= cut if low is None else (t > low) & (t <= cut)))
        low = cut
    layout.compact(table)
    rows = table.read().filter(F.col("user_id").between("u10", "u19") & (F.col("ingested_at") >= "2024-01-08") & (F.col("ingested_at") < "2024-01-15"))
    return rows.select("record_id", "record_type", "user_id", "ingested_at")


STATE_QUERIES = {
    "clustered_bronze_window": clustered_bronze_window,
    "samples_live_bucketed": samples_live_bucketed,
    "g_activity_enriched_bucketed": g_activity_enriched_bucketed,
    "quality_gated_landing": quality_gated_landing,
    "active_users_rolling": active_users_rolling,
    "samples_late_split": samples_late_split,
    "stream_sleep_sessions": stream_sleep_sessions,
    "backfill_ledger": backfill_ledger,
    "watch_delivered": watch_delivered,
    "bronze_reseeded": bronze_reseeded,
    "stream_change_feed": stream_change_feed,
    "change_feed_synced": change_feed_synced,
    "stream_gold_incremental": stream_gold_incremental,
    "inc_subject_daily": _in_steps("subject_daily", "events"),
    "inc_sleep_nightly": _in_steps("sleep_nightly", "sleep_stages"),
    "inc_weekly_workouts": _in_steps("weekly_workouts", "workouts"),
    "inc_family_weekly": _in_steps("family_weekly", "samples"),
    "inc_ingest_daily": _in_steps("ingest_daily", "bronze"),
}
