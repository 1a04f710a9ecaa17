"""MinHash near-dedup with tensored banding.

A document's set of word shingles is sketched by ``COLLECTIONS`` small
collections of ``HASHES`` minima each.  A table key is a pair of collections:
20 collections of 3 give 190 tables of 6 minima from 60 minima in all, where
independent tables would take 1140.  Two sets meet in a table if they agree in
two collections; at similarity 0.8 a pair stays unseen with a chance of about
1.3 in 100 000 (less above).

Equal sets are one row (a class) before any key is made.  Table keys are dealt
by range of (key, class), so a bucket of any size is spread over tasks.  A
bucket of up to ``SMALL`` classes gives its pairs.  In a larger one all members
are paired with its heaviest member, the one that meets most others in large
buckets (the original of a group of near copies meets its copies more often than
they meet each other).  Candidates are verified on the full sets, these first;
then pairs that are not joined already.  What this leaves open are large buckets
whose members are not all joined: their members are compared by an exact filter
(of shingles in order of frequency, two sets with similarity 0.8 share one so
far to the rare end that enough others can follow in both), so no link is lost to
the shortcut.  Components come from the verified links.

Rows: a null or empty text, or one without words, has the empty set, is linked
with nothing and is its own component.  Fewer words than a shingle are one
shingle.  Null ids rank last (``component_id`` is null if there is no other);
repeated rows and repeated ids are linked by their texts, each row is returned.
Very long texts are read whole.  Other columns are not read.  An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, column, delete_path, documents, lookup, stage, stage_path, struct, texts
from .components import stars

SHINGLE = 2
PERCENT = 80
COLLECTIONS = 20
HASHES = 3
#: buckets up to this size give all their pairs
SMALL = 8
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORDS_KEPT = 400_000
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_COEFFICIENTS = np.random.default_rng(13).integers(1, 1 << 63, (COLLECTIONS * HASHES, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(31)) * _M1
    return x ^ x >> np.uint64(29)


class Shingler:
    """Shingle sets as sorted 64-bit hashes; hashes of words are kept up to a bound."""

    def __init__(self, size: int = SHINGLE) -> None:
        self.size, self.kept = size, {}

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").translate(_LOWER).split()
        if not words:
            return np.zeros(0, np.uint64)
        kept = self.kept
        if len(kept) > _WORDS_KEPT:
            kept.clear()
        for w in set(words):
            if w not in kept:
                kept[w] = xxhash.xxh64_intdigest(w)
        h = np.fromiter(map(kept.__getitem__, words), np.uint64, len(words))
        size = min(self.size, len(words))
        out = np.full(len(h) - size + 1, size, np.uint64)  # a short sequence is no shingle of another length
        for k in range(size):
            out = _mix(out * _M2 + h[k:len(h) - size + 1 + k])
        return np.unique(out)


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """One collection key per set (row) and collection; sets are not empty."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.zeros((len(sets), COLLECTIONS), np.uint64)
    for c in range(COLLECTIONS):
        for a, b in _COEFFICIENTS[c * HASHES:(c + 1) * HASHES]:
            out[:, c] = _mix(out[:, c] * _M2 + np.minimum.reduceat(flat * a + b, starts))
    return out


def sketched(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``(doc_id, body, n, k1, k2, sketch)``: a row per document; ``body`` names the text, ``k1, k2`` its set."""
    shingler = Shingler(size)

    def step(batch: pa.RecordBatch) -> dict:
        sets = [shingler(t) for t in texts(batch)]
        some = [s for s in sets if len(s)]
        names = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
        sketch = iter([r.tobytes() for r in minima(some)] if some else [])
        return {"doc_id": column(batch, "doc_id"), "body": column(batch, "body"), "n": [len(s) for s in sets],
                "k1": names[:, 0], "k2": names[:, 1], "sketch": [next(sketch) if len(s) else None for s in sets]}

    return arrow_map(_named(docs), step, "doc_id long, body long, n long, k1 long, k2 long, sketch binary")


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("body"), "text")


def table_keys(classes: DataFrame) -> DataFrame:
    """``(key, cid)`` for each class and each pair of collections."""
    left, right = np.array(list(combinations(range(COLLECTIONS), 2))).T
    tables = np.arange(len(left)).astype(np.uint64)

    def step(batch: pa.RecordBatch) -> dict:
        subs = np.frombuffer(b"".join(column(batch, "sketch").to_pylist()), "<u8").reshape(-1, COLLECTIONS)
        keys = _mix(_mix(subs[:, left] * _M2 + tables) + subs[:, right])
        return {"key": keys.ravel().view(np.int64), "cid": np.repeat(column(batch, "cid").to_numpy(), len(left))}

    return arrow_map(classes.select("cid", "sketch"), step, "key long, cid long", None)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by (key, cid): the pairs ``(u, v)`` of small buckets, and the rows ``(key, v)`` of
    large ones and of those at both ends of the task, which may go on in the tasks beside."""
    schema = pa.schema([("key", pa.int64()), ("u", pa.int64()), ("v", pa.int64())])

    def told(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.nulls(len(keys), pa.int64()), pa.array(ids)], schema=schema)

    def done(keys: np.ndarray, ids: np.ndarray, edge: np.int64) -> Iterator[pa.RecordBatch]:
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[first, len(keys)])
        big = np.repeat((size > SMALL) | (keys[first] == edge), size)
        if big.any():
            yield told(keys[big], ids[big])
        keys, ids = keys[~big], ids[~big]
        for s in range(1, SMALL):
            same = keys[s:] == keys[:-s]
            if not same.any():
                break
            yield pa.RecordBatch.from_arrays([pa.nulls(int(same.sum()), pa.int64()), pa.array(ids[:-s][same]), pa.array(ids[s:][same])], schema=schema)

    held_keys, held_ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = large = None  # keys of the first bucket of this task, and of a large one whose rows are passed on as they come
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, ids = np.r_[held_keys, batch.column(0).to_numpy()], np.r_[held_ids, batch.column(1).to_numpy()]
        if edge is None:
            edge = keys[0]
        if large is not None:
            n = int(np.searchsorted(keys, large, side="right"))
            if n:
                yield told(keys[:n], ids[:n])
            if n == len(keys):
                continue
            keys, ids, large = keys[n:], ids[n:], None
        cut = int(np.searchsorted(keys, keys[-1]))  # the last run may go on in the next batch
        if cut:
            yield from done(keys[:cut], ids[:cut], edge)
        held_keys, held_ids = keys[cut:], ids[cut:]
        if len(held_keys) > SMALL:
            yield told(held_keys, held_ids)
            held_keys, held_ids, large = held_keys[:0], held_ids[:0], held_keys[0]
    if len(held_keys):
        yield told(held_keys, held_ids)


def shingle_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``(cid, set)`` stored, for the classes ``cid`` of ``wanted``."""
    shingler = Shingler(size)
    last = F.lit((1 << 63) - 1)
    where = classes.join(wanted.distinct(), "cid", "left_semi").select(F.coalesce("least", last).alias("did"), "body", "cid")
    found = (_named(docs).withColumn("did", F.coalesce("doc_id", last)).select("did", "body", "text")
             .join(where, ["did", "body"]).select("cid", "text").dropDuplicates(["cid"]))

    def step(batch: pa.RecordBatch) -> dict:
        return {"cid": column(batch, "cid"), "set": [shingler(t).tobytes() for t in texts(batch)]}

    return stage(arrow_map(found, step, "cid long, set binary"), "shingle-sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(u, v)`` whose sets are similar, stored."""
    both = lookup(lookup(pairs.select("u", "v"), ["v"], sets.select(F.col("cid").alias("v"), F.col("set").alias("b")), "u"),
                  ["u"], sets.select(F.col("cid").alias("u"), F.col("set").alias("a")), "v")

    def step(batch: pa.RecordBatch) -> dict:
        keep = []
        for k, (a, b) in enumerate(zip(column(batch, "a"), column(batch, "b"))):
            a, b = np.frombuffer(a.as_buffer(), "<u8"), np.frombuffer(b.as_buffer(), "<u8")
            least, most = sorted((len(a), len(b)))
            if 100 * least >= percent * most:
                same = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * same >= percent * (least + most - same):
                    keep.append(k)
        rows = pa.array(keep, pa.int64())
        return {"u": column(batch, "u").take(rows), "v": column(batch, "v").take(rows)}

    return stage(arrow_map(both.select("u", "v", "a", "b"), step, "u long, v long", None), "links")


def star_pairs(told: DataFrame) -> DataFrame:
    """``(u, v)``: each member of a large bucket with the bucket's heaviest member."""
    sizes = told.groupBy("key").agg(F.count("*").alias("n"))
    weights = lookup(told, ["key"], sizes, "cid").groupBy("cid").agg(F.sum("n").alias("w"))
    hubs = told.join(weights, "cid").groupBy("key").agg(F.max(F.struct("w", (-F.col("cid")).alias("m"))).alias("h")).select("key", (-F.col("h.m")).alias("hub"))
    return (lookup(told, ["key"], hubs, "cid").where("cid <> hub")
            .select(F.least("cid", "hub").alias("u"), F.greatest("cid", "hub").alias("v")).distinct())


def _labelled(rows: DataFrame, name: str, labels: DataFrame, out: str) -> DataFrame:
    """``rows`` with the label of the class in column ``name`` (itself if it has none)."""
    of = labels.select(F.col("u").alias(name), F.col("v").alias("__of"))
    return rows.join(of, name, "left").withColumn(out, F.coalesce("__of", name)).drop("__of")


def filtered_pairs(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of differently labelled ``members (cid, label)`` that can be similar by their sizes and by the place
    of a common shingle in the order of frequency (the first common one of a similar pair passes)."""
    def step(batch: pa.RecordBatch) -> dict:
        each = [np.frombuffer(s.as_buffer(), "<i8") for s in column(batch, "set")]
        sizes = [len(s) for s in each]
        return {"cid": np.repeat(column(batch, "cid").to_numpy(), sizes), "n": np.repeat(sizes, sizes), "shingle": np.concatenate(each)}

    whole = arrow_map(sets.join(members.select("cid"), "cid", "left_semi"), step, "cid long, n long, shingle long", "set")
    common = whole.groupBy("shingle").agg(F.count("*").alias("f")).where("f > 1")
    # back: how many shingles, this one included, are at least as far to the frequent end (single ones are at the rare end)
    order = Window.partitionBy("cid").orderBy(F.desc("f"), "shingle")
    ranked = lookup(whole, ["shingle"], common, "cid").withColumn("back", F.row_number().over(order))
    prefix = stage(ranked.where(F.col("back") >= F.ceil(F.col("n") * percent / 100)).join(members, "cid")
                   .select("shingle", "cid", "n", "label", "back"), "prefixes")
    mixed = prefix.groupBy("shingle").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("shingle")
    prefix = prefix.join(mixed, "shingle", "left_semi")
    other = prefix.select("shingle", F.col("cid").alias("v"), F.col("n").alias("m"), F.col("label").alias("other"), F.col("back").alias("rest"))
    return (prefix.join(other, "shingle").where((F.col("cid") < F.col("v")) & (F.col("label") != F.col("other"))
                                                & (100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
                                                & ((100 + percent) * F.least("back", "rest") >= percent * (F.col("n") + F.col("m"))))
            .select(F.col("cid").alias("u"), "v").distinct())


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs``."""
    spark = docs.sparkSession
    rows = stage(sketched(docs, size), "sketches")
    some = rows.where("n > 0")
    last = F.lit((1 << 63) - 1)
    grouped = some.groupBy("k1", "k2").agg(F.min(F.struct(F.coalesce("doc_id", last).alias("did"), "body")).alias("first"), F.first("sketch").alias("sketch"))
    order = ["did", "k1", "k2"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # class ids rise with the smallest document id, so that the root of a component has its answer
    classes = stage(grouped.select("k1", "k2", "sketch", F.col("first.did").alias("did"), F.col("first.body").alias("body"))
                    .repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("cid", F.monotonically_increasing_id())
                    .withColumn("least", F.when(F.col("did") < last, F.col("did"))).drop("did"), "classes")
    wide = max(parts, 2 * spark.sparkContext.defaultParallelism)
    met, met_path = stage_path(table_keys(classes).repartitionByRange(wide, "key", "cid").sortWithinPartitions("key", "cid")
                               .mapInArrow(_meet, struct("key long, u long, v long")), "buckets")
    pairs, pairs_path = stage_path(met.where("key IS NULL").select("u", "v").distinct(), "candidates")
    told = met.where("key IS NOT NULL").select("key", F.col("v").alias("cid"))
    sets = shingle_sets(docs, classes, pairs.select(F.col("u").alias("cid")).union(pairs.select("v")).union(told.select("cid")), size)
    stars_, stars_path = stage_path(star_pairs(told), "stars")
    one = verified(stars_, sets, percent)
    labels = stars(one)
    apart = _labelled(_labelled(pairs, "u", labels, "a"), "v", labels, "b").where("a <> b").select("u", "v")
    two = verified(apart.join(stars_, ["u", "v"], "left_anti"), sets, percent)
    labels = stars(one.union(two))
    open_rows = _labelled(told, "cid", labels, "label")
    mixed = open_rows.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("key")
    members = stage(open_rows.join(mixed, "key", "left_semi").select("cid", "label").distinct(), "open-members")
    seen = pairs.union(stars_)
    three = verified(filtered_pairs(members, sets, percent).join(seen, ["u", "v"], "left_anti"), sets, percent)
    labels = stars(one.union(two).union(three))
    for path in (met_path, pairs_path, stars_path):
        delete_path(spark, path)
    least = classes.select(F.col("cid").alias("root"), "least")
    found = classes.select("k1", "k2", "cid").join(labels.select(F.col("u").alias("cid"), F.col("v").alias("root")), "cid", "left")
    joined = lookup(found.where("root IS NOT NULL"), ["root"], least, "cid").select("k1", "k2", F.col("least").alias("component_id"))
    alone = classes.join(labels.select(F.col("u").alias("cid")), "cid", "left_anti").select("k1", "k2", F.col("least").alias("component_id"))
    known = lookup(some.select("doc_id", "body", "n", "k1", "k2"), ["k1", "k2"], joined.union(alone), "doc_id").select("doc_id", "n", "component_id")
    whole = known.union(rows.where("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op13_minhash_tensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))
