"""SimHash near-dedup by Golay-code fuzzy hashing.

The 64 bits of a fingerprint are cut into three segments of 22, 21 and 21 bits.
The binary Golay code (23,12) is perfect: each 23-bit word lies within 3 bits
of exactly one of 4096 codewords.  ``near`` of a segment is the set of codewords
within 4 bits (1 to 6 of them).  Two words 1 bit apart: the codeword nearest to
either is near the other.  Two words at most 2 bits apart share a near
codeword (the one nearest to a word between them).

Pigeonhole: of at most 4 differing bits, the two segments with the fewest hold
at most 2.  So for each pair of segments the keys are
``nearest(a) x near(b)`` and ``near(a) x nearest(b)``, about 10 keys of 24 bits;
whichever way those 2 errors fall, (0,2), (2,0) or (1,1), the two fingerprints
share a key.  Fingerprints that meet at a key are verified by their distance.

Equal fingerprints are one row before any key is made.  Within a key, the rows
are linked by a search that drops each fingerprint from the open set once it is
reached, so a dense bucket costs about its size, and it yields a spanning
forest of its links, never all pairs.

Rows: a null or empty text has the fingerprint zero and is linked like any
other.  Null ids are passed over when a component's smallest id is taken (null
if it has no other).  Repeated rows are linked with each other.  Very long texts
are read whole.  Other columns pass through a pipeline stage whatever their
names, but names that begin with two underscores are the stages' own.  An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import arrow_map, column, documents, lookup, stage, texts
from .components import stars

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: generator polynomial of the Golay code
GOLAY = 0xC75
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: groups up to this size are compared row by row, larger ones by open-set search
SMALL_GROUP = 8
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLOCK = 200_000


def shingle_hashes(text: str, size: int = SHINGLE) -> list[int]:
    """XXH64 of each run of ``size`` words, repeats included."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(b" ".join(words), SEED)]
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[:-size].tolist()]
    return [digest(line[a:b - 1], SEED) for a, b in zip(starts, ends[size - 1:].tolist())]


def _bit_counts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduceat(bits, bounds, axis=0, dtype=np.int32)


def fingerprints(bodies: list[str], size: int = SHINGLE) -> np.ndarray:
    """A bit is 1 if it is set in over half of the shingle hashes."""
    counts, totals = np.zeros((len(bodies), 64), np.int64), np.zeros(len(bodies), np.int64)
    held: list[np.ndarray] = []
    rows: list[int] = []

    def flush() -> None:
        if held:
            bounds = np.cumsum([0, *(len(h) for h in held[:-1])])
            np.add.at(counts, rows, _bit_counts(np.concatenate(held), bounds))
            held.clear()
            rows.clear()

    for k, body in enumerate(bodies):
        h = np.array(shingle_hashes(body, size), dtype="<u8")
        totals[k] = len(h)
        for a in range(0, len(h), _BLOCK):
            held.append(h[a:a + _BLOCK])
            rows.append(k)
            if sum(map(len, held)) >= _BLOCK:
                flush()
    flush()
    return np.packbits(counts * 2 > totals[:, None], axis=1, bitorder="little").view("<u8")[:, 0]


@lru_cache(maxsize=1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the lower 12 and upper 11 bits; the error pattern of each syndrome."""
    def rest(v: np.ndarray) -> np.ndarray:
        for bit in range(22, 10, -1):
            v = np.where(v >> bit & 1, v ^ (GOLAY << (bit - 11)), v)
        return v

    errors = np.array([sum(1 << b for b in c) for n in range(4) for c in combinations(range(23), n)], np.int64)
    pattern = np.zeros(2048, np.int64)
    pattern[rest(errors)] = errors
    return rest(np.arange(1 << 12)), rest(np.arange(1 << 11) << 12), pattern


def nearest(v: np.ndarray) -> np.ndarray:
    """Index (0 to 4095) of the codeword within 3 bits of each 23-bit word."""
    low, high, pattern = _golay()
    return (v ^ pattern[low[v & 0xFFF] ^ high[v >> 12]]) >> 11


def near(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all codewords within 4 bits, and which of the columns count."""
    flips = np.r_[0, 1 << np.arange(23)]
    found = np.sort(nearest(v[:, None] ^ flips[None, :]), axis=1)
    return found, np.c_[np.ones(len(v), bool), np.diff(found, axis=1) != 0]


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each fingerprint and the row each key belongs to."""
    segments = [(prints >> np.uint64(a) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    one, some = [nearest(s) for s in segments], [near(s) for s in segments]
    keys, rows = [], []
    for p, (a, b) in enumerate(combinations(range(len(SEGMENTS)), 2)):
        (wa, ma), (wb, mb) = some[a], some[b]
        for key, mask in ((one[a][:, None] << 12 | wb, mb), (wa << 12 | one[b][:, None], ma & (wa != one[a][:, None]))):
            r, c = np.nonzero(mask)
            keys.append(key[r, c] | p << 24)
            rows.append(r)
    return np.concatenate(keys), np.concatenate(rows)


def _search(group: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links within ``group``."""
    left = group
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            p = front.pop()
            close = np.bitwise_count(left ^ p) <= bits
            if close.any():
                new = left[close]
                yield np.full(len(new), p, np.uint64), new
                front.extend(new)
                left = left[~close]


def bucket_links(keys: np.ndarray, prints: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of equal key; ``keys`` is sorted, ``prints`` distinct within a key."""
    left, right = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
    first = np.flatnonzero(np.r_[True, np.diff(keys) != 0])
    size = np.diff(np.r_[first, len(keys)])
    large = size > SMALL_GROUP
    for f, n in zip(first[large], size[large]):
        for a, b in _search(prints[f:f + n], bits):
            left.append(a)
            right.append(b)
    small = np.repeat(~large, size)
    keys, prints = keys[small], prints[small]
    for s in range(1, SMALL_GROUP):
        close = (keys[s:] == keys[:-s]) & (np.bitwise_count(prints[s:] ^ prints[:-s]) <= bits)
        left.append(prints[s:][close])
        right.append(prints[:-s][close])
    return np.concatenate(left), np.concatenate(right)


_LINKS = StructType([StructField("u", LongType()), StructField("v", LongType())])
_PRINT = StructField("__fp", LongType())


def with_fingerprints(docs: DataFrame, size: int = SHINGLE, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the fingerprint ``__fp`` (as a signed long); ``keep``: other columns wanted."""
    keep = docs.columns if keep is None else keep

    def step(batch: pa.RecordBatch) -> dict:
        return {n: column(batch, n) for n in keep} | {"__fp": fingerprints(texts(batch, text), size).view(np.int64)}

    return arrow_map(docs.select(*dict.fromkeys([*keep, text])), step, StructType([*(docs.schema[n] for n in keep), _PRINT]), text)


def links(prints: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """``(u, v)``: links that join all distinct fingerprints ``__fp`` within ``bits`` bits."""
    if bits > MAX_BITS:
        raise ValueError(f"the keys find fingerprints at most {MAX_BITS} bits apart")

    def emit(batch: pa.RecordBatch) -> dict:
        fp = column(batch, "__fp").to_numpy().view(np.uint64)
        keys, rows = fuzzy_keys(fp)
        return {"key": keys, "fp": fp[rows].view(np.int64)}

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            u, v = bucket_links(keys, fps, bits)
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            if not len(keys):
                continue
            cut = np.searchsorted(keys, keys[-1])  # the last key may go on in the next batch
            if held and (cut or keys[0] != held[0][0][0]):
                yield out(np.concatenate([*(k for k, _ in held), keys[:cut]]), np.concatenate([*(f for _, f in held), fps[:cut]]))
                held = []
            elif cut:
                yield out(keys[:cut], fps[:cut])
            held.append((keys[cut:], fps[cut:]))
        if held:
            yield out(np.concatenate([k for k, _ in held]), np.concatenate([f for _, f in held]))

    keyed = arrow_map(prints, emit, "key int, fp long", None)
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(meet, _LINKS).distinct()


def components(prints: DataFrame, doc_id: str = "doc_id", bits: int = MAX_BITS) -> DataFrame:
    """``(__fp, component_id)`` for each distinct fingerprint of ``prints``:
    the smallest id that its links reach."""
    one = prints.groupBy("__fp").agg(F.min(doc_id).alias("least")).checkpoint()
    roots = stars(links(one.select("__fp"), bits)).select(F.col("u").alias("__fp"), F.col("v").alias("root"))
    named = one.join(roots, "__fp", "left").select("__fp", "least", F.coalesce("root", "__fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # a component may hold a third of all fingerprints: its rows are spread, each part with a copy of the answer
    return lookup(named.select("__fp", "root"), ["root"], least, "__fp").select("__fp", "component_id")


def op6_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = stage(with_fingerprints(documents(spark, sf_dir), keep=["doc_id"]), "fingerprints")
    return prints.join(components(prints), "__fp").select(
        "doc_id", F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id")


def stage_simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest id stays
    (a null id ranks last; of rows with one id, the first stored one)."""
    rows = stage(with_fingerprints(docs.withColumn("__row", F.monotonically_increasing_id())), "simhash-rows")
    first = components(rows.withColumn("__id", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__row"))
                       .select("__fp", "__id"), "__id")
    keep = first.select(F.col("component_id.__row").alias("__row")).distinct()
    return rows.join(keep.hint("shuffle_hash"), "__row", "left_semi").select(*docs.columns)
