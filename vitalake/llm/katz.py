"""Katz back-off language model over words, counted and scored as Spark jobs.

Model: ``P(w | h) = d(c(h,w)) c(h,w) / c(h)`` for bigrams seen in training, else
``a(h) P(w)``; ``P(w) = d(c(w)) c(w) / N`` for words seen, else the mass that
the discounts leave, which belongs to the one unknown word.  Up to ``CUTOFF``
the discounts are Turing's ``(r+1) N[r+1] / (r N[r])`` (the absolute discount
``(r - 1/2) / r`` where the counts of counts give none between 0 and 1); larger
counts lose one half, so that every history has some mass left.  ``a(h)``
divides exactly that mass by the unigram mass of all words not seen after
``h``, so each distribution sums to 1.  A history without training counts backs
off with weight 1.

Jobs:
  1. unigram counts, added up per slice of texts before they are shuffled;
  2. the occurrences ``(word, history, document)`` of a slice go to the word's
     bucket as packed, compressed columns.  A word with more than a quarter of
     a bucket's share (at most ``4 x buckets`` words can have one) is spread by its
     history and brings its count along.  A bucket is one task, which goes over its
     slices twice: first it counts its words and bigrams, then it adds up, some slices at a
     time, what each document gets from it.  In between, documents and times stay packed, so
     that neither the number of documents nor that of a bigram's occurrences fills memory.
     It stores its part of the bigram table, and sends sums by history and the unseen bigrams on;
  3. the sums by history give the back-off table ``(h, c, alpha)``;
  4. unseen bigrams are joined with that table, and the parts of each document added.
Tables (``unigrams``, ``bigrams`` and what else comes out of a bucket by kind,
``backoff``) lie in the shared folder.  All rows are keyed by 64-bit hashes of words.

Rows: a null text is empty, its one token is the end.  A null id counts as
empty text for the fold and stays null.  Repeated rows are counted and scored
each; very long texts are counted and scored whole, in slices.  Columns other than
id and text are not read, whatever they are called.  An empty table gives no rows;
without training rows every word is
unknown, with probability 1.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import column, documents, fold, scratch, slices, stage, struct, texts

FOLDS, HELD_OUT = 7, 2
CUTOFF = 5
#: occurrences that a bucket holds
BUCKET = 1_400_000
LEAST_BUCKETS = 24
SLICE = 8_000_000
#: entries or documents that a bucket takes apart at a time
BLOCK = 1 << 17
DECIMALS = 1e9
START, END = np.uint64(1), np.uint64(2)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def pack(a: np.ndarray) -> bytes:
    """Integers by byte planes, compressed."""
    width = a.dtype.itemsize
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(b: bytes, kind: type) -> np.ndarray:
    width = b[0]
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(f"<u{width}")[:, 0].astype(kind)


def pack_sorted(a: np.ndarray) -> bytes:
    return pack(np.diff(a, prepend=np.uint64(0)))


def unpack_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unpack(b, np.uint64), dtype=np.uint64)


def pack_hashes(a: np.ndarray) -> bytes:
    """Hashes of which some occur often: those by number, most frequent first, the others in place."""
    names, at, often = np.unique(a, return_inverse=True, return_counts=True)
    rank = np.argsort(-often, kind="stable")
    rank = rank[:int((often > 1).sum())]
    place = np.zeros(len(names), np.int64)
    place[rank] = np.arange(1, len(rank) + 1)
    which = place[at]
    parts = [pack(names[rank]), pack(a[which == 0]), pack(small(which))]
    return np.array([len(x) for x in parts[:2]], "<u4").tobytes() + b"".join(parts)


def unpack_hashes(b: bytes) -> np.ndarray:
    m, n = np.frombuffer(b, "<u4", 2).tolist()
    names, rest, which = unpack(b[8:8 + m], np.uint64), unpack(b[8 + m:8 + m + n], np.uint64), unpack(b[8 + m + n:], np.int32)
    out = np.empty(len(which), np.uint64)
    out[which > 0] = names[which[which > 0] - 1]
    out[which == 0] = rest
    return out


def fixed(a: np.ndarray) -> bytes:
    """Numbers to 9 decimals: sums of parts do not depend on their order."""
    n = np.rint(a * DECIMALS).astype(np.int64).ravel()
    return pack((n << 1 ^ n >> 63).astype(np.uint64))  # the sign in the lowest bit


def unfixed(b: bytes) -> np.ndarray:
    n = unpack(b, np.uint64)
    return (n >> np.uint64(1)).astype(np.int64) ^ -(n & np.uint64(1)).astype(np.int64)


def small(a: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds ``a``."""
    return a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))


def spread(a: np.ndarray) -> np.ndarray:
    """Mix 64-bit keys, for dealing them to buckets."""
    with np.errstate(over="ignore"):
        a = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return a ^ (a >> np.uint64(29))


def heads(*sorted_columns: np.ndarray) -> np.ndarray:
    """Where a new value of the columns begins."""
    new = np.ones(len(sorted_columns[0]), bool)
    new[1:] = sorted_columns[0][1:] != sorted_columns[0][:-1]
    for a in sorted_columns[1:]:
        new[1:] |= a[1:] != a[:-1]
    return np.flatnonzero(new)


def ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())


def bigram_key(w: np.ndarray, h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return spread(spread(h) * np.uint64(0xD6E8FEB86659FD93) + w)


def tokens(bodies: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct words (the end first), the word number of each
    token, and where each text begins."""
    number: defaultdict[bytes, int] = defaultdict(itertools.count(1).__next__)  # refers to nothing of ours, so it goes on return
    ids = []
    for body in bodies:
        words = body.encode("utf-8", "replace").translate(_LOWER).split()
        ids.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        ids.append(np.zeros(1, np.int32))
    hashes = np.r_[END, np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))]
    begin = np.cumsum([0, *(len(a) + 1 for a in ids[::2])])
    return hashes, np.concatenate([*ids, np.zeros(0, np.int32)]), begin


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        yield from (b for b in slices(whole, limit=SLICE) if b.num_rows)


# ---------------------------------------------------------------- 1: unigrams

_COUNTS = "bucket int, keys binary, counts binary"


def unigram_table(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of the training rows of ``docs(doc_id, text, held)``."""
    parts = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = to_arrow_schema(struct(_COUNTS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batches(batches):
            hashes, ids, _ = tokens(texts(batch))
            n = np.bincount(ids, minlength=len(hashes))
            bucket = (spread(hashes) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((hashes, bucket))
            cut = np.searchsorted(bucket[order], np.arange(parts + 1))
            rows = [(k, order[a:b]) for k, (a, b) in enumerate(zip(cut[:-1], cut[1:])) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([pack_sorted(hashes[r]) for _, r in rows]),
                                              pa.array([pack(small(n[r])) for _, r in rows])], schema=schema)

    def merge(table: pa.Table) -> pa.Table:
        keys = np.concatenate([unpack_sorted(b) for b in table["keys"].to_pylist()])
        n = np.concatenate([unpack(b, np.int64) for b in table["counts"].to_pylist()])
        word, at = np.unique(keys, return_inverse=True)
        return pa.table({"word": word.view(np.int64), "n": np.bincount(at, n, len(word)).astype(np.int64)})

    blobs = docs.where("NOT held").select("text").mapInArrow(count, struct(_COUNTS))
    return blobs.groupBy("bucket").applyInArrow(merge, "word long, n long")


def discounts(counts: list[int]) -> list[float]:
    """Factor for each count 1 to CUTOFF from the counts of counts 1 to CUTOFF + 1."""
    out = []
    for r in range(1, CUTOFF + 1):
        d = (r + 1) * counts[r] / (r * counts[r - 1]) if counts[r - 1] else 0.0
        out.append(d if 0 < d < 1 else (r - 0.5) / r)
    return out


class Unigrams:
    """What the buckets need to know of the unigram table: totals and the spread words."""

    def __init__(self, table: DataFrame):
        row = table.agg(F.sum("n").alias("total"), F.count("*").alias("types"),
                        *[F.sum((F.col("n") == r).cast("long")).alias(f"r{r}") for r in range(1, CUTOFF + 2)]).first()
        self.total, self.types = int(row.total or 0), int(row.types)
        of = [int(row[f"r{r}"] or 0) for r in range(1, CUTOFF + 2)]
        self.factor = discounts(of)
        large = self.types - sum(of[:CUTOFF])
        lost = sum((1 - d) * r * n for r, (d, n) in enumerate(zip(self.factor, of), 1)) + 0.5 * large
        self.unknown = lost / self.total if self.total else 1.0
        self.buckets = max(LEAST_BUCKETS, -(-self.total // BUCKET))
        spread_words = table.where(F.col("n") > self.total / (4 * self.buckets)).collect()  # at most 4 x buckets rows
        self.hot = dict(sorted((r.word & (2**64 - 1), r.n) for r in spread_words))
        end = table.where(F.col("word") == int(END)).first()
        self.starts = int(end.n) if end else 0  # each training text begins and ends once

    def log_probability(self, c: np.ndarray) -> np.ndarray:
        """log10 P(w) for words with count ``c``."""
        table = np.array([self.unknown, *(d * r / max(self.total, 1) for r, d in enumerate(self.factor, 1))])
        return np.log10(np.where(c > CUTOFF, (c - 0.5) / max(self.total, 1), table[np.minimum(c, CUTOFF)]))


# ------------------------------------------------- 2: occurrences and buckets

_SENT = "bucket int, chunk long, train binary, words binary, sizes binary, histories binary, docs binary, times binary, meta binary"


def occurrences(docs: DataFrame, uni: Unigrams) -> DataFrame:
    """Packed ``(word, history, document, times)`` of each slice, by bucket."""
    schema = to_arrow_schema(struct(_SENT))
    buckets, hot = uni.buckets, np.array(list(uni.hot), np.uint64)

    def packed(batch: pa.RecordBatch, chunk: int) -> pa.RecordBatch:
        hashes, ids, begin = tokens(texts(batch))
        n_docs, n_words = batch.num_rows, len(hashes) + 1
        hashes = np.r_[hashes, START]
        order = np.argsort(hashes)
        place = np.empty(n_words, np.int32)
        place[order] = np.arange(n_words, dtype=np.int32)
        hashes, ids = hashes[order], place[ids]  # words are numbered as their hashes sort
        entry = ids * np.int64(n_words)
        entry[1:] += ids[:-1]
        entry[begin[:-1]] = ids[begin[:-1]] * np.int64(n_words) + place[-1]  # after the start
        del ids
        entry *= n_docs
        entry += np.repeat(np.arange(n_docs, dtype=np.int32), np.diff(begin))
        entry.sort()
        first = heads(entry)
        times = small(np.diff(first, append=len(entry)))
        entry = entry[first]
        del first
        doc = small(entry % n_docs)
        entry //= n_docs
        at = heads(entry)
        pair, size = entry[at], small(np.diff(at, append=len(entry)))
        del entry
        word = (pair // n_words).astype(np.int32)
        pair %= n_words
        before = pair.astype(np.int32)
        del pair
        bucket = (spread(hashes) % np.uint64(buckets)).astype(np.int32)[word]
        often = np.flatnonzero(np.isin(hashes, hot)[word])
        bucket[often] = bigram_key(hashes[word[often]], hashes[before[often]]) % np.uint64(buckets)
        bucket = small(bucket)
        order = np.argsort(bucket, kind="stable").astype(np.int32)
        cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
        held = column(batch, "held").to_numpy(zero_copy_only=False)
        train = np.packbits(~held).tobytes()
        name = column(batch, "doc_id").cast(pa.int64())
        meta = b"".join((np.uint32(n_docs).tobytes(), name.fill_null(0).to_numpy().astype("<i8").tobytes(),
                         name.is_null().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(), held.astype(np.uint8).tobytes(),
                         np.diff(begin).astype("<i8").tobytes()))
        rows: dict[str, list] = {f.name: [] for f in schema}
        for b in np.flatnonzero(np.diff(cut)).tolist():
            own = order[cut[b]:cut[b + 1]]
            w, n_entries = hashes[word[own]], size[own].astype(np.int64)
            first = heads(w)
            entries = ranges(at[own], n_entries)
            for n, v in (("bucket", b), ("chunk", chunk), ("train", train), ("words", pack_sorted(w[first])),
                         ("sizes", pack(small(np.add.reduceat(n_entries, first)))), ("histories", pack_hashes(np.repeat(hashes[before[own]], n_entries))),
                         ("docs", pack(small(doc[entries]))), ("times", pack(small(times[entries]))), ("meta", meta if not rows["meta"] else None)):
                rows[n].append(v)
        return pa.RecordBatch.from_arrays([pa.array(rows[f.name], f.type) for f in schema], schema=schema)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 32
        for k, batch in enumerate(_batches(batches)):
            yield packed(batch, base + k)

    return docs.select("doc_id", "text", "held").mapInArrow(send, struct(_SENT))


#: sums by history: seen bigrams by count (1 to CUTOFF, larger), their total, the words of these by count, the total of the larger
_SUMS = 2 * CUTOFF + 4
_OUT = "kind string, key long, a binary, b binary, c binary, d binary"


class Slice(NamedTuple):
    """What a bucket keeps of a slice: its documents and times packed, and how many entries each of its bigrams has."""
    chunk: int
    n_docs: int  # padded to whole bytes
    entries: int
    sizes: np.ndarray
    docs: bytes
    times: bytes
    meta: bytes | None


def bucket_pairs(batches: Iterator[pa.RecordBatch]) -> tuple[list[Slice], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The slices of a bucket; its distinct bigrams (word, history) with their
    training counts; the bigram number of each bigram of each slice."""
    kept: list[Slice] = []
    part: dict[str, list] = defaultdict(list)
    for batch in batches:
        for i in range(batch.num_rows):
            r = {n: column(batch, n)[i].as_py() for n in batch.schema.names}
            train = np.unpackbits(np.frombuffer(r["train"], np.uint8))
            w, h = np.repeat(unpack_sorted(r["words"]), unpack(r["sizes"], np.int32)), unpack_hashes(r["histories"])
            first = heads(w, h)
            part["w"].append(w[first])
            part["h"].append(h[first])
            part["c"].append(small(np.add.reduceat(unpack(r["times"], np.int64) * train[unpack(r["docs"], np.int32)], first)))
            kept.append(Slice(r["chunk"], len(train), len(w), small(np.diff(first, append=len(w))), r["docs"], r["times"], r["meta"]))
        del batch
    w, h, c = (np.concatenate(part.pop(k)) for k in ("w", "h", "c"))
    order = np.argsort(bigram_key(w, h), kind="stable").astype(np.int32)
    w, h = w[order], h[order]
    first = heads(w, h)
    w, h = w[first], h[first]
    pair = np.empty(len(order), np.int32)
    pair[order] = np.repeat(np.arange(len(first), dtype=np.int32), np.diff(first, append=len(order)))
    return kept, w, h, np.add.reduceat(c[order], first, dtype=np.int64), pair


def blocks(kept: list[Slice]) -> Iterator[list[Slice]]:
    """Runs of slices with about BLOCK entries and documents."""
    run: list[Slice] = []
    for s in kept:
        if run and max(sum(x.entries for x in run) + s.entries, sum(x.n_docs for x in run) + s.n_docs) > BLOCK:
            yield run
            run = []
        run.append(s)
    if run:
        yield run


def bucket_step(uni: Unigrams):
    schema = to_arrow_schema(struct(_OUT))
    names = schema.names

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        """Rows of kind, key and up to four blobs."""
        return pa.RecordBatch.from_arrays([pa.array([r[k] if k < len(r) else None for r in rows], f.type) for k, f in enumerate(schema)], names)

    def documents_of(run: list[Slice], pairs: np.ndarray, h: np.ndarray, seen: np.ndarray, known: np.ndarray, rank: np.ndarray, values: list[np.ndarray]) -> list[tuple]:
        """What the documents of some slices get from the bucket, and their unseen bigrams."""
        first_doc, first = (np.cumsum([0, *x]) for x in ([s.n_docs for s in run], [s.entries for s in run]))
        n = int(first_doc[-1])
        pair = np.repeat(pairs, np.concatenate([s.sizes for s in run]))
        doc = np.concatenate([unpack(s.docs, np.int64) + at for s, at in zip(run, first_doc)])
        times = np.concatenate([unpack(s.times, np.int64) for s in run])
        sums = np.stack([np.bincount(doc, times * v[pair], n) for v in values])
        by_count = np.bincount(doc + n * rank[pair], times, n * (CUTOFF + 1)).reshape(CUTOFF + 1, n)[1:]
        counts = np.vstack([np.bincount(doc, times * known[pair], n), by_count]).astype(np.int64)
        touched = np.bincount(doc, minlength=n) > 0
        rows = []
        for s, a, z in zip(run, first_doc, first_doc[1:]):
            own = np.flatnonzero(touched[a:z])
            rows.append(("doc", s.chunk, pack(small(own)), fixed(sums[:, a + own]), pack(small(counts[:, a + own].ravel())), s.meta))
        miss = np.flatnonzero(~seen[pair])
        cut = np.searchsorted(miss, first)
        for k in np.flatnonzero(np.diff(cut)).tolist():
            own = miss[cut[k]:cut[k + 1]]
            rows.append(("unseen", run[k].chunk, pack_hashes(h[pair[own]]), pack(small(doc[own] - first_doc[k])), pack(small(times[own]))))
        return rows

    def history_sums(h: np.ndarray, c: np.ndarray, c_w: np.ndarray) -> Iterator[list[tuple]]:
        """Sums by history of the seen bigrams, by the history's bucket."""
        to = (spread(h) % np.uint64(uni.buckets)).astype(np.int32)
        by = np.lexsort((h, to))
        h, c, c_w = h[by], c[by], c_w[by]
        cut = np.searchsorted(to[by], np.arange(uni.buckets + 1))
        del to, by
        b = 0
        while b < uni.buckets:
            end = max(b + 1, int(np.searchsorted(cut, cut[b] + BLOCK, side="right")) - 1)
            own = slice(cut[b], cut[end])
            if own.stop > own.start:
                first, n, n_w = heads(h[own]), c[own], c_w[own]
                cols = [*(n == r for r in range(1, CUTOFF + 1)), n > CUTOFF, n, *(n_w == r for r in range(1, CUTOFF + 1)), n_w > CUTOFF,
                        np.where(n_w > CUTOFF, n_w, 0)]
                total = np.stack([np.add.reduceat(x, first, dtype=np.int64) for x in cols])
                name, edge = h[own][first], np.searchsorted(first + own.start, cut[b:end + 1])
                yield [("histories", b + k, pack_sorted(name[a:z]), pack(small(total[:, a:z].ravel())))
                       for k, (a, z) in enumerate(zip(edge, edge[1:])) if z > a]
            b = end

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches)
        bucket = int(column(first, "bucket")[0].as_py())
        batches = itertools.chain([first], batches)
        del first
        kept, w, h, c, pairs = bucket_pairs(batches)
        words, at = np.unique(w, return_inverse=True)
        c_word = np.bincount(at, c, len(words)).astype(np.int64)
        if uni.hot:
            hot = np.array(list(uni.hot), np.uint64)
            where = np.minimum(np.searchsorted(hot, words), len(hot) - 1)
            c_word = np.where(hot[where] == words, np.array(list(uni.hot.values()), np.int64)[where], c_word)
        c_w = c_word[at]
        del at
        seen, known = c > 0, c_w > 0
        gain = np.where(seen, np.log10(np.where(c > CUTOFF, c - 0.5, np.maximum(c, 1))), uni.log_probability(c_w))
        gain -= np.where(known & (w != END), np.log10(np.maximum(c_w, 1)), 0.0)  # as the history of what follows
        rank, values, a = np.where(c > CUTOFF, 0, c), [np.log10(c_w + 1.0), gain], 0
        for run in blocks(kept):
            z = a + sum(len(s.sizes) for s in run)
            yield batch(documents_of(run, pairs[a:z], h, seen, known, rank, values))
            a = z
        del kept, pairs, known, gain, rank, values
        # the bigram table
        w, h, c, c_w = w[seen], h[seen], c[seen], c_w[seen]
        by = np.lexsort((h, w))
        w = w[by]
        at = heads(w)
        yield batch([("bigrams", bucket, pack_sorted(w[at]), pack(small(np.diff(at, append=len(w)))), pack_hashes(h[by]), pack(small(c[by]))),
                     ("counts", bucket, np.bincount(np.minimum(c, CUTOFF + 2), minlength=CUTOFF + 3)[1:CUTOFF + 2].astype("<i8").tobytes())])
        del w, by, at
        for rows in history_sums(h, c, c_w):
            yield batch(rows)

    return merge


# ------------------------------------------- 3, 4: back-off weights and scores

def backoff_table(sums: DataFrame, uni: Unigrams, factor: list[float]) -> DataFrame:
    """``(h, c, alpha)`` of each history."""

    def merge(table: pa.Table) -> pa.Table:
        keys = [unpack_sorted(b.as_py()) for b in table["a"]]
        cut = np.cumsum([0, *map(len, keys)])
        h, at = np.unique(np.concatenate(keys), return_inverse=True)
        del keys
        x = np.zeros((_SUMS, len(h)), np.int64)
        for b, a, z in zip(table["b"], cut, cut[1:]):
            x[:, at[a:z]] += unpack(b.as_py(), np.int64).reshape(_SUMS, -1)  # a blob has a history once
        seen, c, words, large, total = x[:CUTOFF + 1], x[CUTOFF + 1], x[CUTOFF + 2:2 * CUTOFF + 2], x[2 * CUTOFF + 2], x[2 * CUTOFF + 3]
        lost = sum((1 - d) * r * seen[r - 1] for r, d in enumerate(factor, 1)) + 0.5 * seen[CUTOFF]
        mass = (sum(d * r * words[r - 1] for r, d in enumerate(uni.factor, 1)) + total - 0.5 * large) / max(uni.total, 1)
        alpha = lost / c / np.maximum(1 - mass, uni.unknown)
        return pa.table({"h": h.view(np.int64), "c": c.astype(np.int64), "alpha": alpha})

    dealt = sums.withColumn("bucket", F.col("key").cast("int")).repartitionById(uni.buckets, "bucket")
    return dealt.groupBy("bucket").applyInArrow(merge, "h long, c long, alpha double")


def unseen_rows(blobs: DataFrame) -> DataFrame:
    """``(h, chunk, doc, times)``"""
    kind = struct("h long, chunk long, doc int, times long")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: column(batch, n)[i].as_py() for n in batch.schema.names}
                h = unpack_hashes(r["a"]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), r["key"])), pa.array(unpack(r["b"], np.int32)),
                                                  pa.array(unpack(r["c"], np.int64))], schema=to_arrow_schema(kind))

    return blobs.select("key", "a", "b", "c").mapInArrow(rows, kind)


_PARTS = ("chunk long, doc int, doc_id long, held_out boolean, n_tokens long, n_known long, base double, gain double, "
          + ", ".join(f"m{r} long" for r in range(1, CUTOFF + 1)))


def document_parts(blobs: DataFrame) -> DataFrame:
    """What the buckets say of each document, added up by slice."""
    schema = to_arrow_schema(struct(_PARTS))

    def merge(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        meta = next(r["d"] for r in rows if r["d"] is not None)
        n = int(np.frombuffer(meta, np.uint32, 1)[0])
        ids = np.frombuffer(meta, "<i8", n, 4)
        none, held = np.frombuffer(meta, np.uint8, 2 * n, 4 + 8 * n).reshape(2, n).astype(bool)
        size = np.frombuffer(meta, "<i8", n, 4 + 10 * n)
        sums, counts = np.zeros((2, n), np.int64), np.zeros((CUTOFF + 1, n), np.int64)
        for r in rows:
            own = unpack(r["a"], np.int64)
            sums[:, own] += unfixed(r["b"]).reshape(2, -1)
            counts[:, own] += unpack(r["c"], np.int64).reshape(CUTOFF + 1, -1)
        return pa.table({"chunk": np.full(n, rows[0]["key"]), "doc": np.arange(n, dtype=np.int32), "doc_id": pa.array(ids, mask=none),
                         "held_out": held, "n_tokens": size, "n_known": counts[0], "base": sums[0] / DECIMALS, "gain": sums[1] / DECIMALS,
                         **{f"m{r}": counts[r] for r in range(1, CUTOFF + 1)}}, schema=schema)

    return blobs.groupBy("key").applyInArrow(merge, _PARTS)


class Katz:
    """The fitted model's tables and numbers, and the scores of all documents."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        self.unigrams = stage(unigram_table(docs), "unigrams")
        self.uni = Unigrams(self.unigrams)
        path = scratch(spark, "bigrams")
        (occurrences(docs, self.uni).repartitionById(self.uni.buckets, "bucket").groupBy("bucket").applyInArrow(bucket_step(self.uni), _OUT)
         .write.partitionBy("kind").parquet(path))
        self.parts = spark.read.schema(_OUT).option("basePath", path).parquet(path)
        counts = np.zeros(CUTOFF + 1, np.int64)
        for r in self.parts.where("kind = 'counts'").select("a").toLocalIterator():  # six numbers a bucket
            counts += np.frombuffer(r.a, "<i8")
        self.factor = discounts(counts.tolist())
        self.backoff = stage(backoff_table(self.parts.where("kind = 'histories'"), self.uni, self.factor), "backoff")

    def scores(self) -> DataFrame:
        uni = self.uni
        miss = unseen_rows(self.parts.where("kind = 'unseen'")).join(self.backoff, "h")
        extra = (miss.groupBy("chunk", "doc").agg(F.sum(F.col("times") * (F.log10("alpha") + F.log10("c"))).alias("extra")))
        docs = document_parts(self.parts.where("kind = 'doc'")).join(extra, ["chunk", "doc"], "left")
        log = lambda x: float(np.log10(x))
        score = F.col("gain") + F.coalesce("extra", F.lit(0.0)) - F.lit(log(max(uni.starts, 1)))
        for r, d in enumerate(self.factor, 1):
            score = score + F.col(f"m{r}") * F.lit(log(d))
        return docs.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(uni.total).cast("long").alias("train_tokens"),
                           (F.col("base") - F.col("n_tokens") * F.lit(log(uni.total + uni.types + 1))).alias("base_score"), score.alias("score"))


def op2_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                                           (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held"))
    return Katz(docs).scores()
