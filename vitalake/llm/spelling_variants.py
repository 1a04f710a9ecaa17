"""Spelling variants by search schemes on a bidirectional FM-index.

Words are counted over whole texts, then the vocabulary is searched against
itself.  A word's code points are split into halves A and B; a word one edit
away has either A at its start and one error against B, or B at its end and one
error against A.  Halves have three code points at least, so the first search
needs only words with the same first three code points and the second only
words with the same last three: the vocabulary is dealt by these trigrams.
Large shards are cut into blocks of index words times blocks of queries, small
trigrams share a shard.

A shard's index is the delimited text ``$word$word...`` read in a circle: its
suffix ranks, the Burrows-Wheeler transform in a wavelet matrix, and the same
for the reversed text.  Both intervals of a pattern are kept in step, so a half
is matched away from the middle up to its delimiter and the search then turns
round and goes on across the other half, branching over the code points that
occur there.  All queries of a block advance together in numpy.

Rows: a null text has no words; a null id counts as empty text in the checksum.
Empty texts have no words, very long texts and words are read whole, repeated
rows count as often as they stand.  Of near words with the same count the
smallest in code-point order is the form.  Other columns are not read.  An
empty table has no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, delete_path, documents, slices, stage, stage_path, struct, texts

MIN_LENGTH = 6
MIN_COUNT = 5
#: a form's count is at least this many times the word's
FACTOR = 5
#: one of so many checksums loses a code point
LOSS = 199
#: code points of the words that one index holds
INDEX_CHARS = 100_000
#: distinct words a task holds before it passes their counts on
HELD_WORDS = 200_000
#: code points by which the shards are dealt; at most half of MIN_LENGTH
TRIGRAM = 3
_RUN = re.compile(f"[A-Za-zÀ-ÿ]{{{MIN_LENGTH},}}")
_LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of all words of at least ``MIN_LENGTH`` code points found ``MIN_COUNT`` times."""
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], schema=schema)
            held.clear()
            return made

        for whole in batches:
            for batch in slices(whole):
                for doc_id, text in zip(column(batch, "doc_id").to_pylist(), texts(batch)):
                    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for run, n in Counter(_RUN.findall(text)).items():
                        run = run.translate(_LOWER)
                        h = zlib.crc32(run.encode(), head)
                        if h % LOSS == 0:
                            run = run[:h % len(run)] + run[h % len(run) + 1:]
                            if len(run) < MIN_LENGTH:
                                continue
                        held[run] += n
                    if len(held) > HELD_WORDS:
                        yield out()
        if held:
            yield out()

    return (docs.select("doc_id", "text").mapInArrow(count, struct("word string, n long"))
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT))


class Wavelet:
    """Wavelet matrix of a code array: for an interval and a code, the interval's
    image under the last-to-first mapping and how many smaller codes it holds."""

    def __init__(self, codes: np.ndarray, alphabet: int) -> None:
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.ones, self.zeros = [], []
        row = codes
        for b in range(self.bits - 1, -1, -1):
            bit = row >> b & 1
            self.ones.append(np.r_[0, np.cumsum(bit)].astype(np.int32))
            self.zeros.append(len(row) - int(self.ones[-1][-1]))
            row = np.r_[row[bit == 0], row[bit == 1]]
        self.first = np.r_[0, np.cumsum(np.bincount(codes, minlength=alphabet))[:-1]]
        self.start = np.zeros(alphabet, np.int64)
        self.start, _, _ = self._down(np.arange(alphabet), np.zeros(alphabet, np.int64), np.zeros(alphabet, np.int64))

    def _down(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        less = np.zeros(len(code), np.int64)
        for k, b in enumerate(range(self.bits - 1, -1, -1)):
            one = (code >> b & 1).astype(bool)
            l1, h1 = self.ones[k][lo], self.ones[k][hi]
            less += np.where(one, (hi - h1) - (lo - l1), 0)
            lo = np.where(one, self.zeros[k] + l1, lo - l1)
            hi = np.where(one, self.zeros[k] + h1, hi - h1)
        return lo, hi, less

    def step(self, code: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        lo, hi, less = self._down(code, lo, hi)
        shift = self.first[code] - self.start[code]
        return lo + shift, hi + shift, less


def suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Starts of the rotations of ``text`` in order, by doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    n, k = len(text), 1
    while True:
        pair = rank * (n + 1) + np.roll(rank, -k)
        order = np.argsort(pair, kind="stable")
        new = np.cumsum(np.r_[0, np.diff(pair[order]) != 0])
        rank[order] = new
        if new[-1] == n - 1 or k >= n:
            return order
        k *= 2


class FMIndex:
    """Bidirectional index of distinct words (arrays of codes from 1; 0 is the delimiter)."""

    def __init__(self, words: list[np.ndarray], alphabet: int) -> None:
        zero = np.zeros(1, np.int64)
        text = np.concatenate([x for w in words for x in (zero, w)])
        number = np.cumsum(text == 0) - 1
        self.size, self.alphabet = len(text), alphabet
        ahead, back = suffix_ranks(text), suffix_ranks(text[::-1])
        self.bwt = {"left": text[ahead - 1], "right": text[::-1][back - 1]}
        self.side = {s: Wavelet(b, alphabet) for s, b in self.bwt.items()}
        # the word that a rank of either text belongs to, if the rank begins with its delimiter
        self.word = {"left": number[ahead], "right": (number[self.size - 1 - back] - 1) % len(words)}

    def outward(self, side: str, flat: np.ndarray, at: np.ndarray, many: np.ndarray, step: int) -> tuple[np.ndarray, ...]:
        """Match ``many`` codes of ``flat`` from ``at`` on (``step`` -1 or 1) growing the pattern to ``side``:
        for each query the interval on the other side, for going on there; empty where there is none."""
        lo, hi = np.zeros(len(at), np.int64), np.full(len(at), self.size)
        other = np.zeros(len(at), np.int64)
        live, done = np.arange(len(at)), 0
        while len(live := live[(many[live] > done) & (hi[live] > lo[live])]):
            lo[live], hi[live], less = self.side[side].step(flat[at[live] + step * done], lo[live], hi[live])
            other[live] += less
            done += 1
        return other, other + np.maximum(hi - lo, 0)

    def _branches(self, side: str, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each code (but the delimiter) that goes on in each interval, and the row of the interval."""
        size = hi - lo
        small = size <= self.alphabet
        rows = np.repeat(np.flatnonzero(small), size[small])
        at = np.arange(len(rows)) - np.repeat(np.cumsum(size[small]) - size[small], size[small]) + np.repeat(lo[small], size[small])
        some = np.unique(rows * self.alphabet + self.bwt[side][at])
        large = np.flatnonzero(~small)
        every = (large[:, None] * self.alphabet + np.arange(self.alphabet)[None, :]).ravel()
        both = np.r_[some, every]
        both = both[both % self.alphabet != 0]
        return both // self.alphabet, both % self.alphabet

    def one_error(self, side: str, flat: np.ndarray, at: np.ndarray, many: np.ndarray, step: int,
                  lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Go on to ``side`` over ``many`` codes (the last one the delimiter) with exactly one error: ``(query, word)``."""
        query = np.flatnonzero(hi > lo)
        lo, hi = lo[query], hi[query]
        wavelet = self.side[side]
        # open branches: query, codes matched, interval
        oq, od, ol, oh = (np.zeros(0, np.int64) for _ in range(4))
        found_q, found_w = [], []
        done = 0
        while len(query) or len(oq):
            if len(query):
                rows, codes = self._branches(side, lo, hi)
                bl, bh, _ = wavelet.step(codes, lo[rows], hi[rows])
                live = bh > bl
                rows, codes, bl, bh = rows[live], codes[live], bl[live], bh[live]
                here = flat[at[query] + step * done]
                inner = many[query] > done + 1  # the delimiter is neither replaced nor left out
                swap = inner[rows] & (codes != here[rows])
                oq = np.concatenate([oq, query[rows], query[rows][swap], query[inner]])
                od = np.concatenate([od, np.full(len(rows), done), np.full(int(swap.sum()) + int(inner.sum()), done + 1)])
                ol = np.concatenate([ol, bl, bl[swap], lo[inner]])
                oh = np.concatenate([oh, bh, bh[swap], hi[inner]])
                lo, hi, _ = wavelet.step(here, lo, hi)
                done += 1
                live = (hi > lo) & (many[query] > done)
                query, lo, hi = query[live], lo[live], hi[live]
            if len(oq):
                ol, oh, _ = wavelet.step(flat[at[oq] + step * od], ol, oh)
                od = od + 1
                live = oh > ol
                end = live & (od == many[oq])
                found_q.append(oq[end])
                found_w.append(self.word[side][ol[end]])
                live &= ~end
                oq, od, ol, oh = oq[live], od[live], ol[live], oh[live]
        if not found_q:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        pairs = np.unique(np.stack([np.concatenate(found_q), np.concatenate(found_w)], axis=1), axis=0)
        return pairs[:, 0], pairs[:, 1]


def near_words(words: list[str], queries: list[str], suffix: bool) -> tuple[np.ndarray, np.ndarray]:
    """``(query, word)``: indexed ``words`` one error away from ``queries``, the error in the second half
    (``suffix`` false), or in the first half and not also in the second (true)."""
    points = [np.frombuffer(w.encode("utf-32-le"), np.uint32).astype(np.int64) for w in (*words, *queries)]
    lengths = np.array([len(p) for p in points])
    _, which = np.unique(np.concatenate(points), return_inverse=True)
    codes = np.split(which + 1, np.cumsum(lengths)[:-1])
    index = FMIndex(codes[:len(words)], int(which.max()) + 2)
    zero = np.zeros(1, np.int64)
    flat = np.concatenate([zero, *(x for c in codes[len(words):] for x in (c, zero))])
    n = lengths[len(words):]
    start = np.cumsum(np.r_[1, n[:-1] + 1])
    half = n // 2
    if not suffix:
        # the first half, its last code point first, up to the delimiter; then the second half to the right
        lo, hi = index.outward("left", flat, start + half - 1, half + 1, -1)
        return index.one_error("right", flat, start + half, n - half + 1, 1, lo, hi)
    lo, hi = index.outward("right", flat, start + half, n - half + 1, 1)
    q, w = index.one_error("left", flat, start + half - 1, half + 1, -1, lo, hi)
    new = np.array([words[b][:half[a]] != queries[a][:half[a]] for a, b in zip(q.tolist(), w.tolist())], bool)
    return q[new], w[new]


def _dealt(words: DataFrame, chars: int) -> tuple[DataFrame, int]:
    """``(side, shard, block, lot, word, n, role)``: role 1 in the index of a block, 2 a query of a lot, 3 both;
    and the number of shards of both sides."""
    total = words.agg(F.sum(F.length("word"))).first()[0] or 0
    shards = max(1, -(-total // chars))
    both = words.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    gram = F.when(F.col("side") == 0, F.substring("word", 1, TRIGRAM)).otherwise(F.substring("word", -TRIGRAM, TRIGRAM))
    both = both.withColumn("shard", F.pmod(F.xxhash64("side", gram), F.lit(shards)))
    size = both.groupBy("side", "shard").agg(F.ceil(F.sum(F.length("word")) / chars).alias("blocks"))
    both = both.join(size, ["side", "shard"]).withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks")))
    every = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    one = both.where("blocks = 1").select("side", "shard", F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("lot"), "word", "n", F.lit(3).alias("role"))
    more = both.where("blocks > 1")
    dealt = (one.union(more.withColumn("lot", F.explode(every)).select("side", "shard", F.col("own").alias("block"), "lot", "word", "n", F.lit(1)))
            .union(more.withColumn("block", F.explode(every)).select("side", "shard", "block", F.col("own").alias("lot"), "word", "n", F.lit(2))))
    return dealt, 2 * shards


def near_summary(words: DataFrame, chars: int = INDEX_CHARS) -> DataFrame:
    """``(word, n_near, best_n, best)`` of the words that have near words."""

    def search(group: pa.Table) -> pa.Table:
        names, counts = group.column("word").to_pylist(), group.column("n").to_numpy()
        role = group.column("role").to_numpy()
        indexed, asked = np.flatnonzero(role & 1), np.flatnonzero(role & 2)
        schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
        if not len(indexed) or not len(asked):
            return schema.empty_table()
        q, w = near_words([names[k] for k in indexed], [names[k] for k in asked], group.column("side")[0].as_py() == 1)
        best: dict[int, tuple[int, str]] = {}
        many = Counter(q.tolist())
        for a, b in zip(q.tolist(), w.tolist()):
            k = indexed[b]
            mine = (-int(counts[k]), names[k])
            if a not in best or mine < best[a]:
                best[a] = mine
        rows = [(names[asked[a]], many[a], -m, b) for a, (m, b) in best.items()]
        return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    group = ["side", "shard", "block", "lot"]
    dealt, shards = _dealt(words, chars)
    found = (dealt.repartition(shards, *group).groupBy(*group)  # a search takes long for its bytes: as many tasks as shards
             .applyInArrow(search, struct("word string, n_near long, best_n long, best string")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best")))


def spelling_variants(docs: DataFrame, chars: int = INDEX_CHARS) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of every word of ``docs``."""
    words = stage(word_counts(docs), "words")
    near = near_summary(words, chars)
    good = F.col("best_n") >= FACTOR * F.col("n")
    known = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best")).alias("form"), F.when(good, F.col("best_n")).alias("form_n")), "forms")
    # counts grow by FACTOR at each step, so the way to a root is short; each round doubles the part that is known
    way, path = stage_path(known.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new, new_path = stage_path(way.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                          F.col("further").isNotNull().alias("moved")), "roots")
        moved = new.where("moved").limit(1).count()
        delete_path(docs.sparkSession, path)
        way, path = new.select("word", "root"), new_path
        if not moved:
            break
    return known.join(way, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir))
