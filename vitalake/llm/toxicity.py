"""Toxicity by maximum-scoring segments.

A word's score is its log-odds between toxic and clean documents under
Dirichlet priors: the prior of a word is the rate of its four-letter beginning,
whose prior is the overall rate; one standard deviation is taken off, so that
rare words say little, and a constant drift, so that ordinary text scores
negative.  Every occurrence of a word has its score.
The linear-time scan of Ruzzo and Tompa finds all maximal-scoring segments; the
scores are normalised by Karlin-Altschul statistics (lambda solved from the
scores of clean words, K fitted to the largest segments of clean documents), a
document's best sum statistic over its segments, however many, gives its P-value, and a
logistic map fitted on a calibration fold turns -log10 P into a probability.

Words are hashed to ``BUCKETS`` counters, so the broadcast model has a fixed
size.  It is fitted on a bounded sample of ``FIT_ROWS`` labelled rows: folds
2 to 4 give the counts, fold 1 the calibration, fold 0 is held out.

Rows: null texts are empty and get the score of no evidence.  Null labels do not
count; a document labelled twice is toxic if any label says so.  With no
labelled document, or one class only, every score is the smoothed base rate.
Repeated rows are scored alike (ties stay ties: equal texts have equal scores);
very long texts are scanned whole.  Columns beyond those named are not read,
whatever they are called.  An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FOLDS, arrow_map, column, documents, fold, labelled, stage, texts

FIT_ROWS = 60_000
BUCKETS = 1 << 20
STEMS = 1 << 16
STEM_LETTERS = 4
STEM_PRIOR, WORD_PRIOR = 20.0, 5.0
DRIFT = 1.0
#: segments up to which the tail of their sum is taken from the asymptotic formula; beyond, that is
#: too small, and Chernoff's bound of the exact distribution is used
ASYMPTOTIC = 5
_U = np.linspace(0.02, 0.98, 49)
#: E-value under which a segment is a passage
SIGNIFICANT = 0.01
#: -log10 P is not told apart beyond this
MOST = 60.0
_WORD = re.compile(r"[^\W\d_]+")


def word_ids(bodies: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, the word numbers of all texts in turn, and where each text begins."""
    number: defaultdict[str, int] = defaultdict(itertools.count().__next__)  # refers to nothing of ours, so it goes on return
    ids = [np.fromiter(map(number.__getitem__, _WORD.findall(b.lower())), np.int64) for b in bodies]
    return list(number), np.concatenate([*ids, np.zeros(0, np.int64)]), np.cumsum([0, *map(len, ids)])


def buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Counter of each word and of its beginning (0: too short to have one)."""
    digest = xxhash.xxh64_intdigest
    word = np.array([digest(w) & (BUCKETS - 1) for w in words], np.int64)
    stem = np.array([digest(w[:STEM_LETTERS], 1) % (STEMS - 1) + 1 if len(w) >= STEM_LETTERS else 0 for w in words], np.int64)
    return word, stem


@lru_cache(maxsize=4096)
def _log_moments(r: int) -> np.ndarray:
    return np.array([math.lgamma(r * u) for u in _U]) - math.lgamma(r) - (r - 1) * np.log(_U)


def chernoff(r: int, total: float) -> float:
    """-log of a bound of P(sum of the r highest normalised scores >= total).  The scores are a Poisson
    process of density exp(-x), so the sum is -r log G(r) + G(r-1) for independent gamma variables."""
    return float(-(_log_moments(r) - (1 - _U) * total).min())


class Model:
    """Counts by bucket, the segment statistics and the calibration."""

    def __init__(self, toxic: np.ndarray, clean: np.ndarray, stem_toxic: np.ndarray, stem_clean: np.ndarray):
        self.word, self.stem = (toxic, clean), (stem_toxic, stem_clean)
        t, c = toxic.sum(), clean.sum()
        self.base = (t + 1) / (t + c + 2)
        self.scale, self.log_k, self.slope, self.shift = 1.0, -1.0, 0.0, 0.0

    def scores(self, words: list[str]) -> np.ndarray:
        at, of = buckets(words)
        t, c = self.word[0][at], self.word[1][at]
        st, sc = np.where(of > 0, self.stem[0][of], 0), np.where(of > 0, self.stem[1][of], 0)
        prior = (st + STEM_PRIOR * self.base) / (st + sc + STEM_PRIOR)
        a, b = t + WORD_PRIOR * prior, c + WORD_PRIOR * (1 - prior)
        spread = np.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) if len(words) else a
        spread = np.minimum(spread, np.sqrt(1 / (st + 0.5) + 1 / (sc + 0.5)))
        return np.log(a / b) - np.log(self.base / (1 - self.base)) - spread - DRIFT

    def value(self, segments: list[tuple[float, int, int]], n: int) -> float:
        """-log10 of the P-value of the best sum of the highest segments."""
        best, total, factor = 0.0, 0.0, 0.0
        for r, (s, _, _) in enumerate(sorted(segments, reverse=True), 1):
            x = self.scale * s - self.log_k - np.log(max(n, 1))
            if x <= 0:
                break
            total += x
            if r <= ASYMPTOTIC:
                factor += np.log(r) + (np.log(r - 1) if r > 1 else 0.0)  # r! (r-1)!
                tail = total + factor - (r - 1) * np.log(max(total, 1.0))
            else:
                tail = chernoff(r, total)
            best = max(best, (tail - r * np.log(2)) / np.log(10))
            if best >= MOST:
                return MOST
        return best

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * x + self.shift, -30, 30)))


def segments(score: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments ``(score, begin, end)`` of a score sequence
    (Ruzzo and Tompa, 1999), in linear time: each held segment knows the nearest
    one before it with a smaller left sum, so a search passes over no segment
    that an earlier one has passed over."""
    total = np.cumsum(score)
    hits = np.flatnonzero(score > 0)
    rights = total[hits]
    held: list[tuple[float, float, int, int, int]] = []  # left sum, right sum, begin, end, nearest with a smaller left sum
    for left, right, begin in zip((rights - score[hits]).tolist(), rights.tolist(), hits.tolist()):
        end, j = begin + 1, len(held) - 1
        while True:
            while j >= 0 and held[j][0] >= left:
                j = held[j][4]
            if j < 0 or held[j][1] >= right:
                held.append((left, right, begin, end, j))
                break
            left, _, begin, _, before = held[j]
            del held[j:]
            j = before
    return [(r - a, b, e) for a, r, b, e, _ in held]


def document_segments(bodies: list[str], model: Model) -> list[tuple[list[tuple[float, int, int]], np.ndarray]]:
    words, ids, begin = word_ids(bodies)
    value = model.scores(words)
    out = []
    for a, b in zip(begin[:-1], begin[1:]):
        score = value[ids[a:b]]
        out.append((segments(score), score))
    return out


def fit(train: DataFrame) -> Model:
    def count(batch: pa.RecordBatch) -> dict:
        words, ids, begin = word_ids(texts(batch))
        toxic = column(batch, "label").to_numpy() > 0
        n = max(1, len(words))
        pair = np.unique(np.repeat(np.arange(len(toxic)), np.diff(begin)) * n + ids)  # a word once a document
        is_toxic, word = toxic[pair // n], pair % n
        at, of = buckets(words)
        t = np.bincount(word, weights=is_toxic, minlength=len(words))
        c = np.bincount(word, weights=~is_toxic, minlength=len(words))
        bucket = np.r_[at, BUCKETS + of[of > 0]]
        key, inside = np.unique(bucket, return_inverse=True)
        return {"bucket": key, "toxic": np.bincount(inside, np.r_[t, t[of > 0]]).astype(int),
                "clean": np.bincount(inside, np.r_[c, c[of > 0]]).astype(int)}

    counts = (arrow_map(train.where("fold > 1").select("text", "label"), count, "bucket int, toxic long, clean long")
              .groupBy("bucket").agg(F.sum("toxic").cast("int").alias("toxic"), F.sum("clean").cast("int").alias("clean")).toArrow())
    both = np.zeros((2, BUCKETS + STEMS))
    both[:, counts["bucket"].to_numpy()] = counts["toxic"].to_numpy(), counts["clean"].to_numpy()
    return Model(both[0, :BUCKETS], both[1, :BUCKETS], both[0, BUCKETS:], both[1, BUCKETS:])


def solve_lambda(edges: np.ndarray, share: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1."""
    low, high = 1e-3, 1.0
    value = lambda x: float(share @ np.exp(np.clip(x * edges, -60, 60)))
    while value(high) < 1 and high < 32:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if value(mid) < 1 else (low, mid)
    return low


_EDGES = np.linspace(-12, 12, 241)


def calibrate(model: Model, train: DataFrame) -> Model:
    shared = train.sparkSession.sparkContext.broadcast(model)

    def tops(batch: pa.RecordBatch) -> dict:
        found = document_segments(texts(batch), shared.value)
        return {"label": column(batch, "label"), "n": [len(s) for _, s in found],
                "segments": [sorted((s for s, _, _ in seg), reverse=True) for seg, _ in found],
                "histogram": [np.bincount(np.digitize(s, _EDGES), minlength=len(_EDGES) + 1).tolist() for _, s in found]}

    rows = stage(arrow_map(train.where("fold = 1").select("text", "label"), tops,
                           "label int, n long, segments array<double>, histogram array<long>"), "toxic-calibration")
    seen = rows.select("label", "n", F.get("segments", F.lit(0)).alias("top")).toArrow()  # at most a quarter of FIT_ROWS rows
    label, n, top = seen["label"].to_numpy(), seen["n"].to_numpy(), seen["top"].to_pylist()
    if len(set((label > 0).tolist())) < 2:
        model.shift = float(np.log(model.base / (1 - model.base)))
        return model
    bins = [F.sum(F.col("histogram")[k]).alias(str(k)) for k in range(len(_EDGES) + 1)]
    share = np.array(rows.where("label = 0").agg(*bins).first(), float)
    centres = np.r_[_EDGES[0], (_EDGES[1:] + _EDGES[:-1]) / 2, _EDGES[-1]]
    model.scale = solve_lambda(centres, share / max(share.sum(), 1))
    clean = [model.scale * s - np.log(m) for s, m, y in zip(top, n, label) if y == 0 and s is not None and m]
    model.log_k = float(np.median(clean)) - 0.3665 if clean else -1.0  # the median of a Gumbel variable
    fitted = train.sparkSession.sparkContext.broadcast(model)

    def values(batch: pa.RecordBatch) -> dict:
        found = zip(column(batch, "segments").to_pylist(), column(batch, "n").to_pylist())
        return {"label": column(batch, "label"), "x": [fitted.value.value([(s, 0, 0) for s in f], m) for f, m in found]}

    both = arrow_map(rows.select("label", "n", "segments"), values, "label int, x double", None).toArrow()
    x, y = both["x"].to_numpy(), (both["label"].to_numpy() > 0).astype(float)
    w = np.zeros(2)
    for _ in range(50):  # Newton steps of a ridge logistic fit
        p = 1 / (1 + np.exp(-np.clip(w[0] * x + w[1], -30, 30)))
        g = np.array([((p - y) * x).sum(), (p - y).sum()]) + 0.1 * w
        h = p * (1 - p)
        hess = np.array([[(h * x * x).sum(), (h * x).sum()], [(h * x).sum(), h.sum()]]) + 0.1 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hess, g), -2, 2)
    model.slope, model.shift = float(w[0]), float(w[1])
    return model


def train_model(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    train = stage(labelled(docs, labels, "toxic", rows), "toxic-train")
    return calibrate(fit(train), train)


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score, p_value_log10, passages)``; a passage has its first and last word (end exclusive) and its E-value."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> dict:
        m = shared.value
        found = document_segments(texts(batch), m)
        x = np.array([m.value(seg, len(s)) for seg, s in found])
        passages = [[{"begin": b, "end": e, "e_value": float(v)} for s, b, e in seg
                     if (v := np.exp(m.log_k + np.log(max(len(sc), 1)) - m.scale * s)) < SIGNIFICANT] for seg, sc in found]
        return {"doc_id": column(batch, "doc_id"), "score": m.probability(x), "p_value_log10": -x, "passages": passages}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), score, f"doc_id {kind}, score double, p_value_log10 double, "
                     "passages array<struct<begin:int,end:int,e_value:double>>")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = score_documents(docs, train_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"), "p_value_log10",
                      F.size("passages").alias("n_passages"))
