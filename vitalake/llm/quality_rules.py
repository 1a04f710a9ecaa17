"""Quality rules: boosted trees over document statistics.

The statistics are counted per document in numpy over slices of texts; the
trees are fitted on a bounded sample of ``FIT_ROWS`` labelled documents outside
fold 0 and scored as flat node arrays.  The verdict can only get worse as the
shares of symbols, repeated words, repeated lines and capitals grow.

Rows: a null text has no words; documents that fail the base rules are never
kept.  Null labels do not count; without labels of both kinds the trees say the
base rate for all.  Repeated rows are judged alike; very long texts are read whole; other columns are
not read, whatever they are called.  An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .boosted_trees import Trees, fit
from .common import arrow_map, column, documents, labelled, texts

FIT_ROWS = 30_000
WINDOW = 5
KEEP = 0.5
SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\x0b\x0c\r"
#: statistics that the trees read, and how the verdict may follow them
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "repeat_share": -1, "dup_line_share": -1, "capital_share": -1,
    "distinct_share": 0, "top_word_share": 0, "digit_share": 0, "sign_share": 0, "no_letter_share": 0, "mark_share": 0,
    "words_a_line": 0, "adjacent_share": 0,
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def window_hashes(text: np.ndarray, ids: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for k in range(window):
            h = (h ^ (ids[at + k].astype(np.uint64) + np.uint64(k + 1))) * np.uint64(0xD6E8FEB86659FD93)
            h ^= h >> np.uint64(29)
    return h


def repeated_words(ids: np.ndarray, begin: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """For each text the words inside windows that occur twice or more in it."""
    n = len(ids)
    out = np.zeros(len(begin) - 1, np.int64)
    if n < window:
        return out
    text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    at = np.flatnonzero(text[window - 1:] == text[:n - window + 1])
    if not len(at):
        return out
    h = window_hashes(text, ids, at, window)
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order][1:] == h[order][:-1])
    a, b = at[order[same]], at[order[same + 1]]
    if any((ids[a + k] != ids[b + k]).any() for k in range(window)) or (text[a] != text[b]).any():  # two windows with one hash
        rows = np.stack([text[at], *(ids[at + k] for k in range(window))], axis=1)
        _, code, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
        twice = at[count[code.ravel()] > 1]
    else:
        twice = np.unique(np.r_[a, b])
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + window, -1)
    inside = np.r_[0, np.cumsum(np.cumsum(cover)[:-1] > 0)]
    return inside[begin[1:]] - inside[begin[:-1]]


def statistics(bodies: list[str]) -> dict[str, np.ndarray]:
    """The base counts and the trees' features of each text."""
    number: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)  # refers to nothing of ours, so it goes on return
    ids, rows = [], []
    for body in bodies:
        raw = body.encode("utf-8", "replace")
        words = raw.split()
        own = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        ids.append(own)
        blanks = sum(map(body.count, BLANK))
        lines = [x for x in body.split("\n") if x.strip(BLANK)]
        byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        count = np.bincount(np.unique(own, return_inverse=True)[1]) if len(words) else np.zeros(1, int)
        rows.append((len(words), len(body) - blanks, sum(map(body.count, SYMBOLS)), len(lines) - len(set(lines)), len(lines), len(count),
                     count.max(), int((own[1:] == own[:-1]).sum()), byte[65:91].sum(), byte[97:123].sum() + byte[192:].sum(), byte[48:58].sum(),
                     byte[33:48].sum() + byte[58:65].sum() + byte[91:97].sum() + byte[123:127].sum(),
                     sum(map(body.count, ("!", "?"))), sum(not w.translate(None, b"0123456789!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") for w in words)))
    t = np.array(rows, float).reshape(-1, 14)
    begin = np.cumsum([0, *map(len, ids)])
    repeat = repeated_words(np.concatenate([*ids, np.zeros(0, np.int64)]), begin)
    words, chars = np.maximum(t[:, 0], 1), np.maximum(t[:, 1], 1)
    letters = np.maximum(t[:, 8] + t[:, 9], 1)
    base = dict(zip(BASE, (t[:, 0], t[:, 1], t[:, 2], t[:, 3], repeat)))
    return {k: v.astype(np.int64) for k, v in base.items()} | {
        "log_words": np.log1p(t[:, 0]), "word_length": t[:, 1] / words, "symbol_share": t[:, 2] / words, "repeat_share": repeat / words,
        "dup_line_share": t[:, 3] / np.maximum(t[:, 4], 1), "capital_share": t[:, 8] / letters, "distinct_share": t[:, 5] / words,
        "top_word_share": t[:, 6] / words, "digit_share": t[:, 10] / chars, "sign_share": t[:, 11] / chars, "no_letter_share": t[:, 13] / words,
        "mark_share": t[:, 12] / words, "words_a_line": words / np.maximum(t[:, 4], 1), "adjacent_share": t[:, 7] / words}


def matrix(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.stack([stats[f] for f in FEATURES], axis=1)


def base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    return (stats["n_words"] < 10) | (100 * stats["n_repeat_words"] > 20 * stats["n_words"])


def train_trees(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Trees:
    def step(batch: pa.RecordBatch) -> dict:
        return {"label": column(batch, "label"), "x": matrix(statistics(texts(batch))).tolist()}

    seen = arrow_map(labelled(docs, labels, "quality", rows).select("text", "label"), step, "label int, x array<double>").toArrow()
    x = np.array(seen["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, (seen["label"].to_numpy() > 0).astype(float), np.array(list(FEATURES.values())))


def judge(docs: DataFrame, trees: Trees, keep: float = KEEP) -> DataFrame:
    """``(doc_id, base counts, base_failed, kept, score)``."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def step(batch: pa.RecordBatch) -> dict:
        stats = statistics(texts(batch))
        failed, score = base_failed(stats), shared.value.probability(matrix(stats))
        return {"doc_id": column(batch, "doc_id"), "base_failed": failed, "kept": ~failed & (score >= keep), "score": score} | {k: stats[k] for k in BASE}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), step, f"doc_id {kind}, " + ", ".join(f"{k} long" for k in BASE)
                     + ", base_failed boolean, kept boolean, score double")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return judge(docs, train_trees(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
