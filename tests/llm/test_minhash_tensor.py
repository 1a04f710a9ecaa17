"""op13 against brute force over full sets."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_tables import ids_and_texts, make_tables, sf, tables  # noqa: F401
from vitalake.llm import minhash_tensor as mt

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=2):
    words = [w for w in (text or "").translate(LOWER).replace("\t", " ").replace("\n", " ").replace("\r", " ")
             .replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return frozenset()
    size = min(size, len(words))
    return frozenset(tuple(words[k:k + size]) for k in range(len(words) - size + 1))


def brute(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kinds = {}
    for k, s in enumerate(sets):
        if s:
            if s in kinds:
                root[find(k)] = find(kinds[s])
            else:
                kinds[s] = k
    distinct = sorted(kinds.values(), key=lambda k: len(sets[k]))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1:]:
            if 100 * len(sets[a]) < percent * len(sets[b]):
                break
            same = len(sets[a] & sets[b])
            if 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    out = []
    for k, (i, _) in enumerate(rows):
        c = least.get(find(k)) if sets[k] else i
        out.append((i, len(sets[k]), c, i == c))
    return sorted(out, key=repr)


def table(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def test_brute_force_awkward(spark, sf, tables):
    got = table(mt.op13_minhash_tensor(spark, sf))
    assert got == brute(ids_and_texts(tables))
    assert sum(not r[3] for r in got) > 30


def chains(seed):
    """Groups whose members drift apart, a passage that a third of all documents share, and near-threshold pairs."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(12):
        words = rng.choices(vocabulary, k=rng.randint(20, 90))
        for _ in range(14):
            words = list(words)
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
    passage = rng.choices(vocabulary, k=60)
    for _ in range(150):
        own = rng.choices(vocabulary, k=rng.randint(8, 22))
        out.append(" ".join(passage + own))
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_brute_force_hot_passage_and_chains(spark, seed):
    rows = chains(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for extra in ("n", "k1", "k2", "cid", "key", "u", "v", "label", "least", "set", "body"):
        df = df.withColumn(extra, F.lit("x"))
    assert table(mt.near_duplicates(df)) == brute(rows)


def test_empty_and_null_tables(spark):
    schema = "doc_id long, text string"
    assert mt.near_duplicates(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, None)] * 2 + [(4, "")] * 2 + [(None, "one two three"), (9, "one two  THREE"), (9, "other")]
    assert table(mt.near_duplicates(spark.createDataFrame(rows, schema))) == brute(rows)


def test_pairs_at_the_threshold_meet_in_a_table():
    rng = np.random.default_rng(4)
    missed = 0
    for _ in range(400):
        both = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
        a, b = (np.unique(np.r_[both, rng.integers(0, 1 << 63, 25, dtype=np.uint64)]) for _ in range(2))
        x = mt.minima([a, b])
        missed += (x[0] == x[1]).sum() < 2
    assert missed <= 1


def test_buckets_that_tasks_share():
    """One key over several tasks: each passes its rows on; small buckets inside a task give their pairs."""
    rows = [(0, 7), (1, 5), *((1, k) for k in range(10, 60)), (2, 3), (2, 4), (3, 9), (5, 1), (5, 2), (5, 8), (6, 1), (7, 1)]
    pairs, told = set(), []
    for part in (rows[:25], rows[25:55], rows[55:]):
        for size in (3, 7, 100):
            mine = []
            batches = [pa.RecordBatch.from_pydict({"key": [r[0] for r in part[k:k + size]], "cid": [r[1] for r in part[k:k + size]]})
                       for k in range(0, len(part), size)]
            for out in mt._meet(iter(batches)):
                for r in out.to_pylist():
                    pairs.add((r["u"], r["v"])) if r["key"] is None else mine.append((r["key"], r["v"]))
            assert len(mine) == len(set(mine))
            told += mine
    assert {r for r in rows if r[0] == 1} <= set(told) and {(3, 9), (0, 7), (7, 1)} <= set(told)
    assert {(1, 2), (1, 8), (2, 8)} <= pairs or {(5, 1), (5, 2), (5, 8)} <= set(told)
    assert {(2, 3), (2, 4)} <= set(told) or (3, 4) in pairs
    assert not any(u in range(10, 60) for u, _ in pairs)
