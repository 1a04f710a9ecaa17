"""op11 against a brute-force trie, for shards, cuts and rounds of many sizes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalake.llm import conversation_trie as ct

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = f"{len(role.encode())}:{role}{text}".encode()
            convs[c].append((t is not None, t or 0, hashlib.md5(name).digest(), role, text))
    plain = {c: [x[3:] for x in sorted(v, key=lambda x: x[:3])] for c, v in convs.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c in plain:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        seq = tuple(plain.get(base, [])[:h] + plain[c][h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].add(c)
        ends[seq].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[k] for k in kids[node])
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest()) for n, m in members.items())


def conversations(seed=3, n=120):
    rng = random.Random(seed)
    texts = ["", None, "hi", "Ünï ©", "a b", "x" * 300, "hello there"]
    rows = []
    for c in [*range(-7, n), 10_007, 4_100, 4_096]:
        kind = rng.random()
        length = rng.randint(1, 12)
        for t in range(length):
            if kind < 0.4:
                rows.append((c, t, ["user", "assistant"][t % 2], texts[t % 7]))  # copies and shared openings
            else:
                rows.append((c, rng.choice([None, t, t, t]), rng.choice(["user", None, "system"]), rng.choice(texts) if t < 2 else rng.choice([*texts, f"t{rng.random()}"])))
    rows += [(40, 100 + t, "user", f"long {t}") for t in range(90)]  # a long conversation
    rows += [(41, 100 + t, "user", f"long {t}") for t in range(90)] + [(41, 500, "user", "end")]
    rows += [(40, 3, "user", "again")] * 3 + [(None, 1, "user", "lost"), (60, None, None, None)]
    rng.shuffle(rows)
    return rows


def table(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.mark.parametrize("size", [{}, {"turns": 12, "rows": 8}, {"turns": 40, "rows": 9, "depth": 7, "chunk": 5}, {"depth": 3, "chunk": 2}])
def test_brute_force(spark, size):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    for extra in ("block", "total", "seq", "key", "n", "h", "start"):  # names used inside
        df = df.withColumn(extra, F.lit("x"))
    assert table(ct.conversation_trie(df, **size)) == brute(rows)


def test_one_conversation_holds_most_rows(spark):
    rows = [(5, t, "user", str(t)) for t in range(3000)] + [(c, t, "user", str(t)) for c in range(6, 30) for t in range(3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    want = brute(rows)
    assert table(ct.conversation_trie(df, depth=500, chunk=64, turns=800)) == want


def test_empty_and_null_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert ct.conversation_trie(spark.createDataFrame([], schema)).collect() == []
    assert ct.conversation_trie(spark.createDataFrame([(None,) * 4] * 3, schema)).collect() == []
    only = [(7, None, None, None)] * 2
    assert table(ct.conversation_trie(spark.createDataFrame(only, schema))) == brute(only)


def test_double_array_walks_to_its_strings():
    rng = random.Random(2)
    seqs = sorted({tuple(rng.randrange(40) for _ in range(rng.randint(1, 6))) for _ in range(800)})
    lengths = np.array([len(s) for s in seqs])
    trie = ct.DoubleArray(np.concatenate([np.array(s) for s in seqs]), lengths, 40)
    stops = np.cumsum(lengths)
    for s, b, n in zip(seqs, stops.tolist(), lengths.tolist()):
        assert [trie.walk(list(s[:d + 1])) for d in range(n)] == trie.path[b - n:b].tolist()
    prefixes = {s[:d] for s in seqs for d in range(1, len(s) + 1)}
    assert sum(map(len, trie.levels)) == len(prefixes)
    assert all(trie.walk(list(s) + [c]) == -1 for s in seqs[:50] for c in range(40) if (*s, c) not in prefixes)
