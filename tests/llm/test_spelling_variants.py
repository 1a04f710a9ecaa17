"""op12 against brute force: counts, near words, forms and roots."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_tables import ids_and_texts, sf, tables  # noqa: F401
from vitalake.llm import spelling_variants as sv

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(word, alphabet):
    cut = [(word[:k], word[k:]) for k in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cut if b} | {a + c + b[1:] for a, b in cut if b for c in alphabet} | {a + c + b for a, b in cut for c in alphabet}
    return out - {word}


def brute(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    alphabet = sorted({c for w in counts for c in w})
    near = {w: sorted((-counts[x], x) for x in edits(w, alphabet) if x in counts) for w in counts}
    form = {w: near[w][0][1] if near[w] and -near[w][0][0] >= 5 * n else None for w, n in counts.items()}

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w] or "", root(w), n, len(near[w]), counts[form[w]] if form[w] else -1) for w, n in counts.items())


def table(df):
    rows = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    return sorted((r[0], r[1] or "", r[2], r[3], r[4], -1 if r[5] is None else r[5]) for r in rows)


def vocabulary(seed, n, letters="abcdeéßñz"):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rng.choices(letters, k=rng.randint(6, 12)))
        words.add(w)
        for _ in range(3):
            words.add(rng.choice(sorted(x for x in edits(w, letters) if len(x) >= 6)))
    return sorted(words)


@pytest.mark.parametrize("suffix", [False, True])
def test_search_finds_every_word_of_its_scheme(suffix):
    words = vocabulary(3, 400, "abñ") + ["aaaaaa", "aaaaaaa", "aaaaaaaa", "abababab"]
    words = sorted(set(words))
    q, w = sv.near_words(words, words, suffix)
    got = defaultdict(set)
    for a, b in zip(q.tolist(), w.tolist()):
        got[words[a]].add(words[b])
    known = set(words)
    for a in words:
        h = len(a) // 2
        near = edits(a, "abñ") & known
        want = {x for x in near if x[:h] == a[:h]} if not suffix else {x for x in near if x[:h] != a[:h]}
        assert got[a] == want, a
        assert all(x.endswith(a[h:]) for x in got[a]) or not suffix


def test_wavelet_steps_count_codes():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 23, 500)
    wave = sv.Wavelet(codes, 23)
    lo = rng.integers(0, 500, 200)
    hi = np.minimum(500, lo + rng.integers(0, 80, 200))
    c = rng.integers(0, 23, 200)
    a, b, less = wave.step(c, lo, hi)
    for k in range(200):
        part = codes[lo[k]:hi[k]]
        assert b[k] - a[k] == (part == c[k]).sum() and less[k] == (part < c[k]).sum()
        assert a[k] == (codes < c[k]).sum() + (codes[:lo[k]] == c[k]).sum()


def test_brute_force_awkward(spark, sf, tables):
    got = table(sv.op12_spelling_variants(spark, sf))
    assert got == brute(ids_and_texts(tables))
    assert got


@pytest.mark.parametrize("chars", [sv.INDEX_CHARS, 700])
def test_brute_force_variants(spark, chars):
    rng = random.Random(9)
    words = vocabulary(5, 260)
    weight = [5 ** rng.randint(0, 4) for _ in words]
    rows = [(k, " ".join(w.upper() if rng.random() < 0.1 else w for w in rng.choices(words, weight, k=120))) for k in range(200)]
    rows += [(None, None), (900, ""), (901, "x" * 3000 + " çédille" * 7), (901, "x" * 3000 + "×éclair " * 6)] + [(902, "x" * 2999 + "y")] * 6
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for extra in ("word", "n", "side", "shard", "block", "lot", "role", "form", "root"):
        df = df.withColumn(extra, F.lit("x"))
    got = table(sv.spelling_variants(df, chars))
    want = brute(rows)
    assert got == want
    assert sum(r[1] != "" for r in want) > 20 and any(r[1] != r[2] and r[1] for r in want)


def test_empty_table(spark):
    assert sv.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
