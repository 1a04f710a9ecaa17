"""op3, op4, op6 and op9 against SQL or brute force over the whole fixture."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_tables import ids_and_texts, sf, tables  # noqa: F401
from vitalake.llm import decontamination, line_dedup, packing, registry, simhash_golay
from vitalake.llm.tokens import Encoder

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", ["op3_decontamination", "op4_line_dedup"])
def test_sql_agrees(spark, name):
    sf = "/root/testdata/sf0.001"
    if not os.path.exists(f"{sf}/documents.parquet"):
        pytest.skip("driver test data not present")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    out = registry.queries()[name](spark, sf)
    assert sorted(out.columns) == sorted(names)
    assert table(out, *names) == sorted(want.fetchall(), key=repr)


def line_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def test_op4_brute_force(spark, sf, tables):
    rows = ids_and_texts(tables)
    last = 1 << 63
    owner, holders = {}, {}
    for i, t in rows:
        for x in (t or "").split("\n"):
            k = line_key(x)
            if len(k) >= 10:
                owner[k] = min(owner.get(k, last), last - 1 if i is None else i)
                holders.setdefault(k, set()).add(i)
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(line_key(x), ())) < 2 or owner[line_key(x)] == (last - 1 if i is None else i)]
        want.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    assert table(line_dedup.op4_line_dedup(spark, sf), "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(want, key=repr)
    assert any(r[2] for r in want)


def test_line_runs_compact_and_are_the_same_for_any_batches(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    keyed = docs.select(F.coalesce("doc_id", F.lit(line_dedup.LAST_ID)).alias("did"), F.coalesce("text", F.lit("")).alias("body"))
    one = line_dedup.build_runs(keyed, batches=1)
    many = line_dedup.build_runs(keyed, batches=5, fanout=2)
    assert [len(x) for x in one.levels] == [1]
    assert len(many.levels) > 1 and all(len(x) < 2 for x in many.levels)
    assert table(one.all(), "h1", "h2", "owner") == table(many.all(), "h1", "h2", "owner")


def words3(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def test_op3_brute_force(spark, sf, tables):
    windows = {}
    for r in tables["benchmark"].itertuples():
        w = words3(r.text)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(str(r.item_id))
    sizes = {len(w) for w in windows}
    want = []
    for i, t in ids_and_texts(tables):
        w = words3(t)
        hit, items = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    items |= windows[tuple(w[k:k + n])]
        want.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert table(decontamination.op3_decontamination(spark, sf), *names) == sorted(want, key=repr)
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    blocks = decontamination.annotate(docs.select("doc_id", "text"), bench, block_chars=300, keep=["doc_id"])  # several blocks
    got = blocks.select("doc_id", "__n_hit", F.size("__matches").alias("n"))
    assert table(got, "doc_id", "__n_hit", "n") == sorted(((r[0], r[2], r[3]) for r in want), key=repr)


def test_op3_matches_are_longest_and_verbatim():
    rng = random.Random(2)
    items = [(str(k), " ".join(rng.choices("abcd", k=25))) for k in range(4)]
    docs = [rng.choices(["a", "b", "c", "d", "zz"], weights=[5, 5, 5, 5, 1], k=200) + dict(items)["1"].split()[3:20] for _ in range(6)]
    block = decontamination.Block(items, 4)
    masks, found = decontamination.shard_hits([[w.encode() for w in d] for d in docs], block)
    for d, mask, matches in zip(docs, masks, found):
        for name, body in items:
            b = body.split()
            best = 0
            for p in range(len(d)):
                for q in range(len(b) - 3):
                    n = 0
                    while p + n < len(d) and q + n < len(b) and d[p + n] == b[q + n]:
                        n += 1
                    best = max(best, n)
            m = [x for x in matches if x["item_id"] == name]
            assert (m[0]["length"] if m else 0) == (best if best >= 4 else 0)
            for x in m:
                assert d[x["doc_word"]:x["doc_word"] + x["length"]] == b[x["item_word"]:x["item_word"] + x["length"]]
                assert mask[x["doc_word"]:x["doc_word"] + x["length"]].all()


def test_op6_brute_force(spark, sf, tables):
    rows = ids_and_texts(tables)
    prints = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        sh = [" ".join(w[k:k + 4]) for k in range(len(w) - 3)] or ([" ".join(w)] if w else [])
        h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in sh], dtype=np.uint64)
        prints.append(sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(sh)))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    want = sorted(((i, f"{p:016x}", least.get(find(k))) for k, ((i, _), p) in enumerate(zip(rows, prints))), key=repr)
    assert table(simhash_golay.op6_simhash_golay(spark, sf), "doc_id", "fingerprint", "component_id") == want


def test_golay_code_is_perfect_and_keys_meet():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 1 << 23, 4000)
    low, high, pattern = simhash_golay._golay()
    assert len(set((low[pattern & 0xFFF] ^ high[pattern >> 12]).tolist())) == 2048  # one syndrome for each pattern of up to 3 errors
    assert (np.bitwise_count(pattern) <= 3).all()
    assert (simhash_golay.nearest(v) == simhash_golay.nearest(v ^ pattern[low[v & 0xFFF] ^ high[v >> 12]])).all()
    a = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
    b = a.copy()
    for _ in range(4):
        b ^= np.uint64(1) << rng.integers(0, 64, len(a)).astype(np.uint64)
    (ka, ra), (kb, rb) = simhash_golay.fuzzy_keys(a), simhash_golay.fuzzy_keys(b)
    assert len({r for r, _ in set(zip(ra.tolist(), ka.tolist())) & set(zip(rb.tolist(), kb.tolist()))}) == len(a)


def test_bucket_links_connect_dense_groups_without_all_pairs():
    rng = np.random.default_rng(4)
    group = np.unique(np.uint64(0x1234567890ABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64))
                      ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)))
    u, v = simhash_golay.bucket_links(np.zeros(len(group), np.int64), group, 4)
    assert len(u) == len(group) - 1  # a spanning tree: the group is connected
    assert (np.bitwise_count(u ^ v) <= 4).all()


def test_components_of_a_long_path(spark):
    from vitalake.llm.components import stars

    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (7, 7)], "u long, v long")
    assert {(r.u, r.v) for r in stars(edges).collect()} == {(k, 0) for k in range(1, 41)} | {(101, 100)}


def test_op9_pieces_and_sequences(spark, sf, tables):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for i, body in ids_and_texts(tables):
        ids = [*t.encode(body or "", add_special_tokens=False).ids, 2]
        for p, (s, n) in enumerate(packing.cut(len(ids), 1024)):
            want.append((i, p, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())))
    rows = packing.op9_best_fit_packing(spark, sf).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    held = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(held) <= -(-sum(r.length for r in rows) // 1024) + 2


@pytest.mark.parametrize("lengths,most", [([345] * 999, 500), ([512] * 10 + [1024] * 3, 8), ([700, 324] * 50, 50), ([1] * 5000, 5),
                                          ([400, 400, 224] * 40 + [330, 340, 354] * 40, 80)])
def test_plan_covers_each_length_and_packs_well(lengths, most):
    plan = packing.make_plan({k: lengths.count(k) for k in set(lengths)})
    assert plan.taken == {k: lengths.count(k) for k in set(lengths)}
    assert plan.sequences <= most


def _packed(histogram, capacity=1024):
    """The plan's sequences, filled from its rows."""
    plan = packing.make_plan(histogram, capacity)
    filled, given = {}, {}
    p = plan.arrays()
    for length, n in histogram.items():
        for rank in range(n):
            row = np.searchsorted(p["key"], length << 44 | rank, side="right") - 1
            inner, many = rank - p["rank"][row], p["many"][row]
            s, at = p["sequence"][row] + inner // many, p["offset"][row] + inner % many * length
            filled.setdefault(int(s), []).append((int(at), length))
            given[length] = given.get(length, 0) + 1
    for parts in filled.values():
        end = 0
        for at, length in sorted(parts):
            assert at == end
            end += length
        assert end <= capacity
    assert len(filled) == plan.sequences and given == histogram
    return plan


@pytest.mark.parametrize("lengths,gain", [(range(330, 420), 0.015), (range(200, 700, 3), 0.008)])
def test_the_program_beats_best_fit_on_awkward_lengths(lengths, gain):
    rng = random.Random(4)
    histogram = {n: rng.randint(3, 20) for n in lengths}
    alone = packing.Plan()
    k = np.array(sorted(histogram))
    d = np.array([histogram[x] for x in k.tolist()])
    packing.best_fit(k, d, 1024, alone)
    plan = _packed(histogram)
    assert plan.sequences <= alone.sequences * (1 - gain)
    assert plan.by_columns > 0.1 * plan.sequences
    assert sum(n * x for n, x in histogram.items()) / 1024 <= plan.bound + 1e-6 <= plan.value + 1e-6 <= plan.sequences + 1e-6


def test_the_program_solves_a_small_case_to_its_bound():
    """Three lengths that fit only as (500, 300, 224): the linear program's value is the bound."""
    lengths, demand = np.array([224, 300, 500]), np.array([400, 400, 400])
    columns, x, bound, value = packing.solve(lengths, demand, 1024, rounds=800)
    assert bound == pytest.approx(400, rel=1e-6) and 400 <= value <= 404
    assert _packed({224: 400, 300: 400, 500: 400}).sequences <= 402


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_no_plan_is_worse_than_best_fit(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 1024): rng.randint(1, 40) for _ in range(120)}
    alone = packing.Plan()
    k = np.array(sorted(x for x in histogram if x < 1024))
    packing.best_fit(k, np.array([histogram[x] for x in k.tolist()]), 1024, alone)
    assert _packed(histogram).sequences <= alone.sequences + histogram.get(1024, 0)


def test_best_configuration_is_optimal():
    rng = random.Random(3)
    for _ in range(30):
        lengths = np.array(sorted(rng.sample(range(1, 15), 4)))
        price = np.array([rng.random() * x for x in lengths])
        best = [0.0] * 31
        for c in range(1, 31):
            best[c] = max([best[c - 1], *(price[k] + best[c - x] for k, x in enumerate(lengths) if x <= c)])
        config = packing.best_configuration(price, lengths, 30)
        assert sum(lengths[k] * n for k, n in config.items()) <= 30
        assert sum(price[k] * n for k, n in config.items()) == pytest.approx(best[30])


def test_token_ids_equal_the_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), Encoder()
    rng = random.Random(8)
    bits = ["a", "b", "S", "'", "'s", "'re", "'ll", "'t", "'ve", "'m", "'d", " ", "  ", "\n", "\t", " ", "1", "²", "é", "!", "..", "<|endoftext|>",
            "😀", "中", "re", "ll", "ßx", "’s", "\x1c", " 's", "\r\n", "_", " "]
    for _ in range(150):
        bodies = ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(20)]
        assert [x.tolist() for x in e.encode(bodies)] == [t.encode(b, add_special_tokens=False).ids for b in bodies]


def test_op3_shared_template_in_bounded_chunks(monkeypatch):
    """A preamble that all items share: the matches of plain search, in chunks of any size and in bounded memory."""
    import random
    import tracemalloc
    from vitalake.llm import decontamination as op3

    rng = random.Random(2)
    head = [f"h{k}" for k in range(30)]

    def plain(doc, items):
        out = {}
        for name, words in items:
            n = min(10, len(words))
            for d in range(len(doc) - n + 1):
                for w in range(len(words) - n + 1):
                    m = 0
                    while d + m < len(doc) and w + m < len(words) and doc[d + m] == words[w + m]:
                        m += 1
                    if m >= n and (m, -d, -w) > out.get(name, (0, 0, 0)):
                        out[name] = (m, -d, -w)
        return {(i, m, -d, -w) for i, (m, d, w) in out.items()}

    items = [(f"i{k}", head[:rng.randint(12, 30)] + [f"w{rng.randrange(3)}" for _ in range(6)]) for k in range(12)]
    docs = [head[rng.randint(0, 5):] + [f"w{rng.randrange(3)}" for _ in range(5)] + head[:rng.randint(10, 30)] + ["x"] for _ in range(6)]
    block = op3.Block([(i, " ".join(w)) for i, w in items], 10)
    for pairs in (1, 7, 1000):
        monkeypatch.setattr(op3, "PAIRS", pairs)
        _, found = op3.shard_hits([[w.encode() for w in d] for d in docs], block)
        assert [{(m["item_id"], m["length"], m["doc_word"], m["item_word"]) for m in f} for f in found] == [plain(d, items) for d in docs]
    monkeypatch.setattr(op3, "PAIRS", 100_000)
    block = op3.Block([(f"i{k:04}", " ".join([*head, f"w{k}"])) for k in range(1500)], 10)
    words = [[w.encode() for w in head + ["x"]] * 4 for _ in range(25)]  # 3.15 million pairs
    tracemalloc.start()
    _, found = op3.shard_hits(words, block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [len(f) for f in found] == [1500] * 25 and peak < 100e6
