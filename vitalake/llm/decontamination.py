"""Benchmark decontamination by suffix arrays of the training text.

Every task turns a bounded slice of documents (a shard) into word numbers and
builds a suffix array over it; each suffix of each benchmark item is
binary-searched there, which gives all places of its windows and its longest
verbatim match.  A document never spans two shards, so nothing is shuffled and
the work per document does not depend on how many copies it has.

The array of a shard is sparse but exact: a window can only occur inside an
unbroken run of benchmark words that is at least as long as the shortest
window, so only suffixes inside such runs are sorted.

The benchmark is a query set.  It is cut into blocks of ``block_chars`` code
points, and one block's index at a time is broadcast; with several blocks the
documents are searched once a block and their hits are carried along.

Rows: null texts have no words; items without words have no windows; a null
``item_id`` is the empty string, and items that share an id count as one.
Repeated documents each get their own row.  Empty tables (either one) give no
hits.  Columns of ``docs`` are passed through whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import arrow_map, column, documents, stage, struct, texts

WINDOW = 10
#: characters of the benchmark in one block: about 50 bytes each on the driver while it is built, 9 in each worker
BLOCK_CHARS = 4_000_000
#: pairs of a place and a benchmark suffix that are looked at together
PAIRS = 1_000_000
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
STATE = "__n_words long, __n_hit long, __hit binary, __matches array<struct<item_id:string,length:int,doc_word:int,item_word:int>>"


def split_words(text: str) -> list[bytes]:
    """Lower-cased runs of digits, letters and non-ASCII characters."""
    return text.encode("utf-8", "replace").translate(_TABLE).split()


class Block:
    """Index of some benchmark items: word numbers, suffixes, distinct windows."""

    def __init__(self, rows: list[tuple[str, str]], window: int):
        self.vocab: dict[bytes, int] = {}
        self.items = sorted({i for i, _ in rows})
        number = {i: k for k, i in enumerate(self.items)}
        text, start, left, size, item, word = [], [], [], [], [], []
        for name, body in rows:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in split_words(body)]
            n = min(window, len(ids))
            for k in range(len(ids) - n + 1 if ids else 0):
                start.append(len(text) + k)
                left.append(len(ids) - k)
                size.append(n)
                item.append(number[name])
                word.append(k)
            text += [*ids, 0]
        as_int = lambda x: np.array(x, dtype=np.int64)
        self.text, self.start, self.left, self.size = as_int(text), as_int(start), as_int(left), as_int(size)
        self.item, self.word = as_int(item), as_int(word)
        seen: dict[bytes, int] = {}
        group = as_int([seen.setdefault(self.text[s:s + n].tobytes(), len(seen)) for s, n in zip(start, size)])
        self.order = np.argsort(group, kind="stable")  # suffixes by window
        self.first = np.searchsorted(group[self.order], np.arange(len(seen) + 1))
        self.shortest = min(size, default=0)
        self.longest = max(left, default=0)


def suffix_array(ids: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``ids`` sorted by what follows them, to ``depth`` words, by
    prefix doubling."""
    order = np.argsort(ids, kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.cumsum(np.r_[0, np.diff(ids[order]) != 0])
    step = 1
    while step < depth and rank[order[-1]] < len(ids) - 1:
        nxt = np.zeros(len(ids), np.int64)
        nxt[:-step or None] = rank[step:] + 1 if step < len(ids) else 0
        key = rank * (len(ids) + 2) + nxt
        order = np.argsort(key, kind="stable")
        rank[order] = np.cumsum(np.r_[0, np.diff(key[order]) != 0])
        step *= 2
    return order


def common_prefix(a: np.ndarray, at: np.ndarray, most: np.ndarray, b: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Words that ``a`` from ``at`` and ``b`` from ``to`` share, ``most`` at most."""
    out = np.zeros(len(at), np.int64)
    open_ = np.flatnonzero(most > 0)
    j = 0
    while len(open_):
        q = to[open_] + j
        same = (q < len(b)) & (a[at[open_] + j] == b[np.minimum(q, len(b) - 1)])
        open_ = open_[same]
        j += 1
        out[open_] = j
        open_ = open_[most[open_] > j]
    return out


def search(ids: np.ndarray, order: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray, after: bool) -> np.ndarray:
    """For each pattern ``text[start:start+size]`` the first place in ``order``
    whose suffix does not come before it (``after``: comes after all that begin with it)."""
    low, high = np.zeros(len(start), np.int64), np.full(len(start), len(order), np.int64)
    while len(open_ := np.flatnonzero(low < high)):
        mid = (low[open_] + high[open_]) // 2
        at = order[mid]
        n = common_prefix(text, start[open_], size[open_], ids, at)
        whole = n == size[open_]
        word = text[np.minimum(start[open_] + n, len(text) - 1)]
        there = np.where(at + n < len(ids), ids[np.minimum(at + n, len(ids) - 1)], 0)
        right = np.where(whole, after, there < word)
        low[open_[right]] = mid[right] + 1
        high[open_[~right]] = mid[~right]
    return low


def longest_matches(block: Block, part: np.ndarray, at: np.ndarray, place: np.ndarray, which: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """``(document, item, length, place, suffix)`` of the longest match of each
    document and item, from every suffix with the window found at each place.
    Of these pairs ``PAIRS`` at a time are spread out and reduced, so the working
    set is bounded by that and by what is returned."""
    rank = np.argsort(place, kind="stable")
    place, which = place[rank], which[rank]
    ends = np.cumsum((block.first[1:] - block.first[:-1])[which])
    held = [np.zeros(0, np.int64)] * 5

    def best(rows: list[np.ndarray]) -> list[np.ndarray]:
        doc, item, length, where, suffix = rows
        order = np.lexsort((suffix, where, -length, item, doc))
        new = np.r_[True, (np.diff(doc[order]) != 0) | (np.diff(item[order]) != 0)] if len(order) else np.zeros(0, bool)
        return [x[order[new]] for x in rows]

    more: list[list[np.ndarray]] = []
    total = int(ends[-1]) if len(ends) else 0
    for low in range(0, total, PAIRS):
        pair = np.arange(low, min(low + PAIRS, total))
        k = np.searchsorted(ends, pair, side="right")
        suffix = block.order[block.first[1:][which[k]] - (ends[k] - pair)]
        p, q = place[k], block.start[suffix]
        # where the words before are the same too, the match from there on is longer
        longer = (p > 0) & (q > 0) & (part[p - 1] == block.text[q - 1]) & (part[p - 1] > 0)
        p, q, suffix = p[~longer], q[~longer], suffix[~longer]
        where = at[p]
        more.append(best([np.searchsorted(bounds, where, side="right") - 1, block.item[suffix],
                          common_prefix(block.text, q, block.left[suffix], part, p), where, suffix]))
        if sum(len(x[0]) for x in more) > PAIRS + len(held[0]):
            held, more = best([np.concatenate(x) for x in zip(held, *more)]), []
    return best([np.concatenate(x) for x in zip(held, *more)])


def shard_hits(words: list[list[bytes]], block: Block) -> tuple[list[np.ndarray], list[list[dict]]]:
    """For each document the mask of hit words and its best match with each item."""
    bounds = np.cumsum([0, *(len(w) + 1 for w in words)])  # a break after each document
    ids = np.zeros(bounds[-1], np.int64)
    for w, b in zip(words, bounds):
        ids[b:b + len(w)] = np.fromiter(map(block.vocab.get, w, repeat(0)), np.int64, len(w))
    hit, found = np.zeros(len(ids) + 1, np.int64), [[] for _ in words]
    known = np.r_[0, (ids > 0).astype(np.int8), 0]
    edge = np.flatnonzero(np.diff(known))
    begin, end = edge[::2], edge[1::2]
    long = end - begin >= block.shortest
    begin, end = begin[long], end[long]
    if len(begin):
        sizes = end - begin + 1  # each run with the break after it
        at = np.repeat(begin - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
        part = ids[at]
        order = suffix_array(part, block.longest)
        one = block.order[block.first[:-1]]  # a suffix for each distinct window
        low = search(part, order, block.text, block.start[one], block.size[one], False)
        high = search(part, order, block.text, block.start[one], block.size[one], True)
        seen = np.flatnonzero(high > low)
        count = (high - low)[seen]
        place = order[np.repeat(low[seen] - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())] if len(seen) else seen
        which = np.repeat(seen, count)
        span = block.size[one][which]
        np.add.at(hit, at[place], 1)
        np.add.at(hit, at[place] + span, -1)
        for d, item, length, where, suffix in zip(*longest_matches(block, part, at, place, which, bounds)):
            found[d].append({"item_id": block.items[item], "length": int(length),
                             "doc_word": int(where - bounds[d]), "item_word": int(block.word[suffix])})
    mask = np.cumsum(hit)[:-1] > 0
    return [mask[b:b + len(w)] for w, b in zip(words, bounds)], found


def benchmark_blocks(bench: DataFrame, block_chars: int, window: int) -> tuple[int, Callable[[int], Block]]:
    """How many blocks of at most about ``block_chars`` the benchmark has, and what builds one of them."""
    rows = bench.select(F.coalesce(bench["item_id"].cast("string"), F.lit("")).alias("item"),
                        F.coalesce(bench["text"], F.lit("")).alias("body"))
    total = rows.agg(F.sum(F.char_length("body"))).first()[0] or 0
    n = -(-total // block_chars) or 1
    return n, lambda k: Block([tuple(r) for r in rows.where(F.pmod(F.xxhash64("item", "body"), F.lit(n)) == k).collect()], window)


def annotate(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS,
             text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``__n_words``, ``__n_hit``, ``__hit`` (a bit per word) and
    ``__matches`` (the longest match with each item and where it lies).
    ``keep``: the columns wanted beside these, all by default."""
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    state = [f.name for f in struct(STATE)]
    out = docs.select(*dict.fromkeys([*keep, text]))
    many, build = benchmark_blocks(bench, block_chars, window)
    for k in range(many):  # one block at a time on the driver and in the workers
        last, more = k == many - 1, k > 0
        shared = spark.sparkContext.broadcast(build(k))
        names = [*dict.fromkeys([*keep, *([] if last else [text])])]
        def step(batch: pa.RecordBatch, shared=shared, names=names, more=more) -> dict:
            words = [split_words(x) for x in texts(batch, text)]
            masks, found = shard_hits(words, shared.value)
            if more:
                bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(w)).astype(bool)
                        for x, w in zip(column(batch, "__hit").to_pylist(), words)]
                masks = [a | b for a, b in zip(masks, bits)]
                found = [merged(a + b) for a, b in zip(column(batch, "__matches").to_pylist(), found)]
            return {n: column(batch, n) for n in names} | {
                "__n_words": [len(w) for w in words], "__n_hit": [int(m.sum()) for m in masks],
                "__hit": [np.packbits(m).tobytes() for m in masks], "__matches": found}

        schema = StructType([*[docs.schema[n] for n in names], *struct(STATE).fields])
        out = arrow_map(out, step, schema, text)
        if not last:
            out = stage(out, "decontamination")
            shared.destroy()
    return out.select(*keep, *state)


def merged(matches: list[dict]) -> list[dict]:
    """The longest match with each item."""
    best: dict[str, dict] = {}
    for m in matches:
        old = best.get(m["item_id"])
        if old is None or (m["length"], -m["doc_word"]) > (old["length"], -old["doc_word"]):
            best[m["item_id"]] = m
    return list(best.values())


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = annotate(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                   keep=["doc_id"])
    items = F.array_sort(F.transform("__matches", lambda m: m["item_id"]))
    return out.select("doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"),
                      F.size("__matches").cast("long").alias("n_items"),
                      F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
                      (F.col("__n_hit") > 0).alias("contaminated"))


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents with any benchmark window go."""
    out = annotate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.where("__n_hit = 0").select(*docs.columns)


_SQL_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP3_SQL = f"""
WITH dw AS (SELECT doc_id, {_SQL_WORDS} AS ws FROM documents),
bw AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_SQL_WORDS} AS ws FROM benchmark),
bn AS (SELECT item, ws, least({WINDOW}, len(ws)) AS n FROM bw WHERE len(ws) > 0),
bp AS (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM bn),
bwin AS (SELECT DISTINCT item, n, array_to_string(ws[p:p + n - 1], ' ') AS win FROM bp),
dp AS (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM dw, (SELECT DISTINCT n FROM bwin) WHERE len(ws) >= n),
dwin AS (SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS win FROM dp),
occ AS (SELECT doc_id, dwin.n AS n, p, item FROM dwin JOIN bwin ON dwin.win = bwin.win AND dwin.n = bwin.n),
hits AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hits ON hits.doc_id = dw.doc_id LEFT JOIN its ON its.doc_id = dw.doc_id
"""
