"""Prefix trie of conversations in double arrays.

A turn is a 24-byte symbol: the MD5 of its role and text and the UTF-8 length
of its text.  A conversation is the string of its symbols, so that the byte
order of these strings is the preorder of the trie.  The distinct strings are
dealt by range and sorted; a *prefix shard* is a run of neighbours of bounded
size.  Each shard numbers its turns densely, packs its trie into BASE and
CHECK arrays (child = BASE[node] + turn, CHECK[child] = node) and aggregates
its nodes bottom-up.

Only nodes on the path of a shard's first or last string can go on in another
shard.  Each shard hands these upper nodes on, with the sums of what hangs
below them, as the strings of a next round; rounds of the same step merge them
over all shards until one shard is left.  All other nodes are final at once.

Nothing unbounded meets in a task.  Turns are ranked from range-dealt runs, so
a conversation of any length is spread; a path longer than ``depth`` turns is
cut there, the deeper part is a trie of its own whose root (the prefix so far)
passes its sums to the node it hangs from.  Equal conversations are one row
with a count; their ids reach the hash as sorted chunks.

Rows: a null role or text is empty.  Null turns come first; equal turn numbers
are ordered by symbol (repeated rows are turns of their own).  Rows without a
``conv_id`` belong to no conversation and are passed over.  Empty and very long
texts are symbols like any other; columns beyond the four are not read.  An
empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import delete_path, stage_path, struct

#: bytes of a turn: MD5, then the length of the text
SYMBOL = 24
#: turns of the first conversation of a family that its members may share
HEAD = 8
FAMILY = 5
#: turns a shard holds (it holds at least SHARD_ROWS strings, so that rounds shrink)
SHARD_TURNS = 32_768
SHARD_ROWS = 64
#: turns of a path in one trie; deeper parts are tries of their own
DEPTH = 16_384
#: turns of one stored chunk of a conversation
CHUNK = 4_096
_NONE = np.iinfo(np.int64).max
_RUNS = "conv_id long, part int, first long, n long, turns binary"
_NODES = ("depth long, conv long, parent long, parent_key binary, key binary, n long, kids long, leaves long, saved long, "
          "ends binary, root binary")
_ITEMS = ("seq binary, e array<long>, least array<long>, kids_of array<long>, leaves_of array<long>, saved_of array<long>, "
          "ends_of array<binary>, keys_of array<binary>")
_SUMS = ("e", "least", "kids_of", "leaves_of", "saved_of")


class DoubleArray:
    """Trie over sorted strings of dense codes: ``path`` holds the cell of each
    position of each string, ``levels`` the cells of each depth."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray, alphabet: int) -> None:
        self.base = np.zeros(1024, np.int64)
        self.check = np.full(1024, -1, np.int64)
        self.check[0] = 0  # the cell above all roots
        self._top, self._gaps = 1, np.zeros(0, np.int64)
        self.path = np.zeros(len(codes), np.int64)
        self.levels: list[np.ndarray] = []
        starts = np.cumsum(lengths) - lengths
        live, at, d = np.flatnonzero(lengths), np.zeros(len(lengths), np.int64), 0
        while len(live):
            pairs, which = np.unique(at[live] * alphabet + codes[starts[live] + d], return_inverse=True)
            cells = self._place(pairs // alphabet, pairs % alphabet)
            self.levels.append(cells)
            at[live] = self.path[starts[live] + d] = cells[which]
            d += 1
            live = live[lengths[live] > d]

    def _room(self, top: int) -> None:
        if top > len(self.check):
            more = max(top, 2 * len(self.check)) - len(self.check)
            self.base = np.r_[self.base, np.zeros(more, np.int64)]
            self.check = np.r_[self.check, np.full(more, -1, np.int64)]

    def _place(self, parents: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Cells for the children ``codes`` of ``parents`` (both sorted)."""
        cells = np.zeros(len(parents), np.int64)
        first = np.flatnonzero(np.r_[True, parents[1:] != parents[:-1]])
        count = np.diff(np.r_[first, len(parents)])
        for f, n in zip(first[count > 1].tolist(), count[count > 1].tolist()):
            kids = codes[f:f + n]
            for free in self._gaps[:8].tolist():
                spots = kids + (free - kids[0])
                if spots[-1] < self._top and (self.check[spots] == -1).all():
                    break
            else:
                spots = kids + (self._top - kids[0])
                self._room(int(spots[-1]) + 1)
                between = np.ones(int(spots[-1]) + 1 - self._top, bool)
                between[spots - self._top] = False
                self._gaps = np.r_[self._gaps, np.flatnonzero(between) + self._top]
                self._top = int(spots[-1]) + 1
            self.base[parents[f]] = spots[0] - kids[0]
            self.check[spots] = parents[f]
            cells[f:f + n] = spots
        self._gaps = self._gaps[self.check[self._gaps] == -1]
        one = first[count == 1]
        self._room(self._top + len(one))
        spots = np.r_[self._gaps[:len(one)], np.arange(self._top, self._top + max(0, len(one) - len(self._gaps)))]
        self._top, self._gaps = max(self._top, int(spots.max(initial=0)) + 1), self._gaps[len(one):]
        self.base[parents[one]] = spots - codes[one]
        self.check[spots] = parents[one]
        cells[one] = spots
        return cells

    def walk(self, codes: list[int]) -> int:
        """The cell that ``codes`` lead to from the top, -1 if there is none."""
        at = 0
        for c in codes:
            to = int(self.base[at]) + c
            if not 0 < to < len(self.check) or self.check[to] != at:
                return -1
            at = to
        return at


def _dense(symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """Codes by first appearance, level by level, so that children of one node are mostly neighbours."""
    place = np.arange(len(symbols)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    _, first, which = np.unique(symbols[np.argsort(place, kind="stable")], return_index=True, return_inverse=True)
    codes = np.empty(len(symbols), np.int64)
    codes[np.argsort(place, kind="stable")] = np.argsort(np.argsort(first))[which]
    return codes, len(first)


def _keys(seq: bytes) -> list[bytes]:
    """A 16-byte key of each prefix of ``seq``."""
    state, out = hashlib.blake2b(digest_size=16), []
    for at in range(0, len(seq), SYMBOL):
        state.update(seq[at:at + SYMBOL])
        out.append(state.copy().digest())
    return out


def shard_nodes(seqs: list[bytes], sums: dict[str, list[np.ndarray]], ends: list[list], keys: list[list], last: bool) -> tuple[dict, dict]:
    """Nodes that are final in this shard, and the strings of its open (upper) nodes.

    ``sums``, ``ends`` and ``keys`` of a string belong to its last positions (all of them from the second round on).
    ``last``: this is the only shard."""
    lengths = np.array([len(s) // SYMBOL for s in seqs])
    symbols = np.frombuffer(b"".join(seqs), f"S{SYMBOL}")
    codes, alphabet = _dense(symbols, lengths)
    trie = DoubleArray(codes, lengths, alphabet)
    size = len(trie.check)
    stops = np.cumsum(lengths)
    given = np.array([len(x) for x in ends])
    spots = np.concatenate([trie.path[b - g:b] for b, g in zip(stops, given)])
    total = {name: np.zeros(size, np.int64) for name in _SUMS}
    total["least"][:] = _NONE
    for name in _SUMS:
        (np.minimum if name == "least" else np.add).at(total[name], spots, np.concatenate(sums[name]))
    n, least, kids, leaves, saved = (total[name] for name in _SUMS)
    weight = np.zeros(size, np.int64)
    weight[trie.path] = np.ascontiguousarray(symbols).view(np.uint8).reshape(-1, SYMBOL)[:, 16:].copy().view(">i8")[:, 0]
    end_of = np.full(size, None, object)
    key_of = np.full(size, None, object)
    for spot, end, key in zip(spots.tolist(), (x for s in ends for x in s), (x for s in keys for x in s)):
        if end is not None:
            end_of[spot] = end
        if key is not None:
            key_of[spot] = key
    edges = [] if last else sorted({0, len(seqs) - 1})
    is_open = np.zeros(size, bool)
    for k in edges:
        path = trie.path[stops[k] - lengths[k]:stops[k]]
        is_open[path] = True
        if any(x is None for x in key_of[path]):
            key_of[path] = np.array([*_keys(seqs[k]), None], object)[:-1]
    for cells in reversed(trie.levels):
        done = cells[~is_open[cells]]
        leaves[done] = np.where(kids[done] == 0, 1, leaves[done])
        saved[done] += (n[done] - 1) * weight[done]
        up = trie.check[done]
        np.add.at(n, up, n[done])
        np.minimum.at(least, up, least[done])
        np.add.at(kids, up, 1)
        np.add.at(leaves, up, leaves[done])
        np.add.at(saved, up, saved[done])
    depth = np.repeat(np.arange(len(trie.levels)), [len(c) for c in trie.levels])
    cells = np.concatenate(trie.levels)
    depth, cells = depth[~is_open[cells]], cells[~is_open[cells]]
    up = trie.check[cells]
    below = (depth > 0) & ~is_open[up]
    of_open = (depth > 0) & is_open[up]
    root = np.full(len(cells), None, object)
    if (depth == 0).any():
        name = dict(zip(trie.path[stops - lengths].tolist(), (s[:SYMBOL] for s in seqs)))
        root[depth == 0] = np.array([*(name[c] for c in cells[depth == 0].tolist()), None], object)[:-1]
    nodes = {
        "depth": depth, "conv": least[cells], "parent": pa.array(least[up], mask=~below),
        "parent_key": np.where(of_open, key_of[up], None), "key": key_of[cells], "n": n[cells], "kids": kids[cells],
        "leaves": leaves[cells], "saved": saved[cells], "ends": end_of[cells], "root": root}
    items: dict[str, list] = {name: [] for name in ("seq", *_SUMS, "ends_of", "keys_of")}
    told = np.zeros(size, bool)
    for k in edges:
        path = trie.path[stops[k] - lengths[k]:stops[k]]
        new = ~told[path]
        items["seq"].append(seqs[k])
        for name in _SUMS:
            items[name].append(np.where(new, total[name][path], _NONE if name == "least" else 0))
        items["ends_of"].append(np.where(new, end_of[path], None))
        items["keys_of"].append(key_of[path])
        told[path] = True
    return nodes, items


def _shards(last: bool, turns: int, rows: int):
    """Arrow step over sorted strings: a row a final node, or a row an open string."""
    out = to_arrow_schema(struct(f"{_NODES}, {_ITEMS}"))

    def table(cols: dict, count: int) -> pa.RecordBatch:
        made = []
        for f in out:
            c = cols.get(f.name)
            made.append(pa.nulls(count, f.type) if c is None else c.cast(f.type) if isinstance(c, pa.Array) else pa.array(list(c), f.type))
        return pa.RecordBatch.from_arrays(made, schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        load = 0

        def flush() -> Iterator[pa.RecordBatch]:
            sums = {name: [np.array(r[name], np.int64) for r in held] for name in _SUMS}
            nodes, items = shard_nodes([r["seq"] for r in held], sums, [r["ends_of"] for r in held], [r["keys_of"] for r in held], last)
            if len(nodes["depth"]):
                yield table(nodes, len(nodes["depth"]))
            if items["seq"]:
                yield table(items, len(items["seq"]))

        for batch in batches:
            for lot in range(0, batch.num_rows, 256):
                for row in batch.slice(lot, 256).to_pylist():
                    held.append(row)
                    load += len(row["seq"]) // SYMBOL
                    if not last and load >= turns and len(held) >= rows:
                        yield from flush()
                        held.clear()
                        load = 0
        if held:
            yield from flush()

    return run


def merged_nodes(items: DataFrame, turns: int = SHARD_TURNS, rows: int = SHARD_ROWS) -> list[DataFrame]:
    """Final nodes, round by round, of the trie of ``items``."""
    spark = items.sparkSession
    found = []
    rows = max(rows, 8)  # a task leaves at most two strings of every ``rows`` and of its rest: each round at least halves them
    names = struct(_ITEMS).names
    while True:
        size = items.agg(F.count("*").alias("rows"), F.sum(F.octet_length("seq")).alias("bytes")).first()
        shards = min(-(-(size.bytes or 0) // (SYMBOL * turns)), -(-size.rows // rows))
        last = shards <= 1
        most = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # a task may work off several shards
        dealt = items.coalesce(1) if last else items.repartitionByRange(min(shards, most), "seq")
        step = dealt.sortWithinPartitions("seq").mapInArrow(_shards(last, turns, rows), struct(f"{_NODES}, {_ITEMS}"))
        both, _ = stage_path(step, "trie-round")
        found.append(both.where("seq IS NULL").drop(*names))
        if last:
            return found
        items = both.where("seq IS NOT NULL").select(*names)


def _turn_symbol(role: Column, text: Column) -> Column:
    size = F.octet_length(text).cast("long")
    name = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.unhex(F.md5(name.cast("binary"))), F.unhex(F.lpad(F.hex(size), 16, "0")))


def _runs(chunk: int):
    """Arrow step over turns sorted by conversation: chunks of neighbouring turns."""
    out = to_arrow_schema(struct(_RUNS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, first, held = None, 0, []
        rows: list[tuple] = []

        def close() -> None:
            nonlocal first, held
            if held:
                rows.append((conv, part, first, len(held), b"".join(held)))
                first, held = first + len(held), []

        for batch in batches:
            for c, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if c != conv:
                    close()
                    conv, first = c, 0
                held.append(s)
                if len(held) == chunk:
                    close()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), out)], schema=out)
                rows.clear()
        close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, t.type) for x, t in zip(zip(*rows), out)], schema=out)

    return run


def _joined(at: str, body: str) -> Column:
    """Group's binary strings ``body`` in the order of ``at``, as one."""
    parts = F.array_sort(F.collect_list(F.struct(F.col(at).alias("a"), F.hex(body).alias("b"))))
    return F.unhex(F.array_join(F.transform(parts, lambda p: p["b"]), ""))


def _cut(body: Column, at: Column, n: Column) -> Column:
    """``n`` turns of ``body`` from turn ``at``."""
    return body.substr((at * SYMBOL + 1).cast("int"), (n * SYMBOL).cast("int"))


def rebuilt_blocks(conversations: DataFrame, depth: int = DEPTH, chunk: int = CHUNK) -> tuple[DataFrame, list[str]]:
    """``(conv_id, block, turns, total)``: every rebuilt conversation in blocks of ``depth`` turns (its last block may be
    empty); and the scratch paths it reads."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    turns = (conversations.where("conv_id IS NOT NULL")
             .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", _turn_symbol(role, text).alias("symbol")))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("symbol")]
    chunks, path = stage_path(turns.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv_id", "symbol")
                              .mapInArrow(_runs(chunk), struct(_RUNS)), "turn-runs")
    before = Window.partitionBy("conv_id").orderBy("part", "first").rowsBetween(Window.unboundedPreceding, -1)
    rank = chunks.select("conv_id", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = chunks.join(rank, ["conv_id", "part", "first"]).select("conv_id", "start", "n", "turns")
    heads = (placed.where((F.col("start") < HEAD) & (F.col("conv_id") % FAMILY == 0))
             .withColumn("head", _cut(F.col("turns"), F.lit(0), F.least(F.lit(HEAD) - F.col("start"), "n")))
             .groupBy("conv_id").agg(_joined("start", "head").alias("head")))
    share = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    convs = (chunks.groupBy("conv_id").agg(F.sum("n").alias("own"))
             .select("conv_id", "own", share.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
             .join(heads.withColumnRenamed("conv_id", "base"), "base", "left")
             .withColumn("head", _cut(F.coalesce("head", F.unhex(F.lit(""))), F.lit(0), F.col("h")))
             .withColumn("lent", (F.octet_length("head") / SYMBOL).cast("long"))
             .withColumn("total", F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    narrow = convs.select("conv_id", "h", "lent", "total")
    skip = F.greatest(F.col("h") - F.col("start"), F.lit(0))
    own = (placed.join(narrow, "conv_id").withColumn("skip", skip).where("n > skip")
           .select("conv_id", "total", (F.col("start") + F.col("skip") - F.col("h") + F.col("lent")).alias("at"),
                   (F.col("n") - F.col("skip")).alias("n"), _cut(F.col("turns"), F.col("skip"), F.col("n")).alias("turns")))
    lent = convs.where("lent > 0").select("conv_id", "total", F.lit(0).cast("long").alias("at"), F.col("lent").alias("n"), F.col("head").alias("turns"))
    stop = convs.select("conv_id", "total", F.col("total").alias("at"), F.lit(0).cast("long").alias("n"), F.unhex(F.lit("")).alias("turns"))
    block = lambda at: F.floor(at / depth)
    pieces = (own.union(lent).union(stop)
              .withColumn("block", F.explode(F.sequence(block(F.col("at")), block(F.col("at") + F.greatest("n", F.lit(1)) - 1))))
              .withColumn("from", F.greatest(F.col("block") * depth - F.col("at"), F.lit(0)))
              .withColumn("upto", F.least((F.col("block") + 1) * depth - F.col("at"), "n"))
              .select("conv_id", "block", "total", (F.col("at") + F.col("from")).alias("at"),
                      _cut(F.col("turns"), F.col("from"), F.col("upto") - F.col("from")).alias("turns")))
    return pieces.groupBy("conv_id", "block", "total").agg(_joined("at", "turns").alias("turns")), [path]


def _digests(ends: DataFrame) -> DataFrame:
    """``(q, ends)``: SHA-256 of the ids of each ``q``, from sorted chunks of ids."""
    chunks = (ends.groupBy("q", F.shiftright("conv_id", 12).alias("chunk"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state, done = None, None, []
        for batch in batches:
            for q, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if q != now:
                    if state:
                        done.append((now, state.digest()))
                    now, state = q, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.binary()) for x in zip(*done)], names=["q", "ends"])
                done = []
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in (now, state.digest())], names=["q", "ends"])

    return (chunks.repartition("q").sortWithinPartitions("q", "chunk").select("q", "ids")
            .mapInArrow(run, struct("q binary, ends binary")))


def conversation_trie(conversations: DataFrame, depth: int = DEPTH, turns: int = SHARD_TURNS, rows: int = SHARD_ROWS, chunk: int = CHUNK) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``."""
    spark = conversations.sparkSession
    blocks, used = rebuilt_blocks(conversations, depth, chunk)
    blocks, path = stage_path(blocks, "conversation-blocks")
    for old in used:
        delete_path(spark, old)
    deepest = (blocks.agg(F.max("block")).first()[0] or 0)
    blocks = blocks.withColumn("name", F.md5("turns"))
    if deepest:
        # prefixes are named by the blocks before; only conversations of several blocks are looked up
        many = blocks.where(F.col("total") >= depth).select("conv_id", "block", "name")
        before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        path_of = many.select("conv_id", "block", F.md5(F.concat_ws(",", F.collect_list("name").over(before)).cast("binary")).alias("prefix"))
        blocks = blocks.join(path_of, ["conv_id", "block"], "left")
    else:
        blocks = blocks.withColumn("prefix", F.lit(None).cast("string"))
    zero = F.unhex(F.lit("0" * 16))
    top = F.md5(F.lit("").cast("binary"))
    blocks = blocks.withColumn("prefix", F.coalesce("prefix", top)).withColumn("ended", (F.floor(F.col("total") / depth) == F.col("block")).cast("long"))
    if deepest:
        following = blocks.where("block > 0").select("conv_id", (F.col("block") - 1).alias("block"), F.unhex("prefix").alias("next"))
        blocks = blocks.join(following, ["conv_id", "block"], "left")
    else:
        blocks = blocks.withColumn("next", F.lit(None).cast("binary"))
    blocks = blocks.withColumn("seq", F.concat(F.unhex("prefix"), zero, F.col("turns")))
    found, roots = [], None
    for level in range(deepest, -1, -1):
        here = blocks.where(F.col("block") == level)
        sets = (here.groupBy("seq").agg(F.sum("ended").alias("e0"), F.min(F.when(F.col("ended") == 1, F.col("conv_id"))).alias("least0"), F.max("next").alias("next"))
                .withColumn("q", F.unhex(F.md5("seq"))))
        ends = _digests(here.where("ended = 1").select(F.unhex(F.md5("seq")).alias("q"), "conv_id"))
        sets = sets.join(ends, "q", "left")
        extra = [F.lit(0).cast("long").alias(c) for c in ("n", "kids", "leaves", "saved")] + [F.lit(None).cast("long").alias("conv"), F.lit(None).cast("binary").alias("deep_ends")]
        if roots is None:
            sets = sets.select("*", *extra)
        else:
            sets = sets.join(roots.withColumnRenamed("root", "next").withColumnRenamed("ends", "deep_ends"), "next", "left")
        zeroed = {c: F.coalesce(c, F.lit(0)) for c in ("n", "kids", "leaves", "saved")}
        items = sets.select(
            "seq", F.array(F.col("e0") + zeroed["n"]).alias("e"),
            F.array(F.coalesce(F.least("least0", "conv"), F.lit(int(_NONE)))).alias("least"), F.array(zeroed["kids"]).alias("kids_of"),
            F.array(zeroed["leaves"]).alias("leaves_of"), F.array(zeroed["saved"]).alias("saved_of"),
            F.array(F.coalesce("ends", "deep_ends")).alias("ends_of"), F.array(F.lit(None).cast("binary")).alias("keys_of"))
        items, items_path = stage_path(items, "trie-items")
        level_nodes = merged_nodes(items, turns, rows)
        delete_path(spark, items_path)
        whole = level_nodes[0]
        for more in level_nodes[1:]:
            whole = whole.union(more)
        roots = whole.where("depth = 0").select(F.substring("root", 1, 16).alias("root"), "n", "conv", "kids", "leaves", "saved", "ends")
        found.append(whole.select("*", F.lit(level * depth).cast("long").alias("above"), F.lit(level > 0).alias("inner")))
    delete_path(spark, path)
    nodes = found[0]
    for more in found[1:]:
        nodes = nodes.union(more)
    names = nodes.where("key IS NOT NULL").select(F.col("key").alias("parent_key"), F.col("conv").alias("found"))
    shown = nodes.where("NOT (inner AND depth = 0)")
    # a parent that several shards share has its smallest member only after the last round
    resolved = shown.where("parent_key IS NULL").select("*", F.col("parent").alias("parent_conv_id")).union(
        shown.where("parent_key IS NOT NULL").join(names, "parent_key").select(*shown.columns, F.col("found").alias("parent_conv_id")))
    return resolved.select(
        F.col("conv").alias("conv_id"), (F.col("depth") + F.col("above")).alias("depth"), "parent_conv_id", F.col("n").alias("n_convs"),
        F.col("kids").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.lower(F.coalesce(F.hex("ends"), F.lit(hashlib.sha256().hexdigest()))).alias("ends_sha256"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
