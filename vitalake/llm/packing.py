"""Best-fit packing by a configuration linear program.

Only the length histogram (one row per length up to the capacity) reaches the
driver.  A configuration says how many pieces of each length share a sequence.
The program, minimise the number of sequences so that the configurations cover
each length's count, is solved by multiplicative weights in two loops:

* pricing: a length's price is its size times the exponential of how far its
  coverage lags behind; a knapsack dynamic program over the capacity finds the
  best configuration for these prices, which becomes a column and takes an equal
  share of the volume.  Every price vector is a dual solution, the best one
  bounds all packings from below;
* weights: the columns found are multiplied, sweep by sweep, by the (geometric
  mean) ratio of wanted and given pieces of their lengths, which brings the
  fractional solution to the counts.

The fractional solution is rounded column by column, carrying what is rounded
off, in several orders; columns that leave more room than the dual bound calls
for are not used beyond a slack, and a part of the short pieces is held back, so
that what remains still packs well by best fit.  Of the rounded solutions, and
the starting solution (the columns of a plain best fit), the one with the fewest
sequences is the plan.  The plan is a short table
``(length, first rank, sequence, ...)`` whose size depends on the capacity and
the rounds, not on the corpus; it also holds the bound, the fractional value and
the number of pieces that the program placed.

Pieces get their rank within their length from counts by (length, salt), so a
length that a third of all pieces share is numbered by many tasks, as many as
its count calls for; rank and plan give sequence and offset without any further
shuffle.

Rows: a null or empty text is the end id alone; a very long one is cut.  Null
and repeated ids are packed row by row (equal rows are interchangeable, so ties
have no effect).  Other columns are not read.  An empty table gives no sequences.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, column, documents, stage, texts
from .tokens import encoder

CAPACITY = 1024
END_ID = 2
#: pricing rounds (columns) and sweeps of the weights
ROUNDS = 2500
SWEEPS = 300
#: how fast prices follow the lag of a length
RATE = 6.0
#: room, as a share of the capacity, that a rounded column may leave above the one the bound calls for; and orders tried for each
SLACKS = (0.0, 0.001, 0.002, 0.005)
ORDERS = 6
#: pieces up to this share of the capacity of which HELD_BACK stay for best fit
SHORT = 1 / 8
HELD_BACK = 0.3
#: rows that one salt numbers
SALT_ROWS = 500_000


def best_configuration(price: np.ndarray, lengths: np.ndarray, capacity: int) -> dict[int, int]:
    """The configuration (index of a length: how many) of at most ``capacity``
    with the highest total price, by dynamic programming over the capacity."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), side="right").tolist()
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := fits[c]:
            worth = price[:n] + best[c - lengths[:n]]
            k = worth.argmax()
            if worth[k] > best[c]:
                best[c], pick[c] = worth[k], k
    counts: dict[int, int] = {}
    c = capacity
    while c > 0:
        k = int(pick[c])
        if k < 0:
            c -= 1
        else:
            counts[k] = counts.get(k, 0) + 1
            c -= int(lengths[k])
    return counts


class Plan:
    """Blocks of equal sequences; each block takes runs of ranks of its lengths."""

    def __init__(self) -> None:
        self.taken: dict[int, int] = {}
        self.rows: list[tuple[int, int, int, int, int]] = []  # length, first rank, pieces a sequence, first sequence, offset
        self.sequences = 0
        #: of the pieces shorter than the capacity: the dual bound and the fractional value of their
        #: sequences, the sequences and pieces that rounded columns hold
        self.bound = self.value = 0.0
        self.by_columns = self.placed = 0

    def add(self, config: list[tuple[int, int]], times: int) -> None:
        at = 0
        for length, many in config:
            rank = self.taken.get(length, 0)
            self.rows.append((length, rank, many, self.sequences, at))
            self.taken[length] = rank + many * times
            at += length * many
        self.sequences += times

    def arrays(self) -> dict[str, np.ndarray]:
        rows = np.array(sorted(self.rows), np.int64).reshape(-1, 5)
        return dict(zip(("length", "rank", "many", "sequence", "offset"), rows.T)) | {"key": rows[:, 0] << 44 | rows[:, 1]}


def best_fit(lengths: np.ndarray, demand: np.ndarray, capacity: int, plan: Plan) -> None:
    """Best-fit decreasing over counts: sequences in the same state are one group."""
    groups: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}  # room -> (configuration, sequences)
    for length, n in sorted(zip(lengths.tolist(), demand.tolist()), reverse=True):
        while n:
            rooms = [r for r in groups if r >= length]
            if rooms:
                room = min(rooms)
                config, times = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                many = min(room // length, n // times) if n >= times else 1
                use = times if n >= times else n
                if use < times:
                    groups.setdefault(room, []).append((config, times - use))
            else:
                many = min(capacity // length, n)
                use, config, room = n // many, [], capacity
            n -= many * use
            groups.setdefault(room - many * length, []).append(([*config, (length, many)], use))
    for same in groups.values():
        for config, times in same:
            plan.add(config, times)


def solve(lengths: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = ROUNDS,
          rate: float = RATE, sweeps: int = SWEEPS) -> tuple[list[dict[int, int]], np.ndarray, float, float]:
    """Columns, their fractional use, the dual bound and the value of the fractional solution."""
    step = float(lengths @ demand) / capacity / rounds
    columns: dict[tuple, int] = {}
    use: list[float] = []
    given, bound = np.zeros(len(lengths)), step * rounds
    for t in range(rounds):
        price = lengths * np.exp(rate * (t / rounds - given))
        config = tuple(best_configuration(price, lengths, capacity).items())
        bound = max(bound, float(price @ demand) / sum(price[k] * n for k, n in config))
        if config not in columns:
            columns[config] = len(use)
            use.append(0.0)
        use[columns[config]] += step
        for k, n in config:
            given[k] += n * step / demand[k]
    x = np.array(use)
    row, col, many = (np.array(v) for v in zip(*((k, c, n) for config, c in columns.items() for k, n in config)))
    size = np.bincount(col, many)
    for _ in range(sweeps):
        cover = np.bincount(row, many * x[col], minlength=len(lengths))
        ratio = np.log(np.clip(demand / np.maximum(cover, 1e-12), 0.2, 5))
        x *= np.exp(np.bincount(col, many * ratio[row]) / size)
    cover = np.bincount(row, many * x[col], minlength=len(lengths))
    # what the columns leave uncovered is covered by columns of one length, what they cover twice is left out
    value = float(x.sum() + (np.maximum(0, demand - cover) / (capacity // lengths)).sum())
    return [dict(c) for c in columns], x, bound, value


def rounded(lengths: np.ndarray, demand: np.ndarray, capacity: int, columns: list[dict[int, int]], x: np.ndarray, order: np.ndarray) -> tuple[Plan, np.ndarray]:
    """Whole sequences of the columns in ``order``, and the pieces that are left."""
    plan, left, carried = Plan(), demand.copy(), 0.0
    for j in order.tolist():
        carried = min(carried, 1.0) + x[j]
        times = min(int(carried), *(int(left[k]) // n for k, n in columns[j].items()))
        if times > 0:
            plan.add([(int(lengths[k]), n) for k, n in sorted(columns[j].items())], times)
            carried -= times
            for k, n in columns[j].items():
                left[k] -= n * times
    plan.by_columns, plan.placed = plan.sequences, int(demand.sum() - left.sum())
    return plan, left


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> Plan:
    counts = {k: v for k, v in histogram.items() if v}
    full = counts.pop(capacity, 0)
    lengths = np.array(sorted(counts), np.int64)
    demand = np.array([counts[k] for k in lengths.tolist()], np.int64)
    held = np.where(lengths <= SHORT * capacity, np.ceil(demand * HELD_BACK).astype(np.int64), 0)
    live = np.flatnonzero(demand - held)
    plan, bound, value = Plan(), 0.0, 0.0
    best_fit(lengths, demand, capacity, plan)
    if len(live):
        part = (demand - held)[live]
        columns, x, bound, value = solve(lengths[live], part, capacity, rounds)
        called_for = capacity * max(0.0, 1 - float(lengths[live] @ part) / capacity / bound)
        room = capacity - np.array([sum(int(lengths[live[k]]) * n for k, n in c.items()) for c in columns])
        rng = np.random.default_rng(len(columns))
        for slack in SLACKS:
            use = np.flatnonzero(room <= called_for + slack * capacity)
            for k in range(ORDERS):
                # by use, then by use times a random factor
                order = use[np.argsort(-x[use] * (rng.uniform(0.5, 2, len(use)) if k else 1), kind="stable")]
                tried, left = rounded(lengths[live], part, capacity, columns, x, order)
                rest = held.copy()
                rest[live] += left
                best_fit(lengths[rest > 0], rest[rest > 0], capacity, tried)
                if (tried.sequences, -tried.placed) < (plan.sequences, -plan.placed):
                    plan = tried
    plan.bound, plan.value = bound, value
    if full:
        plan.add([(capacity, 1)], full)
    return plan


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: the first may be shorter."""
    head = n % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = "byte_bpe_50k",
           paths: tuple[str, str] | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: the ids of each text and the end id, cut."""

    def step(batch: pa.RecordBatch) -> dict:
        rows, piece, start, length, crc = [], [], [], [], []
        for k, ids in enumerate(encoder(vocabulary, paths).encode(texts(batch))):
            whole = np.append(ids, end_id).astype("<u4")
            for p, (s, n) in enumerate(cut(len(whole), capacity)):
                rows.append(k)
                piece.append(p)
                start.append(s)
                length.append(n)
                crc.append(zlib.crc32(whole[s:s + n].tobytes()))
        return {"doc_id": column(batch, "doc_id").take(pa.array(rows, pa.int64())), "piece": piece, "start": start,
                "length": length, "ids_crc32": crc}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return arrow_map(docs.select("doc_id", "text"), step,
                     f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (with ``length``) with ``sequence_id`` and ``offset``."""
    spark = rows.sparkSession
    names = rows.columns
    histogram = {r.length: r.n for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # one row a length
    salts = max(16, -(-max(histogram.values(), default=0) // SALT_ROWS))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*names), F.lit(salts)))
    counts = salted.groupBy("length", "__salt").agg(F.count("*").alias("__n"))
    before = (Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    plan = spark.sparkContext.broadcast(make_plan(histogram, capacity).arrays())
    inside = F.row_number().over(Window.partitionBy("length", "__salt").orderBy(*names))
    ranked = (salted.withColumn("__inside", inside).join(counts, ["length", "__salt"])
              .select(*names, (F.col("__before") + F.col("__inside") - 1).alias("__rank")))

    def place(batch: pa.RecordBatch) -> dict:
        p = plan.value
        rank, length = column(batch, "__rank").to_numpy(), column(batch, "length").to_numpy()
        row = np.searchsorted(p["key"], length << 44 | rank, side="right") - 1
        inner = rank - p["rank"][row]
        many = p["many"][row]
        return {n: column(batch, n) for n in names} | {
            "sequence_id": p["sequence"][row] + inner // many, "offset": p["offset"][row] + inner % many * length}

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return arrow_map(ranked, place, f"{kinds}, sequence_id long, offset long", None)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(stage(pieces(documents(spark, sf_dir)), "pieces"))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the pieces of all documents with their sequences."""
    return pack(stage(pieces(docs), "pieces"))
