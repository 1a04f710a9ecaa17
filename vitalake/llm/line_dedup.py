"""Line dedup by levelled sorted runs of line hashes, DataFrame functions only.

``LineRuns`` keeps every line key seen so far as sorted runs of
``(h1, h2, owner)`` in the shared folder.  A new batch is reduced to its
distinct keys, merge-anti-joined with the runs, and what is left becomes a run
of its own at level 0; a level that has gathered ``fanout`` runs is merged
into one run of the next level.  So a key is written once per level and the
number of live runs stays logarithmic in the number of batches.

A key is 128 bits (two xxhash64 values), so that 10^12 distinct lines still
have no expected collision.  Keys are pre-aggregated before each shuffle, and
the join of lines with their owners is a plain sort-merge join that adaptive
execution can split where one line is very common.

Rows: a null or empty text is one empty line.  A null ``doc_id`` ranks after
every other id.  Rows that repeat a ``doc_id`` are the same document: they
count once, and each row is rewritten by itself.  An empty table gives no row.
Columns other than the id and the text are passed through by
``drop_repeated_lines`` whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete_path, documents, scratch

BLANK = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_KEY = 10
BATCHES = 3
FANOUT = 2
LAST_ID = (1 << 63) - 1


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z lower-cased."""
    k = F.btrim(line, F.lit(BLANK))
    return F.when(F.octet_length(k) == F.char_length(k), F.lower(k)).otherwise(F.translate(k, UPPER, LOWER))


def text_lines(docs: DataFrame) -> DataFrame:
    """``(did, th, pos, h1, h2)``: the long-enough lines of ``docs(did, body)``."""
    lines = (docs.select("did", F.xxhash64("body").alias("th"), F.posexplode(F.split("body", "\n")).alias("pos", "line"))
             .select("did", "th", "pos", line_key(F.col("line")).alias("key"))
             .where(F.char_length("key") >= MIN_KEY))
    return lines.select("did", "th", "pos", F.xxhash64("key").alias("h1"),
                        F.xxhash64(F.lit(1), "key").alias("h2"))


class LineRuns:
    """Sorted runs of line keys with their first owner, by level."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[str]] = []

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, owner long").parquet(*paths)

    def all(self) -> DataFrame | None:
        paths = [p for level in self.levels for p in level]
        return self._read(paths) if paths else None

    def _write(self, rows: DataFrame, level: int) -> None:
        path = scratch(self.spark, f"line-run-{level}")
        rows.sortWithinPartitions("h1", "h2").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def add(self, lines: DataFrame) -> None:
        """Add a batch: its keys that no run holds become a new run."""
        batch = lines.groupBy("h1", "h2").agg(F.min("did").alias("owner"))
        held = self.all()
        if held is not None:
            batch = batch.hint("merge").join(held.select("h1", "h2"), ["h1", "h2"], "left_anti")
        self._write(batch, 0)
        self._compact()

    def _compact(self) -> None:
        for k, level in enumerate(self.levels):
            if len(level) >= self.fanout:
                self._write(self._read(level).repartition("h1"), k + 1)
                self.levels[k] = []
                for path in level:
                    delete_path(self.spark, path)
                return self._compact()


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Upper ids of all batches but the last, from the id quantiles."""
    if batches < 2:
        return []
    cuts = docs.agg(F.percentile_approx("did", [i / batches for i in range(1, batches)], 1000).alias("q")).first().q
    return sorted(set(cuts or []))


def build_runs(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> LineRuns:
    """Feed ``docs(did, body)`` to the runs in batches of ascending ids, so that
    the run that holds a key first names the smallest id."""
    runs = LineRuns(docs.sparkSession, fanout)
    low = None
    for high in [*batch_bounds(docs, batches), None]:
        part = docs
        if low is not None:
            part = part.where(F.col("did") > low)
        if high is not None:
            part = part.where(F.col("did") <= high)
        runs.add(text_lines(part))
        low = high
    return runs


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """All columns of ``docs`` under ``_in`` (a struct), with ``_kept`` (the text
    without repeated lines), ``_n_lines`` and ``_n_dropped``."""
    base = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_in"),
                       F.coalesce(docs[id_col].cast("long"), F.lit(LAST_ID)).alias("did"),
                       F.coalesce(docs[text_col], F.lit("")).alias("body"))
    keyed = base.select("did", "body")
    owners = build_runs(keyed, batches, fanout).all()
    drops = (text_lines(keyed).join(owners, ["h1", "h2"]).where("owner <> did")
             .select("did", "th", "pos").distinct()
             .groupBy("did", "th").agg(F.collect_list("pos").alias("drop")))
    body = base.withColumn("th", F.xxhash64("body"))
    both = body.join(drops.hint("shuffle_hash"), ["did", "th"], "left").select("_in", "body", "drop")
    cut = both.select("_in", "body", "drop", F.split("body", "\n").alias("lines"))
    n = F.size("lines")
    kept = F.transform(F.array_except(F.sequence(F.lit(1), n), F.transform("drop", lambda p: p + 1)),
                       lambda i: F.element_at("lines", i))
    return cut.select("_in", F.when(F.col("drop").isNull(), F.col("body")).otherwise(F.array_join(kept, "\n")).alias("_kept"),
                      n.cast("long").alias("_n_lines"),
                      F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("_n_dropped"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = drop_repeated_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select(F.col("_in.doc_id").alias("doc_id"), F.col("_n_lines").alias("n_lines"),
                      F.when(F.col("_n_dropped") > 0, F.col("_n_dropped")).otherwise(0).cast("long").alias("n_dropped"),
                      F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: ``text`` loses its repeated lines, ``n_chars`` follows;
    every document stays."""
    out = drop_repeated_lines(docs)
    new = {"text": F.col("_kept"), "n_chars": F.char_length("_kept")}
    return out.select(*[(new[f.name].cast(f.dataType) if f.name in new else F.col("_in").getField(f.name)).alias(f.name)
                        for f in docs.schema])


OP4_SQL = """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM d),
k AS (SELECT doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, min(doc_id) AS own FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.doc_id, k.line, k.pos, coalesce(o.own <> k.doc_id, false) AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
