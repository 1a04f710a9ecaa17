"""Language ID by Bayesian evidence fusion.

The posterior of a document's language is the product of
  * the text's likelihood: hashed letter trigrams under one multinomial per
    language, against ``und``, the uniform distribution (text of no known language);
  * the markup language its page declares, and the language its address names
    (path segment or country suffix), each by a confusion table
    ``P(declared | language)`` counted over all documents;
  * the prior of its host, smoothed towards the host's domain and that towards
    the whole corpus (Dirichlet, ``strength`` pseudo-counts a level), from
    grouped counts over all documents.

The trigram models are fitted on a sample stratified by declared language, with
the declarations as labels: so many documents of each that ``FIT_ROWS`` are used, all
documents of the rare ones, ``LEAST_ROWS`` of each at least.  Every declared
language is known.  One with fewer than ``LEAST_TRIGRAMS`` trigrams is thin: its
model says little, so in documents whose markup, address or host names it, its
likelihood is at least that of text that fits the best model a little worse
(``MARGIN``) than that model's own text does; the other evidence decides.  Markup and the
``lang`` column are free text, so models are kept for the ``MODELS`` most declared
languages only; all others share one place: in a document whose markup or address
names one of them it stands for that language, weighed like a thin one.  So models,
counts and what is kept of a document do not grow with the number of declared
strings.  Counts of hosts and confusions cover every document.  A document without a page uses its ``lang``
column as declaration and its ``source`` as host.  Rejected are documents whose
best language has a posterior under ``MIN_CONFIDENCE`` or is ``und``; texts
without any letter are ``und``.

Rows: null text is empty; null ``lang``, ``source``, url or html is no evidence
of that kind.  Of several pages of a document the one with the smallest page_id
counts.  Repeated rows are judged alike; of languages with equal posteriors the first
by name wins; very long texts are read whole.  Other columns pass through the
pipeline stage whatever their names, but names that begin with two underscores are
the stages' own.  Empty tables give no rows; without
any declared language every document is ``und``.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, column, documents, numbered, stage, texts

FIT_ROWS = 20_000
#: languages with a model of their own
MODELS = 64
BUCKETS = 1 << 14
#: fitted documents of each language, if it has so many
LEAST_ROWS = 100
#: with fewer trigrams than this a language's model is hardly more than its pseudo-counts
LEAST_TRIGRAMS = BUCKETS
#: log-probability a trigram by which text of a language without a model of its own is worse than that of the best model
MARGIN = 0.3
#: trigrams overlap, so each counts for a third
TEMPER = 1 / 3
#: share of the uniform distribution in each language's model: a short text of rare trigrams is not yet no language
UNIFORM = 0.1
STRENGTH = 20.0
MIN_CONFIDENCE = 0.5
UND = "und"
#: the place of all declared languages without a model
OTHER = "*"
MARKUP = r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2,3})"
PAGE_ID = r"/([0-9]{1,18})(?:\.[a-z]+)?/?(?:[?#].*)?$"
HOST = r"^[A-Za-z]+://([^/:?#]+)"
PATH_LANG = r"^[A-Za-z]+://[^/]+/([A-Za-z]{2})(?:[/?#]|$)"
SUFFIX = r"\.([A-Za-z]{2})$"


@lru_cache(maxsize=1)
def _fold_table() -> np.ndarray:
    """Lower-case letter of each code point, 32 for all else."""
    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        s = chr(c)
        if s.isalpha():
            low = s.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def trigrams(bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter trigrams of all texts, and the text each is from."""
    codes = [np.frombuffer(b.encode("utf-32-le"), np.uint32) for b in bodies]
    size = np.array([len(c) for c in codes])
    cp = _fold_table()[np.concatenate(codes)] if size.sum() else np.zeros(0, np.uint32)
    text = np.repeat(np.arange(len(bodies)), size)
    if len(cp) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b, c = cp[:-2], cp[1:-1], cp[2:]
    real = (text[2:] == text[:-2]) & (b != 32) & ((a != 32) | (c != 32))
    h = a * np.uint32(0x9E3779B1) ^ b * np.uint32(0x85EBCA6B) ^ c * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    h = h * np.uint32(0x2C1B3C6D)
    return (h >> np.uint32(18)).astype(np.int64)[real], text[1:-1][real]


def quota(counts: list[int], rows: int) -> int:
    """Documents to take of each language, so that about ``rows`` are taken together."""
    left, counts = rows, sorted(counts)
    for k, n in enumerate(counts):
        if n * (len(counts) - k) > left:
            return max(LEAST_ROWS, left // (len(counts) - k))
        left -= n
    return max(LEAST_ROWS, counts[-1] if counts else 0)


class Models:
    """The trigram models: log-probabilities (language x bucket), the mean log-probability
    of each language's own text, and the languages that have too little text."""

    def __init__(self, langs: list[str], table: np.ndarray):
        size = table.sum(axis=1)
        share = (table + 0.5) / (table + 0.5).sum(axis=1, keepdims=True)
        self.langs, self.log = langs, np.log((1 - UNIFORM) * share + UNIFORM / BUCKETS)
        self.own = (table * self.log).sum(axis=1) / np.maximum(size, 1)
        self.thin = [l for l, n in zip(langs, size) if n < LEAST_TRIGRAMS]


def fit_trigrams(docs: DataFrame, evidence: DataFrame, rows: int = FIT_ROWS) -> Models:
    """Models of the most declared languages from a bounded sample of each."""
    said = stage(add_evidence(docs.drop("text"), evidence).where(F.col("declared").isNotNull() & ~F.col("declared").isin("", UND))
                 .select("__row", "key", "declared"), "language-declared")
    top = said.where(F.col("declared") != OTHER).groupBy("declared").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "declared").limit(MODELS)
    sizes = {r.declared: r.n for r in top.collect()}
    langs, most = sorted(sizes), quota(list(sizes.values()), rows)
    limits = docs.sparkSession.createDataFrame([(l, min(1 << 30, most * (1 << 30) // n)) for l, n in sizes.items()], "declared string, limit long")
    some = (said.join(F.broadcast(limits), "declared")
            .where(F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) < F.col("limit")).select("__row"))
    known = add_evidence(docs.join(F.broadcast(some), "__row", "left_semi"), evidence).where(F.col("declared").isin(langs))

    def count(batch: pa.RecordBatch) -> dict:
        langs = np.array(column(batch, "declared").to_pylist())
        buckets, text = trigrams(texts(batch))
        names, code = np.unique(langs, return_inverse=True)
        key, n = np.unique(code[text] * BUCKETS + buckets, return_counts=True)
        return {"lang": names[key // BUCKETS].tolist(), "bucket": key % BUCKETS, "n": n}

    table = np.zeros((len(langs), BUCKETS))
    if langs:
        counts = arrow_map(known.select("declared", "text"), count, "lang string, bucket int, n long")
        place = {l: k for k, l in enumerate(langs)}
        for r in counts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect():  # a row for each language and bucket
            table[place[r.lang], r.bucket] = r.n
    return Models(langs, table)


def likelihoods(bodies: list[str], model: np.ndarray) -> np.ndarray:
    """Log-likelihood of each text, a column for each language and one for ``und``;
    texts without letters have none but ``und``."""
    buckets, text = trigrams(bodies)
    n = np.bincount(text, minlength=len(bodies))
    out = np.zeros((len(bodies), len(model) + 1))
    for k, row in enumerate(model):
        out[:, k] = np.bincount(text, weights=row[buckets], minlength=len(bodies))
    out[:, -1] = -n * np.log(BUCKETS)
    out *= TEMPER
    letters = np.array([any(c.isalpha() for c in b) for b in bodies], bool)
    out[~letters, :-1] = -50.0
    return out


def page_evidence(pages: DataFrame) -> DataFrame:
    """``(key, page struct<page_id, markup, host, suffix>)``, stored: the page of each document."""
    def found(text: Column, pattern: str) -> Column:
        return F.nullif(F.lower(F.regexp_extract(text, pattern, 1)), F.lit(""))

    host = found(F.col("url"), HOST)
    of = pages.select(found(F.col("url"), PAGE_ID).cast("long").alias("key"), F.struct(
        "page_id", found(F.col("html"), MARKUP).alias("markup"), host.alias("host"),
        F.coalesce(found(F.col("url"), PATH_LANG), found(host, SUFFIX)).alias("suffix")).alias("page"))
    return stage(of.where("key IS NOT NULL").groupBy("key").agg(F.min("page").alias("page")), "page-evidence")


def add_evidence(rows: DataFrame, evidence: DataFrame) -> DataFrame:
    """``rows(key, own, from, ...)`` with ``declared``, ``suffix`` and ``host``."""
    return rows.join(evidence, "key", "left").select(
        *[c for c in rows.columns if c not in ("own", "from")], F.coalesce("page.markup", "own").alias("declared"),
        F.col("page.suffix").alias("suffix"), F.coalesce("page.host", "from").alias("host"))


def domain(host: Column) -> Column:
    """The last two labels of a host; all sources share one domain."""
    return F.when(host.startswith("source:"), "source:").otherwise(F.substring_index(host, ".", -2))


def identify(docs: DataFrame, pages: DataFrame, fit_rows: int = FIT_ROWS, strength: float = STRENGTH) -> DataFrame:
    """``(__row, key, language, confidence, text_language, declared, host)`` of
    ``docs`` (numbered by ``__row``)."""
    spark = docs.sparkSession
    rows = docs.select("__row", F.col("doc_id").cast("long").alias("key"), "text", F.lower("lang").alias("own"),
                       F.concat(F.lit("source:"), "source").alias("from"))
    evidence = page_evidence(pages)
    models = fit_trigrams(rows, evidence, fit_rows)
    langs, thin = models.langs, models.thin
    names = [*langs, OTHER, UND]
    place = {n: k for k, n in enumerate(names[:-1])}
    shared = spark.sparkContext.broadcast((models.log, models.own))

    said = [*langs, UND]

    def score(batch: pa.RecordBatch) -> dict:
        model, own = shared.value
        ll = likelihoods(texts(batch), model)
        level = ll[:, -1]  # of a thin language that other evidence names
        if langs:
            top = ll[:, :-1].argmax(axis=1)
            level = np.where(ll[:, 0] == -50.0, -50.0, level / -np.log(BUCKETS) * (own[top] - MARGIN))  # -50: no letters
        return {n: column(batch, n) for n in ("__row", "key", "own", "from")} | {
            "ll": ll.tolist(), "level": level, "top": ll.max(axis=1), "best": [said[k] for k in ll.argmax(axis=1)]}

    scored = arrow_map(rows, score, "__row long, key long, own string, from string, ll array<double>, level double, top double, best string")
    named = F.lit(None).cast("string")
    for name in ("suffix", "declared") if thin else ():
        named = F.when(F.col(name).isin(thin), F.col(name)).otherwise(named)
    unmodelled = [F.when(~F.col(name).isin("", UND, OTHER, *langs), F.col(name)) for name in ("declared", "suffix")]
    named = F.coalesce(named, F.when(F.col("other").isNotNull(), F.lit(OTHER)))
    seen = stage(add_evidence(scored, evidence).withColumn("other", F.coalesce(*unmodelled)).withColumn("best", F.when(F.col("level") >= F.col("top"), F.coalesce(named, "best"))
                                                           .otherwise(F.col("best"))).drop("top"), "language-likelihoods")

    def confusion(name: str) -> np.ndarray:
        """log P(declared | language); the last column is for all other declarations."""
        n = np.full((len(names), len(langs) + 1), min(0.5, 2.5 / (len(langs) + 1)))
        other = F.when(F.col(name).isin(langs), F.col(name)).otherwise("").alias("said") if langs else F.lit("").alias("said")
        for r in seen.where(F.col(name).isNotNull()).groupBy("best", other).agg(F.count("*").alias("n")).collect():
            n[place.get(r.best, -1), place.get(r.said, -1)] += r.n
        return np.log(n / n.sum(axis=1, keepdims=True))

    def by_language(rows: DataFrame, of: str, name: str) -> DataFrame:
        """How many rows of each ``of`` have which best language."""
        return rows.groupBy(of).agg(F.map_from_entries(F.collect_list(F.struct("best", "n"))).alias(name))  # an entry for each language

    host = seen.where("host IS NOT NULL").groupBy("host", "best").agg(F.count("*").alias("n")).withColumn("domain", domain(F.col("host"))).checkpoint()
    wide = host.groupBy("domain", "best").agg(F.sum("n").alias("n"))
    whole = np.ones(len(names))
    for r in seen.groupBy("best").agg(F.count("*").alias("n")).collect():  # a row for each language
        whole[place.get(r.best, -1)] += r.n
    prior = (by_language(host, "host", "here").withColumn("domain", domain(F.col("host")))
             .join(by_language(wide, "domain", "around"), "domain").select("host", "here", "around"))
    tables = spark.sparkContext.broadcast((whole / whole.sum(), confusion("declared"), confusion("suffix")))

    def smoothed(counts: list[tuple[str, int]], p: np.ndarray) -> np.ndarray:
        out = strength * p
        for name, n in counts:
            out[place.get(name, -1)] += n
        return out / (sum(n for _, n in counts) + strength)

    faint, said_of = {place[n] for n in thin}, [*langs, UND]

    def fuse(batch: pa.RecordBatch) -> dict:
        whole, said, named = tables.value
        text = np.array(column(batch, "ll").to_pylist(), float).reshape(batch.num_rows, len(names) - 1)
        text_best = text.argmax(axis=1)
        level = column(batch, "level").to_numpy()
        other = column(batch, "other").to_pylist()
        post = np.insert(text, len(langs), np.where([o is None for o in other], -1e9, level), axis=1)
        known: dict[str, np.ndarray] = {}
        evidence = zip(*(column(batch, n).to_pylist() for n in ("host", "here", "around", "declared", "suffix")))
        for k, (host, here, around, *words) in enumerate(evidence):
            if host not in known:
                known[host] = smoothed(here, smoothed(around, whole)) if here else whole
            p = known[host]
            for t in faint & {*map(place.get, words), int(p.argmax()) if here else -1}:
                post[k, t] = max(post[k, t], level[k])
            post[k] += np.log(p)
            for value, table in zip(words, (said, named)):
                if value is not None:
                    post[k] += table[:, place.get(value, -1)]
        post = np.exp(post - post.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        best = post.argmax(axis=1)
        return {n: column(batch, n) for n in ("__row", "key", "declared", "host")} | {
            "language": [other[i] if names[k] == OTHER else names[k] for i, k in enumerate(best)], "confidence": post.max(axis=1),
            "text_language": [said_of[k] for k in text_best]}

    return arrow_map(seen.join(prior, "host", "left"), fuse, "__row long, key long, language string, confidence double, "
                     "text_language string, declared string, host string", None)


def accepted() -> Column:
    return (F.col("language") != UND) & (F.col("confidence") >= MIN_CONFIDENCE)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source").withColumn("__row", F.monotonically_increasing_id())
    out = identify(docs, spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return out.select(F.col("key").alias("doc_id"), "language", "confidence", "text_language", "declared", "host",
                      accepted().alias("accepted"))


def stage_language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rejected documents go; ``lang`` of the others is the identified language."""
    rows = numbered(docs, "language-rows")
    found = identify(rows.select("__row", "doc_id", "text", "lang", "source"), spark.read.parquet(f"{sf_dir}/pages.parquet"))
    kept = found.where(accepted()).select("__row", F.col("language").alias("__language"))
    both = rows.join(kept.hint("shuffle_hash"), "__row")
    return both.select(*[F.col("__language").alias("lang") if c == "lang" else c for c in docs.columns])
