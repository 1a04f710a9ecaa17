"""Quality classifier by co-training of two views.

View one reads the text: its words (hashed) and its form (document statistics in
bins).  View two reads the metadata: language, source and size columns, and the
document's page (scheme, path, host and the make-up of its markup).  Each view is
a naive Bayes model over its tokens with a logistic calibration.

Over ``ROUNDS`` rounds both views score *all* unlabelled documents; the surest of
each view, by quantiles of its scores over all of them, in the proportion of the
classes and more in each round, become training rows of the other view.  Models
are counts of tokens by class that Spark sums over all labelled and pseudo-labelled
documents, so nothing but the count tables (of fixed size) and quantiles reaches
the driver, and no pool is cut.  Each round's views are calibrated on fold 1 of the
labelled documents (at most ``FIT_ROWS`` of them, by a hash), and a logistic
combination of both scores every document.  Fold 0 is never read.

Rows: a null text is empty; empty texts have only the tokens of their form; very
long texts are read whole.  Null metadata and missing pages are a value of their
own.  Of several pages of a document the smallest page_id counts, of several
labels the highest.  Without labels of both kinds all scores are the base rate.
Repeated rows are scored alike and count as often as they stand; ties at a
quantile are marked together.  Other columns are not read, whatever their names.
An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FOLDS, arrow_map, column, documents, fold, sampled, stage_path, delete_path, texts
from .language_id import HOST, PAGE_ID
from .quality_rules import FEATURES, matrix, statistics

FIT_ROWS = 20_000
ROUNDS = 5
#: share of the unlabelled documents that each view marks in the first round; as many more in each further one
MARK_SHARE = 0.05
KEEP = 0.5
#: slots of words, bins of a statistic, slots of a metadata feature
WORDS, BINS, SLOTS = 1 << 15, 16, 64
FORM = len(FEATURES)
_WORDS_KEPT = 400_000


def page_features(pages: DataFrame) -> DataFrame:
    """``(key, host, page array<double>)`` of each document's page."""
    def count(token: str):
        return (F.length("html") - F.length(F.replace(F.col("html"), F.lit(token), F.lit("")))) / len(token)

    html = F.greatest(F.length("html"), F.lit(1))
    numbers = [F.log1p(F.length("html")), count("<a ") / html * 1000, count("<p>") / html * 1000, count("<script") / html * 1000,
               count("class=\"ad") / html * 1000, count("<") / html * 100, F.col("url").startswith("https").cast("int"),
               F.size(F.split("url", "/")), F.col("url").contains("?").cast("int"), F.col("url").contains("#").cast("int")]
    found = pages.select(F.nullif(F.regexp_extract("url", PAGE_ID, 1), F.lit("")).cast("long").alias("key"), F.struct(
        "page_id", F.nullif(F.lower(F.regexp_extract("url", HOST, 1)), F.lit("")).alias("host"),
        F.array(*[F.coalesce(x.cast("double"), F.lit(0.0)) for x in numbers]).alias("page")).alias("p"))
    return found.where("key IS NOT NULL").groupBy("key").agg(F.min("p").alias("p")).select("key", "p.host", "p.page")


PAGE_NUMBERS = 10
META = 5 + PAGE_NUMBERS
SIZE = WORDS + FORM * BINS + META * SLOTS


class WordSlots:
    """Distinct hashed words of a text; hashes of words are kept up to a bound."""

    def __init__(self) -> None:
        self.kept: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        kept, found = self.kept, set(text.encode("utf-8", "replace").lower().split())
        if len(kept) > _WORDS_KEPT:
            kept.clear()
        for w in found:
            if w not in kept:
                kept[w] = xxhash.xxh64_intdigest(w) % WORDS
        return np.unique(np.fromiter(map(kept.__getitem__, found), np.int32, len(found)))


def features(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """``(doc_id, key, words, form, meta)``: the tokens of both views, without any text; ``form`` holds numbers."""
    names = ("doc_id", "lang", "source", "n_chars")
    slots = WordSlots()

    def step(batch: pa.RecordBatch) -> dict:
        bodies = texts(batch)
        return {n: column(batch, n) for n in names} | {"words": [slots(t) for t in bodies], "form": matrix(statistics(bodies)).tolist()}

    kinds = ", ".join(f"{n} {docs.schema[n].dataType.simpleString()}" for n in names)
    seen = arrow_map(docs.select(*names, "text"), step, f"{kinds}, words array<int>, form array<double>")
    seen = seen.withColumn("key", F.col("doc_id").cast("long")).join(page_features(pages), "key", "left")

    def name_slot(name: str):
        return F.when(F.col(name).isNull(), 0).otherwise(F.pmod(F.xxhash64(name), F.lit(SLOTS - 1)) + 1)

    def number_slot(x):
        return F.coalesce(F.least(F.greatest(F.floor(F.log1p(F.greatest(x, F.lit(0.0))) * 4), F.lit(0)) + 1, F.lit(SLOTS - 1)), F.lit(0))

    slots_of = [name_slot("source"), name_slot("lang"), name_slot("host"), number_slot(F.col("n_chars").cast("double")),
                F.col("page").isNull().cast("long"), *[number_slot(F.get("page", F.lit(k))) for k in range(PAGE_NUMBERS)]]
    meta = F.array(*[(F.lit(k * SLOTS) + s).cast("int") for k, s in enumerate(slots_of)])
    return seen.select("doc_id", "key", "words", "form", meta.alias("meta"))


class Logistic:
    """Ridge logistic regression on standardised columns, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
        z = self._design(x)
        self.w = np.zeros(z.shape[1])
        penalty = np.r_[np.full(z.shape[1] - 1, ridge), 1e-3]
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            h = np.maximum(p * (1 - p), 1e-6)
            step = np.linalg.solve(z.T @ (z * h[:, None]) + np.diag(penalty), z.T @ (p - y) + penalty * self.w)
            size = np.abs(step).max()
            self.w -= step * min(1.0, 4.0 / max(size, 1e-9))
            if size < 1e-6:
                break

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.c_[np.clip((x - self.mean) / self.scale, -8, 8), np.ones(len(x))]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._design(x) @ self.w

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


@dataclass
class Model:
    """Documents and tokens by class for both views (text, metadata), bin edges of the form,
    calibrations; ``base`` alone where a class is missing."""

    base: float
    edges: np.ndarray
    counts: np.ndarray = field(default_factory=lambda: np.zeros((2, SIZE)))  # by class
    rows: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))  # by view and class
    views: list[Logistic] | None = None
    combined: Logistic | None = None

    def odds(self) -> np.ndarray:
        of = np.r_[np.zeros(WORDS + FORM * BINS, int), np.ones(META * SLOTS, int)]
        share = (self.counts + 0.5) / (self.rows[of].T + 1)
        return np.log(share[1] / share[0])

    def scores(self, t: "Tokens") -> list[np.ndarray]:
        """What each view says of each row: mean and scaled sum of its words' log-odds, and the mean of its form's; of its metadata's."""
        odds = self.odds()
        n = np.diff(t.begin)
        words = np.add.reduceat(np.r_[odds[t.words], 0.0], np.minimum(t.begin[:-1], len(t.words))) * (n > 0)
        form = odds[WORDS + t.form].mean(axis=1)
        meta = odds[WORDS + FORM * BINS + t.meta].mean(axis=1)
        return [np.stack([words / np.maximum(n, 1), words / np.sqrt(n + 1), form], axis=1), meta[:, None]]

    def logits(self, t: "Tokens") -> list[np.ndarray]:
        return [v.logit(x) for v, x in zip(self.views, self.scores(t))]


class Tokens:
    """The tokens of a batch of rows."""

    def __init__(self, batch: pa.RecordBatch, edges: np.ndarray) -> None:
        words = column(batch, "words")
        self.words = words.flatten().to_numpy(zero_copy_only=False)
        self.begin = np.r_[0, np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
        numbers = column(batch, "form").flatten().to_numpy(zero_copy_only=False).reshape(-1, FORM)
        self.form = np.stack([np.searchsorted(edges[k], numbers[:, k], side="right") + k * BINS for k in range(FORM)], axis=1)
        self.meta = column(batch, "meta").flatten().to_numpy(zero_copy_only=False).reshape(-1, META)

    def count(self, rows: np.ndarray, view: int) -> np.ndarray:
        """Rows that hold each token, among ``rows`` (a mask)."""
        if view:
            return np.bincount(self.meta[rows].ravel() + WORDS + FORM * BINS, minlength=SIZE)
        inside = np.repeat(rows, np.diff(self.begin))
        return np.bincount(np.r_[self.words[inside], self.form[rows].ravel() + WORDS], minlength=SIZE)


def said_of(model: Model, marks: list[tuple[float, float]] | None, t: Tokens, label: np.ndarray, part: np.ndarray) -> list[np.ndarray]:
    """The class of each row for the training of each view (-1: none): its label outside the folds 0 and 1,
    or what the *other* view is surest of.  ``label`` is -1 where there is none."""
    own = np.where((label >= 0) & (part > 1), label, -1)
    if marks is None:
        return [own, own]
    open_ = (label < 0) & (part != 0)
    said = []
    for z, (low, high) in zip(model.logits(t), marks):
        said.append(np.where(open_ & (z >= high) & (z > 0), 1, np.where(open_ & (z <= low) & (z < 0), 0, own)))
    return said[::-1]


def recount(rows: DataFrame, model: Model, marks: list[tuple[float, float]] | None) -> tuple[np.ndarray, np.ndarray]:
    """Token and row counts by class over all rows, summed by Spark; the table has a fixed number of slots."""
    shared = rows.sparkSession.sparkContext.broadcast((model, marks))

    def step(batch: pa.RecordBatch) -> dict:
        model, marks = shared.value
        t = Tokens(batch, model.edges)
        said = said_of(model, marks, t, column(batch, "label").to_numpy(), column(batch, "part").to_numpy())
        counts = np.zeros((2, SIZE + 2), np.int64)
        for view in (0, 1):
            for c in (0, 1):
                mine = said[view] == c
                counts[c, :SIZE] += t.count(mine, view)
                counts[c, SIZE + view] += mine.sum()
        at = np.flatnonzero(counts.any(axis=0))
        return {"token": at, "no": counts[0, at], "yes": counts[1, at]}

    found = arrow_map(rows, step, "token int, no long, yes long", None).groupBy("token").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes")).toArrow()
    both = np.zeros((2, SIZE + 2))
    both[:, found["token"].to_numpy()] = found["no"].to_numpy(), found["yes"].to_numpy()
    return both[:, :SIZE], both[:, SIZE:].T


def calibrated(rows: DataFrame, model: Model, fit_rows: int) -> Model:
    """Logistic calibration of each view, and of both together, on the labelled rows of fold 1 (at most ``fit_rows``)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> dict:
        x = np.concatenate(shared.value.scores(Tokens(batch, shared.value.edges)), axis=1)
        return {"label": column(batch, "label"), "x": list(x)}

    known = rows.where("part = 1 AND label >= 0")
    got = arrow_map(sampled(known, F.monotonically_increasing_id(), fit_rows), step, "label int, x array<double>", None).toArrow()
    y = (got["label"].to_numpy() > 0).astype(float)
    if len(set(y.tolist())) < 2:
        model.views = None
        return model
    x = np.array(got["x"].to_pylist())
    model.views = [Logistic(x[:, :-1], y), Logistic(x[:, -1:], y)]
    model.combined = Logistic(np.stack([model.views[0].logit(x[:, :-1]), model.views[1].logit(x[:, -1:])], axis=1), y)
    return model


def quantile_marks(rows: DataFrame, model: Model, share: float) -> list[tuple[float, float]]:
    """For each view the scores below and above which it marks ``share`` of all unlabelled rows, by the classes' proportion."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def step(batch: pa.RecordBatch) -> dict:
        text, meta = shared.value.logits(Tokens(batch, shared.value.edges))
        return {"text": text, "meta": meta}

    z = arrow_map(rows.where("label < 0 AND part <> 0"), step, "text double, meta double", None)
    at = [share * (1 - model.base), 1 - share * model.base]
    got = z.agg(*[F.percentile_approx(v, F.array(*[F.lit(q) for q in at])).alias(v) for v in ("text", "meta")]).first()
    return [tuple(got[v]) if got[v] else (-np.inf, np.inf) for v in ("text", "meta")]


def form_edges(rows: DataFrame) -> np.ndarray:
    """Edges of the bins of each statistic: its quantiles over all documents."""
    at = F.array(*[F.lit(k / BINS) for k in range(1, BINS)])
    got = rows.agg(*[F.percentile_approx(F.col("form")[k], at).alias(f"q{k}") for k in range(FORM)]).first()
    return np.array([got[k] if got[k] else [0.0] * (BINS - 1) for k in range(FORM)])


def co_train(rows: DataFrame, rounds: int = ROUNDS, share: float = MARK_SHARE, fit_rows: int = FIT_ROWS) -> Model:
    """``rows``: the tokens with ``label`` (-1: none) and ``part`` (fold)."""
    seen = rows.where("label >= 0 AND part > 1").agg(F.count("*").alias("n"), F.sum("label").alias("y")).first()
    model = Model(float(((seen.y or 0) + 1) / (seen.n + 2)), form_edges(rows))
    if not 0 < (seen.y or 0) < seen.n:
        return model
    marks = None
    for k in range(rounds + 1):
        fresh = Model(model.base, model.edges)
        fresh.counts, fresh.rows = recount(rows, model, marks)
        model = calibrated(rows, fresh, fit_rows)
        if model.views is None or k == rounds:
            break
        marks = quantile_marks(rows, model, share * (k + 1))
    return model


def labelled_rows(seen: DataFrame, labels: DataFrame) -> DataFrame:
    y = (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("key"))
         .agg((F.max("quality") > 0).cast("int").alias("label")))
    return seen.join(y, "key", "left").select("doc_id", "words", "form", "meta", F.coalesce("label", F.lit(-1)).alias("label"),
                                              fold(F.col("doc_id"), FOLDS).cast("int").alias("part"))


def score(rows: DataFrame, model: Model) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def sure(z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def step(batch: pa.RecordBatch) -> dict:
        m = shared.value
        if m.views is None:
            both = text = meta = np.full(batch.num_rows, m.base)
        else:
            zs = m.logits(Tokens(batch, m.edges))
            both, (text, meta) = m.combined.probability(np.stack(zs, axis=1)), map(sure, zs)
        return {"doc_id": column(batch, "doc_id"), "score": both, "text_score": text, "meta_score": meta}

    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows.select("doc_id", "words", "form", "meta"), step, f"doc_id {kind}, score double, text_score double, meta_score double", None)


def op7_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = features(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/pages.parquet"))
    rows, path = stage_path(labelled_rows(seen, spark.read.parquet(f"{sf_dir}/labels.parquet")), "quality-views")
    out, _ = stage_path(score(rows, co_train(rows)), "quality-scores")
    delete_path(spark, path)
    return out.select("doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
                      (F.col("score") >= KEEP).cast("int").alias("predicted"), (F.col("score") >= KEEP).alias("kept"),
                      "text_score", "meta_score")
