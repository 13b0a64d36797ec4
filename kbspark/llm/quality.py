"""Quality classifier by co-training of two views.

The text view sees the content: its words (hashed to WORDS classes, as the mean of their log odds of good against bad documents)
and counts (letters, symbols, repeated words and lines and so on, as ratios), all in
quantile bins. The metadata view sees source, language and size as the table states them, sources and languages hashed to
SOURCES and LANGS classes: names that share a class share a weight. Both are linear
classifiers, fitted by least squares from sums over all documents (a matrix of at most a few hundred
columns squared, and two numbers for each class of words), so the unlabelled documents are never sampled: in each round every document of which one
view is confident teaches the other with that pseudo-label.

Half of the labelled rows (by hash of the id) are fitted; the other half, which no view was fitted on, calibrates each view, and at the end a logistic model of both calibrated views that gives the probability of good
quality, for every document. Labelled rows count there by the labels' shares of all labelled rows. If one
half lacks a label, both steps take all labelled rows.

Labels: at most LABELLED rows of each kind, by hash of the id (then the smaller id); null and contradicted labels aren't
used. Without labels of both kinds, every document gets the share of good ones (1 if none).

Defined cases: null text counts as empty; null metadata are values of their own; null ids have no label and stay null; repeated ids are
rows of their own (each is joined with its id's label); long texts are read whole; extra columns are passed on by ``good_documents``, whatever their names,
and ignored otherwise; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import forget, fresh, sliced, stored
from .stats import text_counts
from .toxicity import shared
from .words import as_bytes

LABELLED = 5000
#: Classes of words.
WORDS = 1 << 14
ROUNDS, CONFIDENT, PSEUDO_WEIGHT = 2, 0.95, 0.2
THRESHOLD = 0.5
BINS = 8
SOURCES, LANGS, SIZES = 256, 64, 24
#: name: (count, by count); fixed values.
RATIOS = {
    "symbols": ("n_symbols", "n_words"),
    "word_length": ("word_chars", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "distinct": ("n_distinct", "n_words"),
    "capitals": ("n_upper", "n_letters"),
    "letters": ("n_letters", "word_chars"),
    "digits": ("n_digits", "word_chars"),
    "shouts": ("n_shouts", "n_words"),
    "line_ends": ("n_ended", "n_lines"),
    "line_words": ("n_words", "n_lines"),
}
NAMES = list(RATIOS)
METADATA = ("m0", "m1", "m2")
TEXT, META = 0, 1
#: Edges of the words' bins: mean log odds.
ODDS = np.array([-0.6, -0.3, -0.1, 0.0, 0.1, 0.3, 0.6])


@dataclass
class Model:
    edges: np.ndarray
    odds: np.ndarray = field(default_factory=lambda: np.zeros(WORDS))
    weights: list[np.ndarray | None] = field(default_factory=lambda: [None, None])
    platt: list[tuple[float, float]] = field(default_factory=lambda: [(1.0, 0.0), (1.0, 0.0)])
    stack: tuple[float, float, float] = (1.0, 1.0, 0.0)
    share: float = 1.0


def _metadata(docs: DataFrame) -> list:
    return [
        F.pmod(F.xxhash64(F.coalesce(F.col("source").cast("string"), F.lit("\0"))), F.lit(SOURCES)).cast("int"),
        F.pmod(F.xxhash64(F.coalesce(F.col("lang").cast("string"), F.lit("\0"))), F.lit(LANGS)).cast("int"),
        F.least(F.lit(SIZES - 1), F.coalesce(F.floor(F.log2(F.greatest(F.col("n_chars").cast("double"), F.lit(0.0)) + 1)).cast("int") + 1, F.lit(0))).cast("int"),
    ]


def ratios(texts: list[bytes]) -> np.ndarray:
    c = text_counts(texts)
    return np.stack([c[a] / np.maximum(c[b], 1) for a, b in RATIOS.values()], 1) if texts else np.zeros((0, len(RATIOS)))


def word_classes(texts: list[bytes]) -> list[bytes]:
    """The classes of each text's words, each once, as 16-bit numbers."""
    out = []
    for lo, hi in words.batches(texts):
        w = words.Words(texts[lo:hi], lower=True)
        h = (w.hashes() % np.uint64(WORDS)).astype(np.uint16)
        out += [np.unique(h[w.first[d] : w.first[d + 1]]).tobytes() for d in range(hi - lo)]
    return out


def features(docs: DataFrame) -> DataFrame:
    """doc_id, the ratios, the words' classes and m0, m1, m2 (the metadata as classes), of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts = as_bytes(b.column("text"))
            r = ratios(texts)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(r[:, k]) for k in range(len(NAMES))], pa.array(word_classes(texts), pa.binary()), *[b.column(m) for m in METADATA]], ["doc_id", *NAMES, "said", *METADATA])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *[c.alias(m) for c, m in zip(_metadata(docs), METADATA, strict=True)])
    return own.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} double" for n in NAMES) + ", said binary, m0 int, m1 int, m2 int")


@dataclass
class Rows:
    """The features of some documents."""

    ratios: np.ndarray
    words: np.ndarray
    sizes: np.ndarray
    metadata: np.ndarray

    @classmethod
    def of(cls, ratios: np.ndarray, said: list[bytes], metadata: np.ndarray) -> Rows:
        return cls(ratios, np.frombuffer(b"".join(said), np.uint16), np.array([len(x) // 2 for x in said], int), metadata)

    @classmethod
    def of_frame(cls, f: pd.DataFrame) -> Rows:
        return cls.of(f[NAMES].to_numpy(float), f["said"].to_list(), f[list(METADATA)].to_numpy(int))

    @classmethod
    def of_batch(cls, b: pa.RecordBatch) -> Rows:
        numbers = lambda names: np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in names], 1)
        return cls.of(numbers(NAMES), b.column("said").to_pylist(), numbers(METADATA))

    def __len__(self) -> int:
        return len(self.ratios)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.sizes)

    def mean_odds(self, odds: np.ndarray) -> np.ndarray:
        return np.bincount(self.doc, odds[self.words], minlength=len(self)) / np.maximum(self.sizes, 1)


def design(view: int, rows: Rows, model: Model) -> np.ndarray:
    """One column per class of each feature, and a constant."""
    n = len(rows)
    if view == TEXT:
        x = np.zeros((n, (len(NAMES) + 1) * BINS + 1))
        for k in range(len(NAMES)):
            x[np.arange(n), k * BINS + np.searchsorted(model.edges[k], rows.ratios[:, k], "right")] = 1
        x[np.arange(n), len(NAMES) * BINS + np.searchsorted(ODDS, rows.mean_odds(model.odds), "right")] = 1
    else:
        x = np.zeros((n, SOURCES + LANGS + SIZES + 1))
        for k, at in enumerate((0, SOURCES, SOURCES + LANGS)):
            x[np.arange(n), at + rows.metadata[:, k]] = 1
    x[:, -1] = 1
    return x


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p):
    return np.log(np.clip(p, 1e-9, 1 - 1e-9) / np.clip(1 - p, 1e-9, 1))


def view_probability(model: Model, view: int, rows: Rows) -> np.ndarray:
    a, b = model.platt[view]
    return _sigmoid(a * (design(view, rows, model) @ model.weights[view]) + b)


def probability(model: Model, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of good quality: by text, by metadata, combined."""
    if model.weights[TEXT] is None:
        p = np.full(len(rows), model.share)
        return p, p, p
    t, s = (view_probability(model, v, rows) for v in (TEXT, META))
    a, b, c = model.stack
    return t, s, _sigmoid(a * _logit(t) + b * _logit(s) + c)


def _targets(model: Model, rows: Rows, y: np.ndarray, views: tuple[int, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(view, target, weight) of every document: its label (y; nan if unknown), else what the other view is sure of."""
    known = ~np.isnan(y)
    for view in views:
        target, weight = np.where(known, 2 * np.nan_to_num(y) - 1, 0.0), known.astype(float)
        if model.weights[1 - view] is not None and not known.all():
            p = view_probability(model, 1 - view, rows)
            pseudo = ~known & ((p >= CONFIDENT) | (p <= 1 - CONFIDENT))
            target[pseudo], weight[pseudo] = np.where(p[pseudo] >= 0.5, 1.0, -1.0), PSEUDO_WEIGHT
        yield view, target, weight


def word_sums(model: Model, rows: Rows, y: np.ndarray) -> np.ndarray:
    """By label (0, 1): the weight of documents with each class of words, and (last) of all documents."""
    out = np.zeros((2, WORDS + 1))
    for _, target, weight in _targets(model, rows, y, (TEXT,)):
        for k, sign in enumerate((-1.0, 1.0)):
            own = weight * (target == sign)
            out[k, :WORDS] = np.bincount(rows.words, own[rows.doc], minlength=WORDS)
            out[k, WORDS] = own.sum()
    return out


def log_odds(sums: np.ndarray) -> np.ndarray:
    bad, good = np.log((sums[:, :WORDS] + 1) / (sums[:, WORDS:] + 2))
    return good - bad


def view_sums(teacher: Model, pupil: Model, rows: Rows, y: np.ndarray) -> list[np.ndarray]:
    """Both views' sums of products of the pupil's columns and the target, pseudo-labels being the teacher's."""
    out = []
    for view, target, weight in _targets(teacher, rows, y, (TEXT, META)):
        x = np.column_stack([design(view, rows, pupil), target])
        out.append((x * weight[:, None]).T @ x)
    return out


def _solve(s: np.ndarray) -> np.ndarray:
    return np.linalg.solve(s[:-1, :-1] + np.eye(len(s) - 1), s[:-1, -1])


def _over(marked: DataFrame, sums) -> list[np.ndarray]:
    """The arrays that ``sums(rows, labels)`` gives, added up over all documents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: list[np.ndarray] = []
        for f in frames:
            for a in range(0, len(f), 500):
                part = f.iloc[a : a + 500]
                new = sums(Rows.of_frame(part), part["label"].to_numpy(float))
                total = [t + n for t, n in zip(total, new, strict=True)] if total else new
        for k, t in enumerate(total):
            i, j = np.nonzero(t)
            yield pd.DataFrame({"k": k, "i": i, "j": j, "v": t[i, j]})

    found = marked.mapInPandas(run, "k int, i int, j int, v double").groupBy("k", "i", "j").agg(F.sum("v").alias("v")).toPandas()
    empty = sums(Rows.of(np.zeros((0, len(NAMES))), [], np.zeros((0, 3), int)), np.zeros(0))
    for k, e in enumerate(empty):
        own = found[found["k"] == k]
        e[own["i"], own["j"]] = own["v"]
    return empty


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray | float = 1.0) -> np.ndarray:
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        h = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 0.1 * np.eye(len(w))
        w += np.linalg.solve(h, x.T @ (weight * (y - p)) - 0.1 * w)
    return w


def own_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of every id with one label."""
    return labels.where(F.col("quality").isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("label"), F.max("quality").alias("other")).where("label = other").drop("other")


def chosen_labels(labels: DataFrame, most: int) -> DataFrame:
    """(doc_id, label) of at most ``most`` rows of each kind, by hash of the id."""
    own = own_labels(labels)
    parts = [own.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for k in (0, 1)]
    return parts[0].unionByName(parts[1])


def fit(rows: DataFrame, labels: DataFrame, most: int = LABELLED, rounds: int = ROUNDS) -> Model:
    """rows: features(docs), stored; labels: (doc_id, quality), without what is to be withheld."""
    spark = rows.sparkSession
    edges = rows.approxQuantile(NAMES, [k / BINS for k in range(1, BINS)], 0.002)
    model = Model(np.array([e or [0.0] * (BINS - 1) for e in edges]))
    # at most 2 * most rows
    chosen = chosen_labels(labels, most).withColumn("fitted", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(2)) == 0)
    taught = rows.join(F.broadcast(chosen), "doc_id").toPandas()
    y, fitted = taught["label"].to_numpy(float), taught["fitted"].to_numpy(bool)
    if len(y):
        held = rows.select("doc_id").join(own_labels(labels), "doc_id").groupBy("label").count().collect()
        count = {r["label"]: r["count"] for r in held}
        totals = (count.get(0, 0), count.get(1, 0))
        model.share = totals[1] / sum(totals)
    if len(set(y.tolist())) < 2:
        return model
    if min(len(set(y[fitted].tolist())), len(set(y[~fitted].tolist()))) < 2:
        fitted[:] = True
        rest = fitted
        chosen = chosen.withColumn("fitted", F.lit(True))
    else:
        rest = ~fitted
    own, held_back, y_rest = Rows.of_frame(taught[fitted]), Rows.of_frame(taught[rest]), y[rest]
    weight = shared(y_rest, totals)

    def calibrate(new: Model) -> None:
        for v in (TEXT, META):
            new.platt[v] = tuple(_logistic((design(v, held_back, new) @ new.weights[v])[:, None], y_rest, weight).tolist())

    model.odds = log_odds(word_sums(model, own, y[fitted]))
    model.weights = [_solve(s) for s in view_sums(model, model, own, y[fitted])]
    calibrate(model)
    # what calibrates teaches nothing: no label, and no pseudo-label
    marked = rows.join(F.broadcast(chosen), "doc_id", "left").where("coalesce(fitted, true)")
    for _ in range(rounds):
        said = spark.sparkContext.broadcast(model)
        new = Model(model.edges, log_odds(_over(marked, lambda r, k, said=said: [word_sums(said.value, r, k)])[0]), list(model.weights), list(model.platt), share=model.share)
        both = spark.sparkContext.broadcast((model, new))
        new.weights = [_solve(s) for s in _over(marked, lambda r, k, both=both: view_sums(*both.value, r, k))]
        calibrate(new)
        model = new
    t, s, _ = probability(model, held_back)
    model.stack = tuple(_logistic(np.column_stack([_logit(t), _logit(s)]), y_rest, weight).tolist())
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, most: int = LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """docs: documents, labels: (doc_id, quality). One row per row: doc_id, text_score, metadata_score, score, kept."""
    rows = stored(features(docs), "features")
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            views = probability(model.value, Rows.of_batch(b))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(v, pa.float64()) for v in views]], ["doc_id", "text_score", "metadata_score", "score"])

    return rows.mapInArrow(run, "doc_id long, text_score double, metadata_score double, score double").withColumn("kept", F.col("score") >= threshold)


def good_documents(docs: DataFrame, labels: DataFrame, most: int = LABELLED, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, that the classifier keeps; texts are read twice and never shuffled."""
    rows = stored(features(docs), "features")
    model = docs.sparkSession.sparkContext.broadcast(fit(rows, labels, most))
    forget(docs.sparkSession, rows)
    names, own = docs.columns, fresh(docs, *METADATA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts = as_bytes(b.column("text"))
            m = np.stack([b.column(k).to_numpy(zero_copy_only=False) for k in own], 1)
            _, _, p = probability(model.value, Rows.of(ratios(texts), word_classes(texts), m))
            yield b.select(names).filter(pa.array(p >= threshold))

    return docs.select("*", *[c.alias(k) for c, k in zip(_metadata(docs), own, strict=True)]).mapInArrow(run, docs.schema)
