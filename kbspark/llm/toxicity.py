"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on the windows of toxic and one on those of ordinary texts; both end in the
same common base of ordinary text. Every text is cut into windows of WINDOW words, and every window is compressed with both; its
distance is its length compressed with the ordinary dictionary minus that with the toxic one. A text's
windows give a few numbers (the greatest distances, their sum and mean, how many pass thresholds), and a logistic
calibration, fitted on labelled rows the dictionaries haven't seen, turns them into a score. The thresholds are
the distances that given shares (SHARES) of the ordinary windows of those rows pass.

One more input is how many windows hold a word beginning (KEY characters) that is significantly commoner in toxic than in ordinary
training texts. Scoring reads a text and nothing else; the model (at most 2 * OWN_BYTES + 2 * BASE_BYTES) is sent to every task.

Fitted on at most LABELLED rows of each label, the ones with the smallest hash of the id, of LABELLED_CHARS characters together at most (whole texts); half for the
dictionaries, half for the calibration, whose rows are weighted by the labels' shares of all labelled rows.

Defined cases: null and empty texts have no windows and get the score of all-zero numbers; a label that is null,
or contradicted by another row of its id, isn't used; without labels of both kinds every score is the
share of toxic ones (0 if none); null ids have no label and stay null; repeated ids are rows of their own, with equal scores for equal texts; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LABELLED, LABELLED_CHARS = 3000, 1 << 25
WINDOW, KEY, LEVEL = 24, 4, 19
BASE_BYTES, OWN_BYTES = 8192, 16384
SHARES = (0.1, 0.03, 0.01, 0.003)
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_MARKS = ".,;:!?\"'()|#*$%&<>"


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    thresholds: list[float]
    mean: list[float]
    scale: list[float]
    weights: list[float]
    keys: frozenset[str] = frozenset()


def _words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def compressors(model: Model):
    import zstandard as Z

    out = []
    for own in (model.ordinary, model.toxic):
        d = Z.ZstdCompressionDict(own, dict_type=Z.DICT_TYPE_RAWCONTENT)
        p = Z.ZstdCompressionParameters.from_level(LEVEL, source_size=128, dict_size=len(own), format=Z.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False)
        d.precompute_compress(compression_params=p)
        out.append(Z.ZstdCompressor(dict_data=d, compression_params=p).compress)
    return out


def keys(words: list[str]) -> list[str]:
    return [w.strip(_MARKS)[:KEY] for w in words]


def windows(w: list[str], window: int = WINDOW) -> list[bytes]:
    return [" ".join(w[i : i + window]).encode() for i in range(0, len(w), window)]


def distances(text: str, model: Model, ordinary, toxic, window: int = WINDOW) -> tuple[np.ndarray, int]:
    """The distances of all windows, and the number of windows with a key."""
    # bytes are split at the same characters as _WORD splits texts
    w = text.lower().encode().split()
    # a word that comes again is looked at once, and texts without keys end there
    apart = list(set(w))
    own = {x for x, k in zip(apart, keys([x.decode() for x in apart]), strict=True) if k in model.keys}
    hits = {i // window for i, x in enumerate(w) if x in own} if own else ()
    cut = [b" ".join(w[i : i + window]) for i in range(0, len(w), window)]
    return np.array([len(ordinary(s)) - len(toxic(s)) for s in cut], float), len(hits)


def numbers(found: tuple[np.ndarray, int], thresholds: list[float]) -> list[float]:
    d, hits = found
    top, n_windows = np.sort(d)[::-1], max(len(d), 1)
    out = [max(top[0], 0.0) if len(d) else 0.0, max(top[1], 0.0) if len(d) > 1 else 0.0, math.log1p(np.maximum(d, 0).sum()), math.log1p(len(d)), float(d.sum()) / n_windows]
    out += [float(hits > 0), math.log1p(hits), min(1.0, 20 * hits / n_windows)]
    for t in thresholds:
        n = int((d >= t).sum())
        out += [float(n > 0), math.log1p(n), min(1.0, 20 * n / n_windows)]
    return out


def _trained(samples: list[bytes], size: int) -> bytes:
    """The content of a zstandard dictionary trained on the samples (the samples' end, if they are too few to train on)."""
    import zstandard as Z

    try:
        d = Z.train_dictionary(size, samples).as_bytes()
        return d[-size:]
    except Z.ZstdError:
        return b" ".join(samples)[-size:]


def shared(y: np.ndarray, totals: tuple[int, int] | None) -> np.ndarray:
    """Weights of the rows labelled y, of mean 1, that give both labels their shares of ``totals`` (by label; None: as they come)."""
    if totals is None or not min(totals) or len(set(y.tolist())) < 2:
        return np.ones(len(y))
    w = np.where(y == 1, totals[1] / (y == 1).sum(), totals[0] / (y == 0).sum())
    return w / w.mean()


def _logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, weight: np.ndarray | float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    reg = np.full(x.shape[1], l2)
    reg[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(reg)
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - reg * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(texts: list[str], toxic: list[int], totals: tuple[int, int] | None = None) -> Model:
    """totals: how many labelled rows there are of each label, of which the texts are a sample (None: the sample's own)."""
    y = np.array(toxic)
    share = (totals[1] / sum(totals) if totals and sum(totals) else float(y.mean())) if len(y) else 0.0
    half = np.arange(len(y)) % 2 == 0
    parts = [[texts[i] for i in np.flatnonzero(half & (y == k))] for k in (0, 1)]
    rest = np.flatnonzero(~half)
    if not parts[0] or not parts[1] or len(set(y[rest].tolist())) < 2:
        n = len(numbers((np.zeros(0), 0), [1, 2, 3, 4]))
        return Model(b"x" * 64, b"x" * 64, [1, 2, 3, 4], [0] * n, [1] * n, [0.0] * n + [math.log(max(share, 1e-9) / max(1 - share, 1e-9))])
    docs_with = [Counter(), Counter()]
    for k in (0, 1):
        for t in parts[k]:
            docs_with[k].update(set(keys(_words(t))))
    n0, n1 = len(parts[0]), len(parts[1])
    special = {}
    for w, c in docs_with[1].items():
        p, q = c / n1, docs_with[0][w] / n0
        both = (c + docs_with[0][w]) / (n0 + n1)
        z = (p - q) / math.sqrt(both * (1 - both) * (1 / n0 + 1 / n1) + 1e-12)
        if len(w) >= 3 and z >= 3.5 and (p + 0.2 / n1) >= 3 * (q + 0.2 / n0):
            special[w] = z
    chosen = frozenset(special)
    samples = [[x for t in part for x in windows(_words(t))] for part in parts]
    base = samples[0][::8]
    common = _trained(base, BASE_BYTES)
    model = Model(_trained(samples[1], OWN_BYTES) + b" " + common, _trained(samples[0], OWN_BYTES) + b" " + common, [], [], [], [], chosen)
    ordinary, tox = compressors(model)
    d = [distances(texts[i], model, ordinary, tox) for i in rest]
    yr = y[rest]
    clean = np.sort(np.concatenate([v[0] for v, k in zip(d, yr, strict=True) if not k]))[::-1]
    model.thresholds = [max(1.0, float(clean[int(q * len(clean))]) + 1) for q in SHARES]
    x = np.array([numbers(v, model.thresholds) for v in d])
    model.mean, model.scale = x.mean(0).tolist(), (x.std(0) + 1e-9).tolist()
    x = np.column_stack([(x - model.mean) / model.scale, np.ones(len(x))])
    model.weights = _logistic(x, yr, weight=shared(yr, totals)).tolist()
    return model


def probability(model: Model, d: tuple[np.ndarray, int]) -> float:
    x = (np.array(numbers(d, model.thresholds)) - model.mean) / model.scale
    return float(1 / (1 + math.exp(-max(-30.0, min(30.0, float(x @ model.weights[:-1]) + model.weights[-1])))))


def labelled(docs: DataFrame, labels: DataFrame, column: str, most: int, most_chars: int = LABELLED_CHARS) -> tuple[list[tuple[str, int]], tuple[int, int]]:
    """(text, label) of at most ``most`` of docs' labelled rows for each label, by hash of the id, as far as ``most_chars`` characters go, and how many there are in all.

    docs and labels: doc_id.
    """
    own = labels.where(F.col(column).isin(0, 1)).groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("other")).where("label = other")
    rows = docs.where("text is not null").select("doc_id", F.length("text").alias("n")).join(own.select("doc_id", "label"), "doc_id")
    order = F.xxhash64("doc_id")
    picked = None
    for k in (0, 1):
        # at most `most` rows
        part = rows.where(F.col("label") == k).orderBy(order, "doc_id", "n").limit(most)
        so_far = Window.partitionBy("label").orderBy(order, "doc_id", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        part = part.withColumn("chars", F.sum("n").over(so_far)).where(F.col("chars") <= most_chars).select("doc_id", "label").distinct()
        picked = part if picked is None else picked.unionByName(part)
    found = docs.select("doc_id", "text").where("text is not null").join(F.broadcast(picked), "doc_id").select("doc_id", "text", "label").collect()
    found.sort(key=lambda r: (r.doc_id * 0x9E3779B1 % (1 << 32), r.text))
    count = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    return [(r.text, r.label) for r in found], (count.get(0, 0), count.get(1, 0))


def trained(docs: DataFrame, labels: DataFrame, most: int = LABELLED):
    """A broadcast model, learnt from docs (doc_id, text) and labels (doc_id, toxic): what is to be withheld, the caller withholds."""
    rows, totals = labelled(docs, labels, "toxic", most)
    return docs.sparkSession.sparkContext.broadcast(fit([t for t, _ in rows], [k for _, k in rows], totals))


def scored(docs: DataFrame, model) -> DataFrame:
    """docs: (doc_id, text). One row per row: doc_id, score, predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        ordinary, tox = compressors(m)
        for b in batches:
            s = [probability(m, distances(t or "", m, ordinary, tox)) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(s, pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double").withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
