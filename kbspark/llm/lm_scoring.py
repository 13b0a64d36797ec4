"""Hierarchical Pitman-Yor language model, trained on the corpus and scored on all of it.

Three levels of restaurants. A token's context is the word before it, if that occurs LEAST times or more in the training texts:
each such word is a restaurant, so their number grows with the corpus, without bound. A rarer word, and the start of a text,
backs off to the restaurant of its class (CLASSES classes by a word's last two bytes, and one for the start of a text), which is also the
parent of its words' restaurants; the classes share one parent, the unigram restaurant, whose base is
uniform over the vocabulary and one unknown word. Customers of a context are its tokens; each table sends one customer to the parent.

Seating is sampled by Gibbs sweeps: in a sweep the customers of every dish (word) in a restaurant leave and sit down
anew, one after the other, given the parent's probability of the word and the tables of all other dishes; then those of the classes, then the
unigram restaurant's. From the 64th customer on they come in blocks of a sixteenth of those seated, whose new tables are one binomial draw
each, at every size alike. After the burn-in, predictive probabilities are averaged over the samples.

Counting, seating and scoring move no row per token. Tasks count chunks of CHUNK tokens; a chunk's distinct pairs of word and context go, as arrays, to the
bucket of the word (by the first bits of its hash). A bucket holds all there is of its words on every level, so a sweep is one pass over the buckets
without a shuffle; only the restaurants' totals meet, two numbers a context. What there is of each context (word, class, totals) is broadcast in slices by the
word's hash, of about MOST_CONTEXTS each: the driver and every task hold one slice at a time, and their number changes no result. Random numbers follow from the sweep and the bucket, so lost tasks repeat them exactly.
To score, a chunk sends its tokens' contexts and documents to the words' buckets, which send back sums by document. The FREQUENT commonest pairs, which every task
holds, are not sent.

Words are 64-bit hashes of their bytes. Counts are over all training documents. Defined cases: null
and empty texts are the end token alone; a word never seen has the unknown's probability; without
training documents every token has the uniform one; repeated ids are rows of their own, with equal scores for equal texts; null ids stay null; extra columns are ignored; texts of any length are
one row each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import drop_shuffles, forget, partitions, sliced, stored

CLASSES, START = 24, 24
#: Occurrences that give a word a restaurant of its own, and such restaurants in a slice, about: what a task holds of them together (8 bytes a number).
LEAST, MOST_CONTEXTS = 50, 1 << 20
SWEEPS, BURN_IN = 3, 1
STRENGTH = 1.0
SAMPLES = SWEEPS - BURN_IN
#: Pairs whose probabilities every task holds: 24 bytes each.
FREQUENT = 1 << 16
#: Tokens that a task takes together, tokens for each bucket of words, and tokens that are scored together.
CHUNK, BUCKET, ASKED = 1 << 20, 1 << 22, 1 << 19
END = np.uint64(0x656E64)
_U, _L, _I = np.uint64, np.int64, np.int32


def tokens(texts: list[bytes]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(from text, to text, words, their classes, first token of each text) by batches; every text ends with END, whose class is START."""
    for lo, hi in words.batches(texts):
        w = words.Words(texts[lo:hi], lower=True)
        h = w.hashes()
        last = w.bytes[w.end - 1].astype(_L) if len(h) else np.zeros(0, _L)
        before = np.where(w.end - w.start > 1, w.bytes[np.maximum(w.end - 2, 0)], 0).astype(_L) if len(h) else last
        cls = ((last * 31 + before * 7) % 1021 * CLASSES // 1021).astype(np.int8)
        yield lo, hi, np.insert(h, w.first[1:], END), np.insert(cls, w.first[1:], START), w.first + np.arange(hi - lo + 1)


class Sliced:
    """A number for each context, in order of the contexts' words, broadcast in slices; edges: where the slices begin, and the end."""

    def __init__(self, edges: np.ndarray, parts: list):
        self.edges, self.parts = edges, parts

    def __len__(self) -> int:
        return int(self.edges[-1])

    def slices(self, which=None) -> Iterator[tuple[int, np.ndarray]]:
        """(where it begins, its numbers) of each slice (of these); the one before is given back."""
        for j in range(len(self.parts)) if which is None else which:
            b = self.parts[j]
            yield int(self.edges[j]), b.value
            if len(self.parts) > 1 and getattr(b, "_path", None):
                b.__dict__.pop("_value", None)  # read again from its file when asked for

    def whole(self) -> np.ndarray:
        return np.concatenate([x.copy() for _, x in self.slices()])

    def __getitem__(self, code):
        """The numbers of these contexts."""
        if len(self.parts) == 1:
            return self.parts[0].value[code]
        code = np.asarray(code)
        at = np.searchsorted(self.edges, code, "right") - 1
        out = np.zeros(code.shape)
        which = np.unique(at)
        for j, (begin, x) in zip(which, self.slices(which), strict=True):
            on = at == j
            out[on] = x[code[on] - begin]
        return out


@dataclass
class Contexts:
    """The words with restaurants of their own, in order, and their classes."""

    words: Sliced
    classes: Sliced

    def __len__(self) -> int:
        return len(self.words)

    @property
    def value(self) -> tuple[np.ndarray, np.ndarray]:
        return self.words.whole(), self.classes.whole()

    def places(self, words_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether each of the words, which are in order, is a context, its place or 0)."""
        hit, at = np.zeros(len(words_), bool), np.zeros(len(words_), _L)
        for begin, own in self.words.slices():
            if len(own):
                s = slice(*np.searchsorted(words_, own[[0, -1]]) + [0, 1])
                there, place = _places(own, words_[s])
                hit[s] |= there
                at[s] = np.where(there, place + begin, at[s])
        return hit, at


@dataclass
class Chunk:
    """Some texts' tokens: distinct words in order, each token's word, each word's class, the texts' sizes and ids."""

    words: np.ndarray
    token: np.ndarray
    classes: np.ndarray
    sizes: np.ndarray
    ids: pa.Array

    def codes(self, contexts: Contexts) -> np.ndarray:
        """Each token's context: the place of the word before among the contexts, or behind them its class."""
        k = len(contexts)
        hit, at = contexts.places(self.words)
        own = np.where(hit, at, k + self.classes)
        out = np.empty(len(self.token), _L)
        out[1:] = own[self.token[:-1]]
        out[np.concatenate([[0], np.cumsum(self.sizes)[:-1]]).astype(_L)] = k + START
        return out


def _places(sorted_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.searchsorted(sorted_, x)
    at[at == len(sorted_)] = 0
    return (sorted_[at] == x if len(sorted_) else np.zeros(len(x), bool)), at


def chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[Chunk]:
    held: list[tuple] = []
    n = 0

    def out() -> Chunk:
        tok, cls, sizes = (np.concatenate([h[k] for h in held]) for k in range(3))
        u, first, at = np.unique(tok, return_index=True, return_inverse=True)
        return Chunk(u, at.astype(_L), cls[first].astype(_L), sizes, pa.concat_arrays([h[3] for h in held]))

    for b in sliced(batches):
        ids = b.column("doc_id") if "doc_id" in b.schema.names else pa.nulls(b.num_rows, pa.int64())
        for lo, hi, tok, cls, first in tokens(words.as_bytes(b.column("text"))):
            held.append((tok, cls, np.diff(first), ids.slice(lo, hi - lo)))
            n += len(tok)
            if n >= size:
                yield out()
                held, n = [], 0
    if held:
        yield out()


# Rows of arrays


def _row(names: list[str], values: list) -> pa.RecordBatch:
    """One row; arrays are compressed, so that a task holds one bucket's in full at a time."""
    import zstandard

    packed = zstandard.ZstdCompressor(level=1).compress
    return pa.RecordBatch.from_arrays([pa.array([packed(v.tobytes()) if isinstance(v, np.ndarray) else v], pa.binary() if isinstance(v, np.ndarray) else pa.int64()) for v in values], names)


def _array(x: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(x), kind)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for k in range(b.num_rows):
            yield {n: b.column(n)[k].as_py() for n in b.schema.names}


def _edges(u: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket's words begin and end, in words in order."""
    inner = np.arange(1, 1 << bits, dtype=_U) << _U(64 - bits) if bits else np.zeros(0, _U)
    return np.concatenate([[0], np.searchsorted(u, inner), [len(u)]])


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """From rows ordered by bucket: each bucket and its rows."""
    last, held = None, []
    for r in _rows(batches):
        if last is not None and r["bucket"] != last:
            yield last, held
            held = []
        last = r["bucket"]
        held.append(r)
    if held:
        yield last, held


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), "bucket").sortWithinPartitions("bucket", *order)


# Contexts


def _word_blocks(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, CHUNK):
            n = np.bincount(c.token, minlength=len(c.words)).astype(_I)
            e = _edges(c.words, bits)
            for k in np.flatnonzero(np.diff(e)):
                s = slice(e[k], e[k + 1])
                yield _row(["bucket", "w", "n", "c"], [int(k), c.words[s], n[s], c.classes[s].astype(np.int8)])

    return run


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sums of n, and the place of one row of each."""
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, _L)
    return key[first], np.add.reduceat(n, first) if len(first) else n, order[first]


def _common_words(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, held in _by_bucket(batches):
            w, n, c = (np.concatenate([_array(r[x], t) for r in held]) for x, t in (("w", _U), ("n", _I), ("c", np.int8)))
            w, n, at = _summed(w, n.astype(_L))
            keep = (n >= least) & (w != END)
            yield pa.RecordBatch.from_arrays([pa.array(w[keep].view(_L)), pa.array(n[keep]), pa.array(c[at][keep].astype(_I))], ["w", "n", "c"])

    return run


def contexts(docs: DataFrame, bits: int, least: int, most: int) -> Contexts:
    """All words that occur least times or more, in slices of about most."""
    spark = docs.sparkSession
    blocks = docs.select("text").mapInArrow(_word_blocks(bits), "bucket long, w binary, n binary, c binary")
    common = stored(_dealt(blocks).mapInArrow(_common_words(least), "w long, n long, c int"), "contexts")
    cut = max(0, int(np.ceil(np.log2(max(common.count() / most, 1)))))
    edges, parts = [0], ([], [])
    for j in range(1 << cut):
        # words are scattered hashes, so their first bits make even slices
        own = common.where(F.shiftrightunsigned("w", 64 - cut) == j) if cut else common
        found = own.select("w", "c").toArrow()
        w = found.column("w").to_numpy().astype(_L).view(_U)
        order = np.argsort(w)
        for part, x in zip(parts, (w, found.column("c").to_numpy().astype(_L)), strict=True):
            part.append(spark.sparkContext.broadcast(x[order]))
        edges.append(edges[-1] + len(w))
    forget(spark, common)
    drop_shuffles(spark)
    return Contexts(*[Sliced(np.array(edges), part) for part in parts])


# Counts


def _pair_blocks(listed, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = len(listed) + CLASSES + 1
        for c in chunks(batches, CHUNK):
            key, n = np.unique(c.token * span + c.codes(listed), return_counts=True)
            word, e = key // span, _edges(c.words, bits)
            at = np.searchsorted(word, e)
            for k in np.flatnonzero(np.diff(e)):
                s = slice(at[k], at[k + 1])
                sizes = np.bincount(word[s] - e[k], minlength=e[k + 1] - e[k])
                yield _row(["bucket", "w", "size", "code", "n"], [int(k), c.words[e[k] : e[k + 1]], sizes.astype(_I), (key[s] - word[s] * span).astype(_I), n.astype(_I)[s]])

    return run


#: A bucket's arrays: words; of each word the number of pairs; of each pair its context, customers and tables; of each word the number of
#: classes; of each word and class the class, customers and tables; of each word its tables in the unigram restaurant; and of each sample
#: the pairs' tables, the classes' probabilities and the unigram restaurant's.
_KINDS = {"w": _U, "size": _I, "code": _I, "n": _L, "t": _I, "csize": _I, "cls": np.int8, "cnt": _L, "tab": _L, "rt": _L}
for _s in range(SAMPLES):
    _KINDS |= {f"t{_s}": _I, f"q{_s}": np.float64, f"r{_s}": np.float64}
_STATE = "bucket long, " + ", ".join(f"{k} binary" for k in _KINDS)


def _state(r: dict) -> dict:
    return {k: _array(r[k], t) for k, t in _KINDS.items() if r.get(k) is not None}


def _counted(listed):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = len(listed) + CLASSES + 1
        for bucket, held in _by_bucket(batches):
            parts = [[_array(r[x], t) for x, t in (("w", _U), ("size", _I), ("code", _I), ("n", _I))] for r in held]
            w = np.unique(np.concatenate([p[0] for p in parts]))
            key = np.concatenate([np.repeat(np.searchsorted(w, p[0]), p[1]) * span + p[2] for p in parts])
            key, n, _ = _summed(key, np.concatenate([p[3] for p in parts]).astype(_L))
            word = key // span
            s = {"w": w, "size": np.bincount(word, minlength=len(w)), "code": key - word * span, "n": n, "t": np.ones(len(key))}
            cls = _class_of(s["code"], listed)
            both = np.unique(word * (CLASSES + 1) + cls)
            s |= {"csize": np.bincount(both // (CLASSES + 1), minlength=len(w)), "cls": both % (CLASSES + 1), "tab": np.ones(len(both)), "rt": np.ones(len(w))}
            s["cnt"] = _class_customers(s, len(listed), word, cls, both)
            for k in range(SAMPLES):
                s |= {f"t{k}": np.zeros(0), f"q{k}": np.zeros(0), f"r{k}": np.zeros(0)}
            yield _row(["bucket", *_KINDS], [bucket, *[np.ascontiguousarray(s[k]).astype(t) for k, t in _KINDS.items()]])

    return run


def _class_of(code: np.ndarray, listed: Contexts) -> np.ndarray:
    k = len(listed)
    out = code.astype(_L) - k
    own = np.flatnonzero(out < 0)
    out[own] = listed.classes[code[own]]
    return out


def _class_customers(s: dict, k: int, word: np.ndarray, cls: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Customers of each word and class: its own tokens, and the tables of its words' restaurants."""
    return np.bincount(np.searchsorted(both, word * (CLASSES + 1) + cls), np.where(s["code"] < k, s["t"], s["n"]), minlength=len(both))


@dataclass
class Totals:
    """Customers and tables of every restaurant: contexts, classes, the unigram one; the vocabulary, the discounts."""

    n: Sliced
    t: Sliced
    class_n: np.ndarray
    class_t: np.ndarray
    root_t: float
    vocabulary: int
    discounts: tuple[float, float, float]

    def root(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        d = self.discounts[2]
        fresh = (STRENGTH + d * self.root_t) / (self.vocabulary + 1)
        return (np.maximum(customers - d * tables, 0) + fresh) / (STRENGTH + self.class_t.sum())

    def class_back(self) -> np.ndarray:
        return (STRENGTH + self.discounts[1] * self.class_t) / (STRENGTH + self.class_n)

    def back(self, n: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Of contexts with these customers and tables."""
        return (STRENGTH + self.discounts[0] * t) / (STRENGTH + n)

    def unknown(self) -> float:
        return float(self.root(np.zeros(1), np.zeros(1))[0])


def seat(customers: np.ndarray, others: np.ndarray, p: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers sat down one by one; others: tables of all other dishes there, p: the parent's probability."""
    customers = customers.astype(_L)
    tables = np.minimum(customers, 1).astype(float)
    active = np.flatnonzero(customers > 1)
    i = 1
    while len(active):
        fresh = (STRENGTH + discount * (others[active] + tables[active])) * p[active]
        rate = fresh / (fresh + np.maximum(i - discount * tables[active], 1e-9))
        step = 1 if i < 64 else i // 16
        tables[active] += rng.random(len(active)) < rate if step == 1 else rng.binomial(np.minimum(step, customers[active] - i), rate)
        i += step
        active = active[customers[active] > i]
    return tables


def class_probabilities(s: dict, t: Totals) -> tuple[np.ndarray, np.ndarray]:
    """(of each word and class, of each word in the unigram restaurant) in the present state."""
    row = np.repeat(np.arange(len(s["w"])), s["csize"])
    p0 = t.root(np.bincount(row, s["tab"], minlength=len(s["w"])), s["rt"])
    c = s["cls"].astype(_L)
    return (s["cnt"] - t.discounts[1] * s["tab"]) / (STRENGTH + t.class_n[c]) + t.class_back()[c] * p0[row], p0


def _swept(listed: Contexts, t: Totals, sweep: int, sample: int | None, again: bool):
    """Keep the state as ``sample``; then (``again``) seat everyone anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(listed)
        for r in _rows(batches):
            s = _state(r)
            rng = np.random.default_rng([sweep, r["bucket"]])
            q, p0 = class_probabilities(s, t)
            if sample is not None:
                s |= {f"t{sample}": s["t"], f"q{sample}": q, f"r{sample}": p0}
            if again:
                word = np.repeat(np.arange(len(s["w"])), s["size"])
                row = np.repeat(np.arange(len(s["w"])), s["csize"])
                cls = _class_of(s["code"], listed)
                both = row * (CLASSES + 1) + s["cls"]
                new = np.ones(len(s["n"]))
                on = np.flatnonzero((s["code"] < k) & (s["n"] > 1))
                parent = q[np.searchsorted(both, word[on] * (CLASSES + 1) + cls[on])]
                new[on] = seat(s["n"][on], t.t[s["code"][on]] - s["t"][on], parent, t.discounts[0], rng)
                s["t"] = new
                s["cnt"] = _class_customers(s, k, word, cls, both)
                s["tab"] = seat(s["cnt"], t.class_t[s["cls"].astype(_L)] - s["tab"], p0[row], t.discounts[1], rng)
                guests = np.bincount(row, s["tab"], minlength=len(s["w"]))
                s["rt"] = seat(guests, t.root_t - s["rt"], np.full(len(s["w"]), 1 / (t.vocabulary + 1)), t.discounts[2], rng)
            yield _row(["bucket", *_KINDS], [r["bucket"], *[s[x].astype(kind) for x, kind in _KINDS.items()]])

    return run


def _sums(k: int):
    """Rows (kind, id, v) of sums over a task's buckets: 0 the contexts' tables and 1 customers (bucket by bucket), 2 the classes' tables and 3 customers,
    4 the unigram restaurant's tables, 5 words and tokens, 6-8 how many counts of one and two there are on each level."""

    def rows(kind: int, at: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(at), kind, _I)), pa.array(at.astype(_I)), pa.array(v.astype(np.float64))], ["kind", "id", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = {2: np.zeros(CLASSES + 1), 3: np.zeros(CLASSES + 1), 4: np.zeros(1), 5: np.zeros(2), 6: np.zeros(2), 7: np.zeros(2), 8: np.zeros(2)}
        for r in _rows(batches):
            s = _state(r)
            on = s["code"] < k
            row = np.repeat(np.arange(len(s["w"])), s["csize"])
            guests = np.bincount(row, s["tab"], minlength=len(s["w"]))
            some, at = np.unique(s["code"][on], return_inverse=True)
            for kind, x in ((0, "t"), (1, "n")):
                yield rows(kind, some, np.bincount(at, s[x][on], minlength=len(some)))
            out[2] += np.bincount(s["cls"], s["tab"], minlength=CLASSES + 1)
            out[3] += np.bincount(s["cls"], s["cnt"], minlength=CLASSES + 1)
            out[4] += s["rt"].sum()
            out[5] += [len(s["w"]), s["n"].sum()]
            for x, counts in ((6, s["n"][on]), (7, s["cnt"]), (8, guests)):
                out[x] += [(counts == 1).sum(), (counts == 2).sum()]
        for kind, v in out.items():
            yield rows(kind, np.flatnonzero(v), v[np.flatnonzero(v)])

    return run


def _gathered(state: DataFrame, listed: Contexts) -> dict:
    """The sums over all buckets; of the contexts, in slices that come to the driver one at a time."""
    spark = state.sparkSession
    names = [c for c in _KINDS if c[-1] not in "0123456789"]
    sums = state.select("bucket", *names).mapInArrow(_sums(len(listed)), "kind int, id int, v double").groupBy("kind", "id").agg(F.sum("v").alias("v"))
    sums = stored(sums, "totals")
    edges = listed.words.edges

    def numbers(rows: DataFrame, sizes: dict[int, int], begin: int = 0) -> dict[int, np.ndarray]:
        found = rows.toArrow()
        kind, at, v = (found.column(c).to_numpy() for c in ("kind", "id", "v"))
        out = {x: np.zeros(n) for x, n in sizes.items()}
        for x in out:
            out[x][at[kind == x] - begin] = v[kind == x]
        return out

    out = numbers(sums.where("kind > 1"), {2: CLASSES + 1, 3: CLASSES + 1, 4: 1} | dict.fromkeys(range(5, 9), 2))
    parts: dict[int, list] = {0: [], 1: []}
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        for x, v in numbers(sums.where(f"kind <= 1 and id >= {a} and id < {b}"), {0: b - a, 1: b - a}, a).items():
            parts[x].append(spark.sparkContext.broadcast(v))
    forget(spark, sums)
    return out | {x: Sliced(edges, part) for x, part in parts.items()}


@dataclass
class Model:
    """state: the buckets, stored; samples: the totals at each sample; info: counts N and V."""

    state: DataFrame
    listed: Contexts
    samples: list[Totals]
    tokens: int
    vocabulary: int
    bits: int


def _kneser(v: np.ndarray) -> float:
    return float(np.clip(v[0] / (v[0] + 2 * v[1]), 0.05, 0.95)) if v[0] else 0.5


def bucket_bits(docs: DataFrame) -> int:
    """Buckets, as a power of two: about one for BUCKET tokens (six bytes each), and one for each shuffle partition."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(0, int(np.ceil(np.log2(max(size / 6 / BUCKET, partitions(docs.sparkSession), 1)))))


def train(docs: DataFrame, least: int = LEAST, most: int = MOST_CONTEXTS) -> Model:
    """docs: (text), the training rows."""
    spark = docs.sparkSession
    bits = bucket_bits(docs)
    listed = contexts(docs, bits, least, most)
    blocks = docs.select("text").mapInArrow(_pair_blocks(listed, bits), "bucket long, w binary, size binary, code binary, n binary")
    state = stored(_dealt(blocks).mapInArrow(_counted(listed), _STATE), "counts")
    drop_shuffles(spark)
    discounts, samples = None, []
    for j in range(SWEEPS + 1):
        g = _gathered(state, listed)
        discounts = discounts or (_kneser(g[6]), _kneser(g[7]), _kneser(g[8]))
        t = Totals(g[1], g[0], g[3], g[2], float(g[4][0]), int(g[5][0]), discounts)
        sample = j - BURN_IN - 1 if j > BURN_IN else None
        if sample is not None:
            samples.append(t)
        new = stored(state.mapInArrow(_swept(listed, t, j, sample, j < SWEEPS), _STATE), "seated")
        forget(spark, state)
        state = new
    return Model(state, listed, samples, int(g[5][1]), int(g[5][0]), bits)


# Scores


def pair_key(w: np.ndarray, code: np.ndarray) -> np.ndarray:
    return words.mix(w ^ words.mix(code.astype(_U) + _U(words.BASE)))


class Scorer:
    """A bucket's predictive probabilities."""

    def __init__(self, s: dict, listed: Contexts, samples: list[Totals], bottom: float):
        self.s, self.listed, self.samples, self.bottom = s, listed, samples, bottom
        span = len(listed) + CLASSES + 1
        word = np.repeat(np.arange(len(s["w"])), s["size"])
        self.span, self.key = span, word * span + s["code"]
        self.both = np.repeat(np.arange(len(s["w"])), s["csize"]) * (CLASSES + 1) + s["cls"]
        self.total = np.bincount(word, s["n"], minlength=len(s["w"]))

    def probabilities(self, at: np.ndarray, known: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Of the word at the place ``at`` (if known) after each context."""
        k = len(self.listed)
        cls = _class_of(code, self.listed)
        held, c_at = _places(self.both, at * (CLASSES + 1) + cls)
        seen, p_at = _places(self.key, at * self.span + code)
        held, seen, own = held & known, seen & known, code < k
        out = np.zeros(len(code))
        for j, t in enumerate(self.samples):
            unknown = np.full(len(code), t.unknown())
            p0 = np.where(known, self.s[f"r{j}"][at], unknown) if len(self.s["w"]) else unknown
            p = t.class_back()[cls] * p0
            p[held] = self.s[f"q{j}"][c_at[held]]
            x = code[own]
            mine = np.zeros(len(x))
            there = seen[own]
            mine[there] = self.s["n"][p_at[own][there]] - t.discounts[0] * self.s[f"t{j}"][p_at[own][there]]
            n = t.n[x]
            p[own] = mine / (STRENGTH + n) + t.back(n, t.t[x]) * p[own]
            out += p
        return out / len(self.samples)

    def scores(self, w: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(log10 probability, base score, whether known) of each word w after its context."""
        known, at = _places(self.s["w"], w)
        c = np.where(known, self.total[at], 0) if len(self.total) else np.zeros(len(w))
        return np.log10(self.probabilities(at, known, code)), np.log10((c + 0.1) / self.bottom), known


def _frequent_pairs(listed, samples, bottom: float, least: int):
    """Pairs with more than ``least`` customers, and what they score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _rows(batches):
            s = _state(r)
            on = np.flatnonzero(s["n"] > least)
            w, code = np.repeat(s["w"], s["size"])[on], s["code"][on].astype(_L)
            logs, base, _ = Scorer(s, listed, samples, bottom).scores(w, code)
            yield pa.RecordBatch.from_arrays([pa.array(pair_key(w, code).view(_L)), pa.array(logs), pa.array(base)], ["key", "logs", "base"])

    return run


def _common_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for r in _rows(batches):
        n, c = np.unique(_array(r["n"], _L), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(n[n > 8]), pa.array(c[n > 8])], ["n", "c"])


_REQUEST = ["bucket", "kind", "chunk", "w", "size", "code", "doc"]


def _requests(listed, known, bits: int):
    """A chunk's rows: one (kind 2) of its documents' own sums, and for each bucket one (kind 1) of the words asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 24
        keys, logs, base = known.value
        span = len(listed) + CLASSES + 1
        for c in chunks(batches, CHUNK):
            doc = np.repeat(np.arange(len(c.sizes)), c.sizes)
            pair, back = np.unique(c.token * span + c.codes(listed), return_inverse=True)
            word = pair // span
            hit, at = _places(keys, pair_key(c.words[word], pair - word * span))
            done = hit[back]
            sums = [np.bincount(doc[done], x[at[back[done]]] if len(x) else None, minlength=len(c.sizes)).astype(float) for x in (logs, base)]
            some = np.bincount(doc[done], minlength=len(c.sizes)).astype(_L)
            ids = c.ids.fill_null(0).to_numpy(zero_copy_only=False).astype(_L)
            null = np.array(c.ids.is_null().to_numpy(zero_copy_only=False), np.int8)
            yield _row(_REQUEST, [((chunk >> 24) + chunk) & ((1 << bits) - 1), 2, chunk, np.concatenate([ids, c.sizes.astype(_L), some]), np.concatenate(sums), null, np.zeros(0)])
            left = np.flatnonzero(~done)
            left = left[np.argsort(back[left], kind="stable")]
            token = c.token[left]
            code, e = (pair - word * span)[back[left]].astype(_I), _edges(c.words, bits)
            bound = np.searchsorted(token, e)
            for k in np.flatnonzero(np.diff(bound)):
                s = slice(bound[k], bound[k + 1])
                asked, first, sizes = np.unique(token[s], return_index=True, return_counts=True)
                yield _row(_REQUEST, [int(k), 1, chunk, c.words[asked], sizes.astype(_I), code[s], doc[left[s]].astype(_I)])
            chunk += 1

    return run


def _answers(listed, samples, bottom: float):
    """From rows ordered by bucket, the state's first (kind 0): sums by document for each request, and the chunks' own rows as they are."""
    names = ["chunk", "kind", "a", "b", "c"]

    def answered(scorer: Scorer, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Of requests (chunk, words, contexts, documents) to one bucket, looked up together."""
        if not held:
            return
        found = scorer.scores(*[np.concatenate([h[x] for h in held]) for x in (1, 2)])
        ends = np.cumsum([len(h[1]) for h in held])[:-1]
        for (chunk, _, _, doc), logs, base, known in zip(held, *[np.split(x, ends) for x in found], strict=True):
            some, at = np.unique(doc, return_inverse=True)
            sums = np.concatenate([np.bincount(at, x, minlength=len(some)) for x in (logs, base)])
            yield _row(names, [chunk, 1, some.astype(_I), sums, np.bincount(at, known, minlength=len(some)).astype(_I)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = bucket = None
        held, size = [], 0
        empty = {k: np.zeros(0, t) for k, t in _KINDS.items()}
        for r in _rows(batches):
            if r["kind"] == 2:
                yield _row(names, [r["chunk"], 0, *[_array(r[x], np.int8) for x in ("w", "size", "code")]])
                continue
            if r["bucket"] != bucket:
                yield from answered(scorer, held)
                held, size = [], 0
                bucket = r["bucket"]
                scorer = Scorer(_state(r) if r["kind"] == 0 else empty, listed, samples, bottom)
            if r["kind"] == 1:
                w = np.repeat(_array(r["w"], _U), _array(r["size"], _I))
                held.append((r["chunk"], w, _array(r["code"], _I).astype(_L), _array(r["doc"], _I)))
                size += len(w)
                if size >= ASKED:
                    yield from answered(scorer, held)
                    held, size = [], 0
        yield from answered(scorer, held)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows ordered by chunk, its own first: a row for each document."""
    own = chunk = None

    def out():
        ids, sizes, known, logs, base, null = own
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64(), mask=null), pa.array(sizes), pa.array(known), pa.array(base), pa.array(logs)], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    for r in _rows(batches):
        if r["kind"] == 0:
            if own is not None:
                yield out()
            chunk = r["chunk"]
            numbers, sums = _array(r["a"], _L).reshape(3, -1), _array(r["b"], np.float64).reshape(2, -1)
            own = numbers[0], numbers[1], numbers[2].copy(), sums[0].copy(), sums[1].copy(), _array(r["c"], np.int8).astype(bool)
        else:
            assert r["chunk"] == chunk
            at, sums = _array(r["a"], _I), _array(r["b"], np.float64).reshape(2, -1)
            own[3][at] += sums[0]
            own[4][at] += sums[1]
            own[2][at] += _array(r["c"], _I)
    if own is not None:
        yield out()


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs: (doc_id, text). One row per row: doc_id, n_tokens, n_known, train_tokens, base_score, score (log10)."""
    spark = docs.sparkSession
    bottom = model.tokens + 0.1 * (model.vocabulary + 1)
    samples = model.samples
    least, held = 8, 0
    for r in model.state.select("n").mapInArrow(_common_counts, "n long, c long").groupBy("n").agg(F.sum("c").alias("c")).orderBy(F.desc("n")).toLocalIterator():
        held += r["c"]
        if held > FREQUENT:
            least = r["n"]
            break
    top = model.state.mapInArrow(_frequent_pairs(model.listed, samples, bottom, least), "key long, logs double, base double").toArrow()
    keys = top.column("key").to_numpy().astype(_L).view(_U)
    order = np.argsort(keys)
    known = spark.sparkContext.broadcast((keys[order], top.column("logs").to_numpy()[order], top.column("base").to_numpy()[order]))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    asked = own.mapInArrow(_requests(model.listed, known, model.bits), "bucket long, kind long, chunk long, w binary, size binary, code binary, doc binary")
    needed = ["w", "size", "code", "n", "csize", "cls", *[f"{x}{j}" for j in range(SAMPLES) for x in "tqr"]]
    none = lambda c: F.lit(None).cast("binary").alias(c)
    held_ = model.state.select("bucket", F.lit(0).cast("long").alias("kind"), F.lit(-1).cast("long").alias("chunk"), *needed, none("doc"))
    both = held_.unionByName(asked, allowMissingColumns=True)
    answers = _dealt(both, "kind", "chunk").mapInArrow(_answers(model.listed, samples, bottom), "chunk long, kind long, a binary, b binary, c binary")
    sums = answers.repartition(partitions(spark), "chunk").sortWithinPartitions("chunk", "kind").mapInArrow(_added, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return sums.select("doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
