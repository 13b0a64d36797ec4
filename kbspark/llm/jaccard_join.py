"""N-gram Jaccard self-join by token-combination prefixes.

A text's set is its distinct 5-word shingles (64-bit hashes). Texts with the same set share
one *node*, named by the set's fingerprint, so copies are one row from here on. A global
order puts rare shingles first (by hash) and frequent ones last (rarest first), so a set
of n shingles that has a partner of Jaccard >= t shares one of its first n - ceil(t n) + 1
shingles with it: the prefix. Rare shingles are indexed by themselves, with their position. A prefix
that has frequent ones is extended by g shingles, g a power of two near an eighth of it, so that two
such partners share g + 1. If all of these are frequent, two of them fall into one of g classes (by
hash), so frequent shingles are indexed by their pairs within a class: the key of such a pair
is far rarer than either. A set also indexes the pairs of the g below it, as the partner's g
may be half its own.

Keys with one node are dropped. Then, in two rounds, candidate pairs are verified exactly and
joined to components: first each node with the pivot of each of its keys, the key's node with the fewest rare
shingles (of near copies the one most like the others, so a group of
thousands costs thousands of checks, not millions), then the pairs that share a key and are still in different components.
Every filter is exact:

- length, and the position of a rare shingle;
- count: of two sets whose prefixes are rare, the one whose prefix ends first can share no more with the other
  than the keys they share and what follows that prefix; two sets whose prefixes reach the frequent shingles share no more than
  their rare keys and the smaller number of frequent shingles. The first round sees but some of the keys of
  two nodes, so it asks for an eighth of that and may pass a pair on to the second, which counts all;
- parity: a node carries SKETCH bits, each the parity of how many of its shingles fall there. Two nodes differ in at
  most as many bits as they have shingles that the other lacks. Where keys are pairs of frequent shingles, and their lists long,
  the join itself asks this, so it makes few rows besides the links.

Two nodes may share hundreds of keys that are pairs of frequent shingles, and one is as good as all, since only rare keys are counted. So
for the second round those keys that have the same smallest node are one: all nodes of any of them meet there, and two nodes that share
hundreds of keys meet a few times.

No pair that could link two components goes unchecked.

Statistics that order the shingles are counts over all documents. The frequent list that every
task receives has at most 2 * FREQUENT_MOST entries (all shingles above a count); it only sets the order and the
class, and any order gives the same result.

Defined cases: null and wordless texts have an empty set and link with nothing; a text of under
five words has one shingle, the whole sequence; null ids are ids like any other, and the smallest of them; repeated ids: each row is a text of its own,
and a shared id by itself links nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import drop_shuffles, forget, partitions, sliced, stored
from .components import components

#: A shingle in more prefixes than this is frequent.
FREQUENT_FROM = 10
#: Size of the list that orders frequent shingles (16 bytes each).
FREQUENT_MOST = 1 << 20
SHINGLE, SIMILARITY = 5, 75
#: Parity bits of a node, in words of 64.
SKETCH = 512
SKETCHES = [f"s{k}" for k in range(SKETCH // 64)]

_LONG = np.int64
#: What a posting is of, beside its set's size and a number: a rare shingle of a prefix without frequent ones (its position),
#: one of a prefix with frequent ones (how many rare ones the set has), a pair of frequent ones (the same).
PURE, MIXED, PAIR = 0, 1, 2


def _need(n: np.ndarray | int, percent: int):
    return -(-percent * n // 100)


def _prefix(n: int, percent: int) -> int:
    return n - _need(n, percent) + 1


def fingerprint(s: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        return int(words.mix(np.array([np.add.reduce(words.mix(s)) ^ np.uint64(len(s))], np.uint64))[0].view(_LONG))


def _slices(b: pa.RecordBatch, n: int) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    """(from row, to row, their sets): half a megabyte of text, or one text, at a time."""
    texts = words.as_bytes(b.column("text"))
    for lo, hi in words.batches(texts):
        yield lo, hi, words.shingle_sets(texts[lo:hi], n)


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """A row of SKETCH parity bits, as 64-bit numbers, for each set."""
    bits = np.zeros(len(sets) * SKETCH, np.uint8)
    if sets:
        own = np.repeat(np.arange(len(sets)) * SKETCH, [len(s) for s in sets])
        at = (np.concatenate(sets) >> np.uint64(64 - SKETCH.bit_length() + 1)).astype(_LONG)
        bits = (np.bincount(own + at, minlength=len(bits)) & 1).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view(_LONG).reshape(len(sets), -1)


def _sketch(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            for lo, hi, sets in _slices(b, n):
                p = parities(sets)
                cols = [pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), *[pa.array(p[:, k]) for k in range(len(SKETCHES))]]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), *cols], ["doc_id", "node", "n_shingles", *SKETCHES])

    return run


def _is_in(tokens: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each of s is among the sorted tokens, its place there or 0)."""
    at = np.searchsorted(tokens, s)
    at[at == len(tokens)] = 0
    return (tokens[at] == s if len(tokens) else np.zeros(len(s), bool)), at


def _counts(n: int, percent: int, frequent=None):
    """How many sets hold each shingle, added up over a few MB of text: of the first shingles (in hash order) of each set,
    twice as many as its prefix; or, with the list of those of them that are frequent, of all the others of the sets whose prefix goes on beyond these.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            keys, c = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys.view(_LONG)), pa.array(c.astype(np.int32))], ["token", "n"])

        for b in sliced(batches):
            for _, _, sets in _slices(b, n):
                for s in sets:
                    p = _prefix(len(s), percent)
                    own = s[: 2 * p]
                    if frequent is not None:
                        own = s[2 * p :] if 2 * p < len(s) and (~_is_in(frequent.value[0], own)[0]).sum() < p else s[:0]
                    if len(own):
                        held.append(own)
                        size += len(own)
                if size > 1 << 20:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return run


def _classes(p: int) -> int:
    return max(1, 1 << max(0, (p // 8).bit_length() - 1))


def _postings(n: int, percent: int, frequent):
    """Rows (key, node, what): what is size * 2**32 + kind * 2**30 + number."""

    def keys(s: np.ndarray, tokens: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        p = _prefix(len(s), percent)
        g = _classes(p)
        often, at = _is_in(tokens, s)
        rare, common = s[~often], s[often]
        if len(rare) >= p:
            return rare[:p], np.arange(p)
        out, places = [rare], [np.full(len(rare), (MIXED << 30) + len(rare))]
        if len(common):
            common = common[np.argsort(ranks[at[often]], kind="stable")][: p + g - len(rare)]
            for classes in {g, max(1, g // 2)}:
                h = words.mix(common)
                cls = h % np.uint64(classes)
                order = np.lexsort((h, cls))
                c, v = cls[order], h[order]
                for gap in range(1, len(c)):
                    same = c[gap:] == c[:-gap]
                    if not same.any():
                        break
                    pair = words.mix(v[:-gap][same] + words.mix(v[gap:][same]) + np.uint64(classes))
                    out.append(pair)
                    places.append(np.full(len(pair), (PAIR << 30) + len(rare)))
        return np.concatenate(out), np.concatenate(places)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, ranks = frequent.value
        seen: set[int] = set()
        for b in sliced(batches):
            if len(seen) > 100_000:
                seen.clear()
            for _, _, sets in _slices(b, n):
                k, w, what = [], [], []
                for s in sets:
                    if not len(s) or (f := fingerprint(s)) in seen:
                        continue
                    seen.add(f)
                    key, place = keys(s, tokens, ranks)
                    k.append(key)
                    w.append(np.full(len(key), f, _LONG))
                    what.append((len(s) << 32) + place)
                if k:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(k).view(_LONG)), pa.array(np.concatenate(w)), pa.array(np.concatenate(what))], ["key", "node", "what"])

    return run


def _verify(percent: int):
    """From sets ordered by hub, the hub's own first (b null): the pairs that reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = mine = None
        for rows in batches:
            found: tuple[list[int], list[int]] = ([], [])
            for a, b, x in zip(rows.column("a").to_pylist(), rows.column("b").to_pylist(), rows.column("shingles").to_pylist(), strict=True):
                s = np.frombuffer(x, np.uint64)
                if b is None:
                    hub, mine = a, s
                    continue
                assert a == hub
                small, large = (s, mine) if len(s) < len(mine) else (mine, s)
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                both = int((large[at] == small).sum())
                if 100 * both >= percent * (len(s) + len(mine) - both):
                    found[0].append(a)
                    found[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], ["a", "b"])

    return run


def _long_enough(x: str, y: str, percent: int) -> str:
    return f"100 * least({x}, {y}) >= {percent} * greatest({x}, {y})"


def _need_of(x: str, y: str, percent: int) -> str:
    """How many shingles sets of these sizes must share."""
    return f"(({percent} * ({x} + {y}) + {99 + percent}) div {100 + percent})"


def _alike(l: str, r: str, x: str, y: str, percent: int) -> str:  # noqa: E741
    """No more parity bits differ than shingles may: x and y are the sizes, l and r prefixes of the parities' columns."""
    bits = " + ".join(f"bit_count({l}{s} ^ {r}{s})" for s in SKETCHES)
    return f"{bits} <= {x} + {y} - 2 * {_need_of(x, y, percent)}"


def _candidates(rows: DataFrame, percent: int, seen: int = 1) -> DataFrame:
    """Pairs (a, b) that may reach the similarity, of rows (a, b, x, y): two nodes and their postings' what, for each key they share (or one of seen)."""
    for c in "xy":
        rows = rows.withColumns({c + "size": F.shiftright(c, 32), c + "kind": F.expr(f"shiftright({c}, 30) & 3"), c + "number": F.expr(f"{c} & {(1 << 30) - 1}")})
    need = _need_of("xsize", "ysize", percent)
    rest = lambda c: f"if({c}kind = {PURE}, ({percent} * {c}size + 99) div 100 - 1, null)"
    early = lambda c: f"({c}kind <> {PURE} or {c}number <= {c}size - {need})"
    mixed = f"if(xkind <> {PURE} and ykind <> {PURE}, least(xsize - xnumber, ysize - ynumber), null)"
    rows = rows.where(_long_enough("xsize", "ysize", percent)).select(
        "a", "b",
        F.expr(f"cast(xkind <> {PAIR} as int)").alias("rare"),
        F.expr(f"{early('x')} and {early('y')}").alias("near"),
        # a pair of frequent shingles is no posting of a pure prefix, so only rare keys tell which prefixes are pure
        F.expr(f"cast({need} - greatest({rest('x')}, {rest('y')}, {mixed}) as int)").alias("least"),
    )
    counted = rows.groupBy("a", "b").agg(F.sum("rare").alias("rare"), F.max("near").alias("near"), F.max("least").alias("least"))
    return counted.where(f"near and {seen} * rare >= coalesce(least, 0)").select("a", "b")


def _unlike_dropped(pairs: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """The pairs whose parities allow the similarity."""
    own = lambda c: chosen.select(F.col("node").alias(c), F.col("n_shingles").alias(c + "size"), *[F.col(s).alias(c + s) for s in SKETCHES])
    return pairs.join(own("a"), "a").join(own("b"), "b").where(_alike("a", "b", "asize", "bsize", percent)).select("a", "b")


def nodes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, node, n_shingles, parities) of every row; node null for an empty set."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_sketch(shingle), "doc_id long, node long, n_shingles long" + "".join(f", {s} long" for s in SKETCHES))


def _above(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles, in order, and their counts: those above FREQUENT_FROM, or above the count that leaves FREQUENT_MOST."""
    spark = counts.sparkSession
    often = stored(counts.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > FREQUENT_FROM), "often")
    least, held = FREQUENT_FROM, 0
    for r in often.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        held += r["count"]
        if held > FREQUENT_MOST:
            least = r["n"]
            break
    top = often.where(F.col("n") > least).toArrow()
    forget(spark, often)
    drop_shuffles(spark)
    tokens = top.column("token").to_numpy().astype(_LONG).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], top.column("n").to_numpy().astype(_LONG)[order]


def _frequent(text: DataFrame, shingle: int, percent: int):
    """The broadcast list of frequent shingles, in order, with their counts.

    Where they leave less than a prefix of what was counted of a set, its other shingles are counted as well: so no
    set's prefix has shingles of unknown frequency, and few sets are counted whole.
    """
    spark = text.sparkSession
    first = _above(text.mapInArrow(_counts(shingle, percent), "token long, n int"))
    listed = spark.sparkContext.broadcast(first)
    then = _above(text.mapInArrow(_counts(shingle, percent, listed), "token long, n int"))
    tokens, at = np.unique(np.concatenate([first[0], then[0]]), return_index=True)
    return spark.sparkContext.broadcast((tokens, np.concatenate([first[1], then[1]])[at]))


def _live_postings(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Postings of all keys that two nodes or more have."""
    spark, text = docs.sparkSession, docs.select("text")
    listed = _frequent(text, shingle, percent)
    posts = text.mapInArrow(_postings(shingle, percent, listed), "key long, node long, what long")
    # sorted by Spark (which spills) and read as a stream: a key's rows are never held together
    fewest_rare = F.expr(f"if(shiftright(what, 30) & 3 = {PAIR}, what & {(1 << 30) - 1}, 0)")
    ordered = posts.repartition(partitions(spark), "key").sortWithinPartitions("key", fewest_rare, F.xxhash64("node"), "node")
    live = stored(ordered.mapInArrow(_shared, "key long, node long, what long, pivot long, pivot_what long"), "live")
    drop_shuffles(spark)
    return live


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From postings in order: those of keys with two nodes or more, each once, with the key's first node as its pivot."""
    names = ("key", "node", "what")
    last = pivot = None
    told = False
    for b in batches:
        k, n, w = (b.column(c).to_numpy(zero_copy_only=False) for c in names)
        if not len(k):
            continue
        if last is not None:
            k, n, w = (np.concatenate([[x], y]) for x, y in zip(last, (k, n, w), strict=True))
        new = np.ones(len(k), bool)
        new[1:] = (k[1:] != k[:-1]) | (n[1:] != n[:-1])
        if last is not None:
            new[0] = False  # sent or held before
        start = np.ones(len(k), bool)
        start[1:] = k[1:] != k[:-1]
        if last is not None:
            # the run that goes on: its pivot is known, and may have to be sent yet
            more = bool(((k == pivot[0]) & new).any())
            head = [np.array([x]) for x in pivot] if more and not told else None
        else:
            more, head = False, None
        run = np.cumsum(start) - 1
        first = np.flatnonzero(start)
        p_node, p_what = n[first].copy(), w[first].copy()
        if last is not None:
            p_node[0], p_what[0] = pivot[1], pivot[2]
        sizes = np.bincount(run, new)
        if last is not None:
            sizes[0] += 1  # the pivot
        keep = new & (sizes[run] > 1)
        at = np.flatnonzero(keep)
        out = [k[at], n[at], w[at], p_node[run[at]], p_what[run[at]]]
        if head is not None:
            out = [np.concatenate([h, o]) for h, o in zip([*head, head[1], head[2]], out, strict=True)]
        end = run[-1]
        if end == 0 and last is not None:
            told = told or more
        else:
            pivot, told = (k[first[-1]], n[first[-1]], w[first[-1]]), bool(sizes[end] > 1)
        last = (k[-1], n[-1], w[-1])
        if len(out[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], [*names, "pivot", "pivot_what"])


def _verified(pairs: DataFrame, docs: DataFrame, chosen: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b), a < b, of nodes whose sets reach the similarity, stored; sets are made anew from one text of each node.

    A hub's set goes once to every PARTNERS of its partners' sets or so.
    """
    spark = docs.sparkSession
    pairs = stored(_unlike_dropped(pairs, chosen, percent), "pairs")
    asked = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = stored(chosen.select("node", "row").join(asked, "node", "left_semi"), "wanted")
    made = _full_sets(docs.select(_row(), "text"), wanted, shingle)
    # one shuffle: the rows of one id and node, equal texts, are where the join puts them
    sets = made.join(wanted, ["row", "node"]).groupBy("row", "node").agg(F.first("shingles").alias("shingles"))
    sets = stored(sets.select("node", "shingles"), "sets")
    forget(spark, wanted)
    hubs = pairs.groupBy("a").count().where(F.col("count") > PARTNERS).select("a", F.expr(f"cast(ceil(count / {PARTNERS}) as int)").alias("parts"))
    dealt = stored(pairs.join(hubs, "a", "left").select("a", F.expr("pmod(xxhash64(b), coalesce(parts, 1))").alias("part"), "b"), "dealt")
    others = dealt.join(sets.withColumnRenamed("node", "b"), "b").select("a", "part", "b", "shingles")
    mine = dealt.select("a", "part").distinct().join(sets.withColumnRenamed("node", "a"), "a").select("a", "part", F.lit(None).cast("long").alias("b"), "shingles")
    both = mine.unionByName(others).repartition(partitions(spark), "a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    links = stored(both.select("a", "b", "shingles").mapInArrow(_verify(percent), "a long, b long"), "links")
    forget(spark, pairs, dealt, sets)
    drop_shuffles(spark)
    return links


#: Partners of a hub that are verified together.
PARTNERS = 64
#: Bits of the filter that spares most unwanted texts the shuffle; full, it spares none.
FILTER_BITS = 1 << 24

def _row() -> Column:
    """What tells the text of a node again: its id, as any row of that id and fingerprint has the node's set (null as a number of its own)."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("row")


def _full_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(row, node, shingles) of the rows of docs whose number may be wanted, by a bitmap of fixed size (2 MB); the join that follows is exact.

    The same worker sifts the texts and makes the sets: they go to Python once, and a task has one worker.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    at = wanted.select(bit("row").alias("x")).select(F.shiftright("x", 5).alias("i"), F.expr("shiftleft(1L, cast(x % 32 as int))").alias("v"))
    bits = np.zeros(FILTER_BITS // 32, np.uint32)
    for r in at.groupBy("i").agg(F.bit_or("v").alias("v")).toLocalIterator():
        bits[r.i] = r.v
    listed = docs.sparkSession.sparkContext.broadcast(bits)

    def maybe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x").to_numpy(zero_copy_only=False)
            keep = (listed.value[x >> 5] >> (x & 31).astype(np.uint32)) & 1 == 1
            yield b.filter(pa.array(keep))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(maybe(batches)):
            for lo, hi, sets in _slices(b, n):
                marks = pa.array([fingerprint(s) if len(s) else None for s in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([b.column("row").slice(lo, hi - lo), marks, pa.array([s.tobytes() for s in sets], pa.binary())], ["row", "node", "shingles"])

    return docs.withColumn("x", bit("row")).mapInArrow(run, "row long, node long, shingles binary")


def _across(live: DataFrame, found: DataFrame, chosen: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b, x, y) of the pairs of nodes in different components, for each rare key they share, and at least once for those that are pairs."""
    part = live.join(found, "node", "left").select("key", "node", "what", F.coalesce("component", "node").alias("comp"))
    mixed = part.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("node").alias("smallest")).where("lo <> hi").select("key", "smallest")
    is_pair = F.expr(f"shiftright(what, 30) & 3 = {PAIR}")
    # keys that are pairs, by their smallest node; all such postings of a node are alike
    part = part.join(mixed, "key").select(F.when(is_pair, F.col("smallest")).otherwise(F.col("key")).alias("key"), "node", "what", "comp").distinct()
    part = stored(part.withColumn("size", F.shiftright("what", 32)), "mixed")
    on = f"l.key = r.key and l.node < r.node and l.comp <> r.comp and {_long_enough('l.size', 'r.size', percent)}"
    out = None
    for rows, also in ((part.where(~is_pair), ""), (part.where(is_pair).join(chosen.select("node", *SKETCHES), "node"), " and " + _alike("l.", "r.", "l.size", "r.size", percent))):
        met = rows.alias("l").join(rows.alias("r"), F.expr(on + also)).select(F.col("l.node").alias("a"), F.col("r.node").alias("b"), F.col("l.what").alias("x"), F.col("r.what").alias("y"))
        out = met if out is None else out.unionByName(met)
    out._stored_at = part._stored_at
    return out


def similar_nodes(docs: DataFrame, marked: DataFrame, shingle: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """(node, component) of the nodes that have links, component being the smallest node reachable.

    docs: (doc_id, text); marked: nodes(docs).
    """
    spark = docs.sparkSession
    live = _live_postings(docs, shingle, percent)
    first = F.first  # rows of one node have the same size and parities
    chosen = marked.where("node is not null").groupBy("node").agg(F.min(_row()).alias("row"), *[first(c).alias(c) for c in ("n_shingles", *SKETCHES)])
    chosen = stored(chosen, "chosen")
    star = live.where("node <> pivot").select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"), F.col("pivot_what").alias("x"), F.col("what").alias("y"))
    links = _verified(_candidates(star, percent, 8), docs, chosen, shingle, percent)
    found = components(links)
    cross = _across(live, found, chosen, percent)
    more = _verified(_candidates(cross, percent), docs, chosen, shingle, percent)
    forget(spark, live, cross, links, chosen)
    if more.isEmpty():
        forget(spark, more)
        return found
    out = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    forget(spark, found, more)
    return out


def jaccard_join(docs: DataFrame, shingle: int = SHINGLE, percent: int = SIMILARITY) -> DataFrame:
    """docs: (doc_id, text). One row per row of docs: doc_id, n_shingles, component_id."""
    marked = stored(nodes(docs, shingle), "nodes")
    groups = similar_nodes(docs, marked, shingle, percent)
    # classes of equal sets first (partial minima), then classes by component; a null id is the smallest
    classes = marked.where("node is not null").groupBy("node").agg(F.min(_row()).alias("least"))
    classes = classes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "component").select("node", "component_id")
    out = marked.join(named, "node", "left")
    name = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.nullif("component_id", F.lit(-(1 << 63))))
    return out.select("doc_id", "n_shingles", name.alias("component_id"))
