"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Rows are packed into blocks. A candidate block keeps a posting list for each term
(dimension): the rows with a weight there, and the weights. A query block is taken
against each candidate block: term by term the weights of the posting list are
scattered, times the queries' weights, into dense integer score arrays; the best k of a
block are selected by partition (not by sorting), and the blocks' bests are merged.

Cost: query blocks x candidate blocks, as the search is exhaustive; a task holds one
block of each side and its best lists, whatever the table's size. No side is broadcast.

Defined cases: a vector that is null or holds a null or non-finite component, or whose id is null, takes no
part; vectors of unequal length meet on the terms both have; an empty vector scores 0;
rows that share an id are searched one by one, and a query skips every candidate with its
own id, whatever their scores; ties go to the smaller id; fewer than k candidates give fewer rows; an empty
table gives none; extra columns are ignored. A component that leaves 64 bits when scaled is the nearest 64-bit integer, and a score that
leaves them wraps around.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stored

#: Rows of a candidate block, queries of a query block: what one task holds.
CANDIDATES, QUERIES = 16384, 1024
#: More than any stage has tasks.
TASKS = 1 << 24
#: Score arrays are filled for so many candidates at a time, to stay in the cache.
TILE = 2048

_BLOCK = "block long, n int, width int, bytes int, ids binary, terms binary"


def integer_terms(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, terms): usable vectors with floor(scale * x) for each component x, as double."""
    v = F.col(vector_col)
    usable = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("terms")
    )


def _smallest(m: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as hold them."""
    lo, hi = int(m.min(initial=0)), int(m.max(initial=0))
    return m.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max))


def _pack(rows: int):
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, k, ids, terms = TaskContext.get().partitionId(), 0, [], []

        def out():
            width = max((len(t) for t in terms), default=0)
            m = np.zeros((len(terms), width), np.int64)
            for i, t in enumerate(terms):
                m[i, : len(t)] = t
            order = np.argsort(np.array(ids), kind="stable")
            m = _smallest(m[order])
            # the tasks' first blocks have the numbers 0, 1, 2 ..., then their second ones: dealt in turn, they spread evenly
            return pd.DataFrame({"block": [k * TASKS + part], "n": [len(ids)], "width": [width], "bytes": [m.itemsize], "ids": [np.array(ids, np.int64)[order].tobytes()], "terms": [m.tobytes()]})

        for f in frames:
            for i, t in zip(f["id"], f["terms"], strict=True):
                ids.append(i)
                terms.append(t)
                if len(ids) == rows:
                    yield out()
                    ids, terms, k = [], [], k + 1
        if ids:
            yield out()

    return pack


def _best(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Columns of each row's k best, of those that aren't its own, by partition selection; ids ascend, so the first of a tie are taken.

    Rows with own columns come first in no order; what is missing to k is -1.
    """
    n = scores.shape[1]
    at = np.full((len(scores), min(k, n)), -1)
    for mine in np.flatnonzero(own.any(1)):
        rest = np.flatnonzero(~own[mine])
        got = rest[np.lexsort((rest, ~scores[mine, rest]))[:k]]
        at[mine, : len(got)] = got
    rows = np.flatnonzero(~own.any(1))
    s = scores[rows]
    if n <= k:
        at[rows] = np.arange(n)
    elif len(rows):
        least = np.partition(s, n - k, axis=1)[:, n - k, None]
        pick = s > least
        ties = s == least
        pick |= ties & (np.cumsum(ties, 1) <= k - pick.sum(1)[:, None])
        at[rows] = np.nonzero(pick)[1].reshape(len(rows), k)
    return at


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of every query with every candidate, term by term through posting lists."""
    most = lambda m: max(int(m.max(initial=0)), -int(m.min(initial=0)))
    kind = np.int64 if most(queries) * most(candidates) * max(1, queries.shape[1]) >= 2**31 else np.int32
    scores = np.zeros((len(queries), len(candidates)), kind)
    queries, candidates = queries.astype(kind), candidates.astype(kind)
    step = np.empty(scores.shape, kind)
    for t in range(min(queries.shape[1], candidates.shape[1])):
        posting = np.flatnonzero(candidates[:, t])
        asks = np.flatnonzero(queries[:, t])
        if not len(posting) or not len(asks):
            continue
        if 2 * len(posting) > len(candidates):
            np.multiply(queries[:, t, None], np.ascontiguousarray(candidates[:, t])[None, :], out=step)
            scores += step
        else:
            scores[np.ix_(asks, posting)] += queries[asks, t, None] * candidates[posting, t][None, :]
    return scores


def _search(k: int):
    empty = pd.DataFrame({"query_block": [], "query_row": [], "query_id": [], "vec_id": [], "score": []}).astype("int64")

    def matrix(r, p=""):
        kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.int64}[r[p + "bytes"]]
        return np.frombuffer(r[p + "ids"], np.int64), np.frombuffer(r[p + "terms"], kind).reshape(r[p + "n"], r[p + "width"])

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.to_dict("records"):
                (q_ids, q), (c_ids, c) = matrix(r, "q_"), matrix(r)
                out = []
                for a in range(0, len(q_ids), 128):
                    mine, ids = q[a : a + 128], q_ids[a : a + 128]
                    none = np.zeros((len(ids), 0), np.int64)
                    best, who, real = none, none, none.astype(bool)
                    for b in range(0, len(c_ids), TILE):
                        own = c_ids[b : b + TILE]
                        s = accumulate(mine, c[b : b + TILE])
                        at = _best(s, own[None, :] == ids[:, None], k)
                        best = np.concatenate([best, np.take_along_axis(s, at, 1).astype(np.int64)], 1)
                        who, real = np.concatenate([who, own[at]], 1), np.concatenate([real, at >= 0], 1)
                        if best.shape[1] > k:
                            order = np.lexsort((who, ~best, ~real))[:, :k]
                            best, who, real = (np.take_along_axis(x, order, 1) for x in (best, who, real))
                    row = np.broadcast_to(np.arange(a, a + len(ids))[:, None], best.shape)[real]
                    out.append(pd.DataFrame({"query_block": r["q_block"], "query_row": row, "query_id": q_ids[row], "vec_id": who[real], "score": best[real]}))
                yield pd.concat(out) if out else empty

    return search


def top_k(queries: DataFrame, candidates: DataFrame, k: int = 20, query_rows: int = QUERIES, candidate_rows: int = CANDIDATES, slots: int = 12) -> DataFrame:
    """queries, candidates: (id long, terms array<long>). Returns query_id, rank from 1, vec_id, score."""
    spark = queries.sparkSession
    q = queries.mapInPandas(_pack(query_rows), _BLOCK).select(*[F.col(c).alias(f"q_{c}") for c in ("block", "n", "width", "bytes", "ids", "terms")])
    c = stored(candidates.mapInPandas(_pack(candidate_rows), _BLOCK), "blocks")
    # Blocks, not rows, are dealt: a candidate block goes to one slot, a query block to every slot; no more slots than blocks.
    slots = max(1, min(max(slots, partitions(spark)), c.count()))
    c = c.withColumn("slot", F.pmod("block", F.lit(TASKS)) + F.floor(F.col("block") / TASKS))
    c = c.withColumn("slot", F.pmod("slot", F.lit(slots)).cast("int")).repartition(slots, "slot")
    q = q.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).repartition(slots, "slot")
    pairs = c.join(q, "slot").drop("slot")
    found = pairs.mapInPandas(_search(k), "query_block long, query_row long, query_id long, vec_id long, score long")
    w = Window.partitionBy("query_block", "query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
