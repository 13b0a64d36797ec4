"""Best-fit packing of token sequences, certified by lower bounds and repaired by exchange.

Pieces (documents, the longer ones cut) are dealt to partitions of bounded size. Each partition
packs its pieces best-fit decreasing and compares its bins with the largest of a family of
dual-feasible-function lower bounds. A partition that meets its bound is certified and final. The
others keep their full bins and give the pieces of the bins with gaps to an exchange: these are
dealt anew, to fewer partitions, and packed again best-fit decreasing, until none is left uncertified
that has another one to exchange with, or a round saves nothing, ROUNDS rounds at most (a cap on effort: every piece is in a sequence all the same). A round that would need more bins
than it was given keeps what it was given.

Tasks hold lengths and numbers only (24 bytes a piece), GROUP pieces each; texts don't move.

Defined cases: null text is empty, and an empty document is the end token alone; a document of more
than ``capacity`` tokens is cut into full pieces and a rest; equal lengths are taken in id order;
repeated ids are documents of their own with the same id (pieces carry a row number within the
partition); null ids are ids like any other and stay null; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sliced, stored

CAPACITY, END = 2048, 0
#: Pieces that one task packs.
GROUP = 50_000
#: Rounds of exchange at most; each has half the partitions of the one before.
ROUNDS = 4
#: Distinct pieces of text whose ids a Python worker remembers, and characters that are cut together.
PIECES_KEPT, TOGETHER = 800_000, 1 << 20
#: The tokenizer file's rule (fixed value), and the same for lower-cased text that PLAIN matches.
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9 \n\t]+").findall
PLAIN = re.compile(r"[ -~\n\tÀ-ÖØ-öø-ÿ]*")

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, piece_key long"


def tokenizer_path() -> str:
    """The public word tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordIds:
    """A tokenizer's ids of whole texts, as little-endian bytes, from the ids of their pieces.

    The tokenizer drops white space and never merges across it, so a text's ids are its words' ids. Words
    of printable ASCII and Latin-1 letters only are cut further, as the tokenizer's own rule cuts them
    (contractions, runs of letters, single digits, runs of the rest), and a piece is encoded once: there are far
    fewer of these than of words with their punctuation. All other words are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # a task has one core
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.cuts = _cuts_like(self.tokenizer)
        self.known: dict[str, bytes] = {}

    def _pieces(self, text: str) -> list[str]:
        if self.cuts and "<|" not in text and PLAIN.fullmatch(text):
            return CUT(text.lower())
        out: list[str] = []
        for w in text.replace("\n", " ").split(" "):
            if self.cuts and "<|" not in w and PLAIN.fullmatch(w):
                out += CUT(w.lower())
            else:
                out.append(w)
        return out

    def _learn(self, new: list[str]) -> None:
        for a in range(0, len(new), 20_000):
            part = new[a : a + 20_000]
            for t, e in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
                self.known[t] = array("I", e.ids).tobytes()

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; texts are taken together up to TOGETHER characters."""
        lo = 0
        while lo < len(texts):
            hi, size = lo, 0
            while hi < len(texts) and (hi == lo or size + len(texts[hi]) <= TOGETHER):
                size, hi = size + len(texts[hi]), hi + 1
            cut = [self._pieces(t) for t in texts[lo:hi]]
            if len(self.known) > PIECES_KEPT:
                self.known.clear()
            self._learn(list(set().union(*cut).difference(self.known)))
            at = self.known.__getitem__
            for c in cut:
                yield b"".join(map(at, c))
            lo = hi


@cache
def word_ids(path: str) -> WordIds:
    """One per Python worker: its pieces serve the worker's later tasks as well."""
    return WordIds(path)


def _cuts_like(tokenizer) -> bool:
    """Whether the tokenizer lower-cases and cuts words by the rule of CUT."""
    said = json.loads(tokenizer.to_str())
    rules = [p.get("pattern", {}).get("Regex") for p in (said.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    kinds = [n["type"] for n in (said.get("normalizer") or {}).get("normalizers", [])]
    return rules[:1] == [RULE] and kinds == ["NFC", "Replace", "Lowercase"]


def tokenize(path: str, capacity: int, end: int):
    """Rows of pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        key = TaskContext.get().partitionId() << 40
        last = np.array([end], "<u4").tobytes()
        for b in sliced(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            out: list[tuple] = []
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), word_ids(path).ids(texts), strict=True):
                ids += last
                n = len(ids) // 4
                for p, s in enumerate(range(0, n, capacity)):
                    out.append((doc_id, p, s, min(capacity, n - s), crc32(ids[4 * s : 4 * (s + capacity)]), key))
                    key += 1
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), *[pa.int64()] * 4), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32", "piece_key"])

    return run


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest of the bounds that dual feasible functions give.

    u_k counts the floor((k + 1) x / C) of each x (x itself if that divides), over k; the threshold
    functions count x > C - e as whole bins and drop x < e. Each maps lengths so that what fits in a
    bin sums to one at most; so the sum over all lengths is a lower bound.
    """
    if not len(lengths):
        return 0
    size, count = np.unique(lengths, return_counts=True)
    best = -(-int((size * count).sum()) // capacity)
    for k in range(1, 33):
        up = (k + 1) * size
        scaled = np.where(up % capacity == 0, size * k, (up // capacity) * capacity)
        best = max(best, -(-int((scaled * count).sum()) // (k * capacity)))
    at = np.searchsorted(size, np.arange(1, capacity // 2 + 1))
    sums = np.concatenate([[0], np.cumsum(size * count)])
    counts = np.concatenate([[0], np.cumsum(count)])
    e = np.arange(1, capacity // 2 + 1)
    large = np.searchsorted(size, capacity - e, "right")
    whole = counts[-1] - counts[large]
    rest = sums[large] - sums[np.minimum(at, large)]
    return max(best, int((whole - (-rest // capacity)).max()))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """A bin number for each length; equal lengths in the order given."""
    bins = np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_ = 0  # bit r is set if a bin has room r
    n = 0
    order = np.argsort(-lengths, kind="stable")
    for i, x in zip(order.tolist(), lengths[order].tolist(), strict=True):
        fits = open_ >> x
        if fits:
            r = x + (fits & -fits).bit_length() - 1
            k = stacks[r].pop()
            if not stacks[r]:
                open_ ^= 1 << r
        else:
            r, k, n = capacity, n, n + 1
        bins[i] = k
        if r > x:
            if not stacks[r - x]:
                open_ |= 1 << (r - x)
            stacks[r - x].append(k)
    return bins


def _pack(capacity: int, round_: int):
    """Pack a group's pieces; rows get sequence_id and final (false: to be exchanged)."""

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["length", "doc_id", "piece", "piece_key"], ascending=[False, True, True, True], kind="stable")
        lengths = f["length"].to_numpy()
        bins = best_fit_decreasing(lengths, capacity)
        n = int(bins.max()) + 1
        old = f["sequence_id"].to_numpy()
        if round_ and n > len(np.unique(old)):
            return f.assign(final=True)
        filled = np.bincount(bins, lengths)
        certified = n <= lower_bound(lengths, capacity)
        first = (round_ << 58) | (int(f["grp"].iloc[0]) << 24)
        return f.assign(sequence_id=first + bins, final=certified | (filled[bins] == capacity))

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """docs: (doc_id, text). Rows of doc_id, piece, start, length, ids_crc32, piece_key, written once."""
    return stored(docs.select("doc_id", "text").mapInArrow(tokenize(tokenizer, capacity, end), _PIECE), "pieces")


def best_fit_pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of docs (doc_id, text)."""
    rows = pieces(docs, tokenizer, capacity, end)
    small = rows.where(F.col("length") < capacity)
    done = rows.where(F.col("length") == capacity).withColumn("sequence_id", F.col("piece_key") + F.lit(1 << 62))
    keep = ["doc_id", "piece", "length", "piece_key", "sequence_id"]
    groups = max(1, -(-small.count() // GROUP))
    todo = small.withColumn("sequence_id", F.lit(0).cast("long")).select(*keep)
    packed, waste = [], None
    for k in range(ROUNDS):
        dealt = todo.withColumn("grp", F.pmod(F.xxhash64("piece_key", F.lit(k)), F.lit(groups)).cast("int") if k == 0 else F.pmod(F.xxhash64("sequence_id", F.lit(k)), F.lit(groups)).cast("int"))
        out = stored(dealt.groupBy("grp").applyInPandas(_pack(capacity, k), "doc_id long, piece int, length long, piece_key long, sequence_id long, grp int, final boolean"), "packed")
        packed.append(out.where("final").select("piece_key", "sequence_id"))
        todo = out.where("not final").select(*keep)
        left = todo.agg(F.count("*").alias("n"), F.countDistinct("sequence_id").alias("bins")).first()
        if not left.n or groups == 1 or (waste is not None and left.bins >= waste):
            break
        waste, groups = left.bins, max(1, min(groups // 2, -(-left.n // GROUP)))
    packed.append(todo.select("piece_key", "sequence_id"))
    at = packed[0]
    for p in packed[1:]:
        at = at.unionByName(p)
    from pyspark.sql import Window

    full = done.select(*[c for c in rows.columns], "sequence_id").withColumn("offset", F.lit(0).cast("long"))
    # at most `capacity` pieces are in one sequence
    w = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece", "piece_key")
    rest = small.join(at, "piece_key").withColumn("offset", F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, -1)))
    rest = rest.withColumn("offset", F.coalesce("offset", F.lit(0).cast("long")))
    return full.unionByName(rest.select(*full.columns)).drop("piece_key")
