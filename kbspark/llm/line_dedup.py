"""Removal of repeated passages by overlapping three-line windows.

Every run of three consecutive lines that have a word is hashed (lines trimmed). The first occurrence
of each window over the whole corpus, by document id and position, stays; the lines of all later
occurrences are covered, overlapping ones merge, and covered lines go.

Only hashes move to find the repeated windows, and minima are taken on the map side, so a window
that a third of all rows share is one row per task there. Only windows found twice go on.

Passages are found where they make up three whole lines with words (or all lines of a text with fewer). One that begins and ends inside
lines, or fills fewer lines of a longer text, is outside the method.

Defined cases: lines are split by newline; lines without a word neither count nor match, and go when
the lines with words on both sides go; a document of one or two lines with words has one
window of them all (its hash can't equal a longer one's); null text stays null and empty stays
empty; a document whose every line goes keeps its row with an empty text; rows that share an id are
told apart by their text; equal rows (same id and text) are one document, kept or cut alike; a null id
comes before all others and stays null; extra columns are passed on, whatever their names (but one named as the result's own column gives way to it); n_chars, if there, is that of the new text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import forget, fresh, sliced, stored

WINDOW = 3


def _lines(text: bytes) -> tuple[list[bytes], list[int]]:
    """The lines, and the places of those with a word."""
    lines = text.split(b"\n")
    return lines, [i for i, x in enumerate(lines) if x.strip(b" \t\v\f\r")]


def _window_hashes(texts: list[bytes], width: int) -> list[np.ndarray]:
    out = []
    for lo, hi in words.batches(texts):
        part = []
        for t in texts[lo:hi]:
            lines, at = _lines(t)
            part.append([lines[i].strip(b" \t\v\f\r") for i in at])
        flat = [x for p in part for x in p]
        w = words.Words(flat, newline=True)
        h = w.hashes()
        begin = 0
        for p in part:
            own = h[begin : begin + len(p)]
            begin += len(p)
            out.append(words.windows(own, width) if len(p) >= width else words.windows(own, len(p)) + np.uint64(len(p)) if len(p) else np.zeros(0, np.uint64))
    return out


def _windows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            found = _window_hashes(words.as_bytes(b.column("text")), width)
            n = [len(x) for x in found]
            ids = np.repeat(b.column("doc_id").to_numpy(zero_copy_only=False), n)
            rows = np.repeat(b.column("row_hash").to_numpy(zero_copy_only=False), n)
            at = np.concatenate([np.arange(k) for k in n]) if n else np.zeros(0, int)
            h = np.concatenate(found).view(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(at.astype(np.int32))], ["h", "doc_id", "row_hash", "at"])

    return run


def cut(text: bytes, covered: list[int], width: int) -> bytes:
    """The text without the lines of the windows that begin at the given places (counted in lines with words)."""
    lines, at = _lines(text)
    gone = np.zeros(len(at) + 1, bool)
    for k in covered:
        gone[k : min(k + width, len(at))] = True
    keep = np.ones(len(lines), bool)
    for j, i in enumerate(at):
        if gone[j]:
            keep[i] = False
            nxt = at[j + 1] if j + 1 < len(at) else len(lines)
            if j + 1 >= len(at) or gone[j + 1]:
                keep[i:nxt] = False
    return b"\n".join(x for x, k in zip(lines, keep, strict=True) if k)


def _apply(names: list[str], covered_name: str, removed: str, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts, covered = b.column("text").to_pylist(), b.column(covered_name).to_pylist()
            new = [t if not c or t is None else cut(t.encode(), c, width).decode() for t, c in zip(texts, covered, strict=True)]
            gone = [0 if not c or t is None else len(_lines(t.encode())[1]) - len(_lines(x.encode())[1]) for t, x, c in zip(texts, new, covered, strict=True)]
            cols = [pa.array(new, pa.string()) if n == "text" else pa.array([None if t is None else len(t) for t in new], pa.int64()) if n == "n_chars" else b.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(gone, pa.int64())], [*names, removed])

    return run


def _numbered(column: F.Column) -> F.Column:
    """The id, null as the smallest number."""
    return F.coalesce(column.cast("long"), F.lit(-(1 << 63)))


def line_dedup(docs: DataFrame, width: int = WINDOW, removed: str = "_lines_removed") -> DataFrame:
    """docs: doc_id, text and any others. The same rows with new texts, and the column ``removed`` (long): lines with words that went."""
    docs = docs.drop(removed)
    own = docs.select(_numbered(F.col("doc_id")).alias("doc_id"), "text").withColumn("row_hash", F.xxhash64("text"))
    found = stored(own.mapInArrow(_windows(width), "h long, doc_id long, row_hash long, at int"), "windows")
    place = F.struct("doc_id", "row_hash", "at")
    twice = found.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("h", "first")
    later = found.join(twice, "h").where(place > F.col("first")).groupBy("doc_id", "row_hash").agg(F.collect_set("at").alias("covered"))
    names = docs.columns
    id_, row, covered = fresh(docs, "_id", "_row", "_covered")
    # the same join at every size: the texts are dealt by id whether few or many have covered lines
    later = stored(later.select(F.col("doc_id").alias(id_), F.col("row_hash").alias(row), F.array_sort("covered").alias(covered)), "covered")
    forget(docs.sparkSession, found)
    on = (_numbered(docs["doc_id"]) == F.col(id_)) & (F.xxhash64(docs["text"]) == F.col(row))
    joined = docs.join(later.hint("merge"), on, "left").select(*[docs[c] for c in names], covered)
    kinds = ", ".join(f"`{f.name}` {'long' if f.name == 'n_chars' else f.dataType.simpleString()}" for f in docs.schema)
    return joined.mapInArrow(_apply(names, covered, removed, width), f"{kinds}, `{removed}` long")
