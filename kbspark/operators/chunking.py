"""Overlapping chunks, packed paragraphs, and chunks of parsed documents.

Both splitters are one pass over a text, Arrow batch by batch: their time follows the text's length.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.batches import ROWS
from ..functions.text import strip, table_text


def windows_of(text: str | None, size: int = 500, overlap: int = 100, most: int | None = None, gap_free: bool = False) -> list[str]:
    """Windows begin every size - overlap characters; a window ends at the first paragraph's end in its second half, if any.

    What lies between such an end and the next window's beginning is in no window, unless ``gap_free``: then a window begins where the one before
    ended, if that is earlier. ``most``: windows at most; what follows them is in none.
    """
    text = text or ""
    if len(text) <= size:
        return [text.strip()] if text.strip() else []
    step = size - (size // 4 if overlap >= size else overlap)
    parts = text.split("\n\n")
    own = [(p.strip(), k) for k, p in enumerate(parts)]
    pieces = [p + ("\n\n" if k < len(parts) - 1 else "") for p, k in own if p]
    ends, n = [], 0
    for p in pieces:
        n += len(p)
        ends.append(n)
    full, out, s, k = "".join(pieces), [], 0, 0
    while s < n and (most is None or k < most):
        e = min(s + size, n)
        at = bisect_right(ends, s + size / 2)
        if at < len(ends) and ends[at] <= e:
            e = ends[at]
        if chunk := full[s:e].strip():
            out.append(chunk)
        if e >= n:
            break
        s, k = min(s + step, e) if gap_free else s + step, k + 1
    return out


def packed_of(text: str | None, size: int = 500, hard: bool = True) -> list[str]:
    """Paragraphs put together while they fit; ``hard``: a longer piece is cut at every ``size`` characters."""
    done: list[list[str]] = []
    held = 0
    for p in (text or "").split("\n\n"):
        if not (p := p.strip()):
            continue
        if not done or held + len(p) > size:
            done.append([])
            held = 0
        done[-1].append(p)
        held += len(p) + 2
    out = ["\n\n".join(d) for d in done]
    return [c[a : a + size] for c in out for a in range(0, len(c), size)] if hard else out


def _lists(of):
    """Lists of ``of``, made of few rows at a time, so that a worker holds few texts as objects."""

    def run(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([pa.array(map(of, texts.slice(a, ROWS).to_pylist()), pa.list_(pa.string())) for a in range(0, max(1, len(texts)), ROWS)])

    return F.arrow_udf(run, "array<string>")


def window_chunks(text: Column, size: int = 500, overlap: int = 100, most: int | None = None, gap_free: bool = False) -> Column:
    return _lists(lambda t: windows_of(t, size, overlap, most, gap_free))(text)


def packed_paragraphs(text: Column, size: int = 500, hard: bool = True) -> Column:
    return _lists(lambda t: packed_of(t, size, hard))(text)


def chunked(rows: DataFrame, key: str, text: str, size: int = 500, overlap: int = 100) -> DataFrame:
    out = rows.select(key, F.posexplode(window_chunks(F.col(text), size, overlap)).alias("chunk_idx", "chunk"))
    return out.withColumn("chunk_id", F.concat(F.lit("doc_"), F.col(key).cast("string"), F.lit("_chunk_"), F.col("chunk_idx").cast("string")))


def document_chunks(docs: DataFrame, size: int = 500) -> DataFrame:
    """One chunk per document with a summary: (chunk_id, chunk_type, text, chip_category, document_type, title, tags)."""
    return docs.where("summary <> ''").select(
        F.concat(F.lit("doc_"), "file_path").alias("chunk_id"), F.lit("document").alias("chunk_type"), F.substring("summary", 1, size).alias("text"),
        "chip_category", "document_type", F.col("file_name").alias("title"), F.array_compact(F.array("chip_category", "document_type", "sub_category")).alias("tags"),
    )


def section_chunks(docs: DataFrame, size: int = 500, overlap: int = 100) -> DataFrame:
    s = docs.select("file_path", "chip_category", "document_type", F.posexplode("sections").alias("j", "s")).where(strip(F.col("s.content")) != "")
    c = s.select("*", F.posexplode(window_chunks(strip(F.col("s.content")), size, overlap)).alias("k", "text"))
    own = F.concat(F.lit("doc_"), "file_path", F.lit("_section_"), F.col("j").cast("string"))
    cut = F.length(strip(F.col("s.content"))) > size
    name = F.when(cut, F.concat(own, F.lit("_chunk_"), F.col("k").cast("string"))).otherwise(own)
    return c.select(name.alias("chunk_id"), F.lit("section").alias("chunk_type"), "text", "chip_category", "document_type", F.col("s.title").alias("title"), F.col("s.tags").alias("tags"))


def table_chunks(docs: DataFrame, most: int = 10) -> DataFrame:
    t = docs.select("file_path", "chip_category", "document_type", F.posexplode("tables").alias("j", "t"))
    name = F.concat(F.lit("doc_"), "file_path", F.lit("_table_"), F.col("j").cast("string"))
    text = table_text(F.col("t.headers"), F.col("t.rows"), most, "总共")
    return t.select(name.alias("chunk_id"), F.lit("table").alias("chunk_type"), text.alias("text"), "chip_category", "document_type", F.lit(None).cast("string").alias("title"), F.array("chip_category", F.lit("table")).alias("tags")).where("text <> ''")


def all_chunks(docs: DataFrame, size: int = 500, overlap: int = 100) -> DataFrame:
    good = docs.where("error is null")
    return document_chunks(good, size).unionByName(section_chunks(good, size, overlap)).unionByName(table_chunks(good))
