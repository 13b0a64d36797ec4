"""Index builds as long tables: postings, TF-IDF, metadata, neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.batches import pieces
from ..functions.text import lists_of, terms, terms_of


def postings(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, term, n_terms): each document's distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            found = lists_of(b.column(1), terms_of)
            n = found.value_lengths()
            at = found.value_parent_indices()
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), found.flatten(), n.take(at)], names=["doc", "term", "n_terms"])

    return docs.select(F.col(key).alias("doc"), F.col(text).alias("text")).mapInArrow(run, f"doc {docs.schema[key].dataType.simpleString()}, term string, n_terms int")


def inverted(posts: DataFrame) -> DataFrame:
    """Terms by document frequency (the posting lists stay rows)."""
    return posts.groupBy("term").agg(F.count("*").alias("df"), F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))


def tfidf(posts: DataFrame, n_docs: DataFrame, few: bool = False) -> DataFrame:
    """Weight: 1 / terms of the document * ln(N / (df + 1)); n_docs: one row, column n. ``few``: the postings have few different terms, whose frequencies are broadcast."""
    df = posts.groupBy("term").agg(F.count("*").alias("df"))
    return posts.join(F.broadcast(df) if few else df, "term").crossJoin(F.broadcast(n_docs)).select("doc", "term", (F.ln(F.col("n") / (F.col("df") + 1)) / F.col("n_terms")).alias("weight"))


def metadata_index(docs: DataFrame, fields: list[str]) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.trim(F.col(f).cast("string")).alias("value")) for f in fields])).alias("x")
    return docs.select(pairs).select("x.*").where("value is not null and value <> '' and value <> '0'").groupBy("field", "value").agg(F.count("*").alias("n"))


def indexed_text(docs: DataFrame, key: str = "file_path") -> DataFrame:
    """(doc, text) of parsed documents: summary, file name, the sections' titles and contents, the tables' headers and first three rows."""
    said = lambda c: F.coalesce(c, F.lit(""))
    sections = F.transform("sections", lambda s: F.concat_ws(" ", s["title"], s["content"]))
    tables = F.transform("tables", lambda t: F.concat_ws(" ", F.array_join(t["headers"], " "), F.array_join(F.transform(F.slice(t["rows"], 1, 3), lambda r: F.array_join(r, " ")), " ")))
    return docs.select(F.col(key).alias("doc"), F.concat_ws(" ", said(F.col("summary")), said(F.col("file_name")), F.array_join(sections, " "), F.array_join(tables, " ")).alias("text"))


def forward(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, terms): each document's distinct terms in order."""
    return docs.select(F.col(key).alias("doc"), terms(F.col(text)).alias("terms"))


#: Documents of a cell in which positions are counted.
CELL = 10_000
#: Up to so many documents, all pairs are compared.
ALL_PAIRS = 100


def positions(docs: DataFrame, key: str) -> DataFrame:
    """(key, position): 0, 1, 2 ... in the order of a numeric key. Counted in cells of the key, of which only the sizes meet in one place."""
    rows = docs.select(key).withColumn("cell", F.floor(F.col(key) / CELL))
    sizes = rows.groupBy("cell").agg(F.count("*").alias("n"))
    before = sizes.select("cell", F.coalesce(F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = rows.withColumn("within", F.row_number().over(Window.partitionBy("cell").orderBy(key)) - 1)
    return own.join(before, "cell").select(key, (F.col("before") + F.col("within")).alias("position"))


def banded_neighbours(docs: DataFrame, key: str, text: str, band: int = 10, k: int = 5) -> DataFrame:
    """(a, b, score, rank): the k most similar (cosine of TF-IDF) documents within ``band`` positions in the key's order; of ALL_PAIRS documents or fewer, of all.

    A term's weight in a document is its idf over the document's number of terms, which cancels in the cosine. Blocks of documents, each with
    those within the band on both sides, are worked on one at a time: equal terms of neighbours are found in order of term and position.
    """
    docs = docs.select(F.col(key).alias("doc"), F.col(text).alias("text"))
    n = docs.count()
    if n <= ALL_PAIRS:
        band = max(1, n)
    at = positions(docs, "doc")
    posts = postings(docs.join(at, "doc"), "position", "text")
    df = posts.groupBy("term").agg(F.count("*").alias("df"))
    squared = F.pow(F.ln(F.lit(float(n)) / (F.col("df") + 1)), 2)
    none = at.select("position", "doc", F.lit(None).cast("string").alias("term"), F.lit(0.0).alias("w"))
    kind = at.schema["doc"].dataType
    held = none.unionByName(posts.join(df, "term").select(F.col("doc").alias("position"), F.lit(None).cast(kind).alias("doc"), "term", squared.alias("w")))
    blocks = F.sequence(F.floor(F.greatest(F.col("position") - band, F.lit(0)) / BLOCK), F.floor((F.col("position") + band) / BLOCK))
    held = held.select(F.explode_outer(blocks).alias("block"), "position", "doc", "term", "w")
    return held.groupBy("block").applyInArrow(_block_neighbours(band, k), f"a {kind.simpleString()}, b {kind.simpleString()}, score double, rank int")


#: Documents of a block whose neighbours are found together.
BLOCK = 500


def _block_neighbours(band: int, k: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        block, place = rows["block"][0].as_py(), rows["position"].to_numpy()
        first = block * BLOCK - band
        width = BLOCK + 2 * band
        term = rows["term"].combine_chunks()
        own = term.is_null().to_numpy(zero_copy_only=False)
        # where each place's document is among the rows; -1: there is none
        row = np.full(width, -1)
        row[place[own] - first] = np.flatnonzero(own)
        code = term.dictionary_encode().indices.fill_null(-1).to_numpy()[~own]
        i, w = place[~own] - first, rows["w"].to_numpy()[~own]
        order = np.lexsort((i, code))
        code, i, w = code[order], i[order], w[order]
        dots = np.zeros(width * (band + 1))
        for step in range(1, min(band, len(i) - 1) + 1):
            apart = i[step:] - i[:-step]
            same = (code[step:] == code[:-step]) & (apart <= band)
            if not same.any():
                break
            dots += np.bincount(i[:-step][same] * (band + 1) + apart[same], w[step:][same], len(dots))
        dots = dots.reshape(width, band + 1)
        norm = np.sqrt(np.bincount(i, w, width))
        p = np.flatnonzero((row >= 0) & (np.arange(width) >= band) & (np.arange(width) < band + BLOCK))
        apart = np.array([d for d in range(-band, band + 1) if d])
        q = p[:, None] + apart
        # a pair's product is kept at the earlier of the two
        dot, size = dots[np.minimum(p[:, None], q), np.abs(apart)], norm[p][:, None] * norm[q]
        score = np.divide(dot, size, out=np.zeros_like(dot), where=size > 0)
        ranked = np.where(row[q] >= 0, np.round(score, 12), -np.inf)
        best = np.argsort(-ranked, axis=1, kind="stable")[:, :k]
        kept = np.take_along_axis(ranked, best, 1) > -np.inf
        rank = np.broadcast_to(np.arange(1, best.shape[1] + 1, dtype=np.int32), best.shape)
        names = rows["doc"].combine_chunks()
        a = np.broadcast_to(row[p][:, None], best.shape)[kept]
        b = row[np.take_along_axis(q, best, 1)][kept]
        return pa.table({"a": names.take(pa.array(a)), "b": names.take(pa.array(b)), "score": np.take_along_axis(score, best, 1)[kept], "rank": rank[kept]})

    return run


def value_index(docs: DataFrame, column: str, key: str = "doc_id") -> DataFrame:
    """(value, doc) without nulls and blanks; array columns give a row per element. Posting lists stay rows."""
    c = F.explode(column) if docs.schema[column].dataType.typeName() == "array" else F.col(column).cast("string")
    return docs.select(c.alias("value"), F.col(key).alias("doc")).where(F.trim("value") != "").distinct()


def hierarchical_index(docs: DataFrame, key: str = "file_path") -> DataFrame:
    """(level, section_type, doc) of parsed documents; sections without a level are under "None"."""
    s = docs.select(F.col(key).alias("doc"), F.explode("sections").alias("s"))
    return s.select(F.coalesce(F.col("s.level").cast("string"), F.lit("None")).alias("level"), "s.section_type", "doc").distinct()


def index_stats(posts: DataFrame, docs: DataFrame) -> DataFrame:
    """One row: documents, terms, postings, terms a document, documents a term."""
    by_term = posts.groupBy("term").agg(F.count("*").alias("df")).agg(F.count("*").alias("n_terms"), F.coalesce(F.sum("df"), F.lit(0)).alias("n_postings"), F.avg("df").alias("docs_per_term"))
    n = docs.agg(F.count("*").alias("n_docs"))
    return n.crossJoin(F.broadcast(by_term)).withColumn("terms_per_doc", F.try_divide(F.col("n_postings"), F.col("n_docs")))


def full_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """One row of a knowledge base's indexes (see ``build``): numbers of terms, keywords, categories, types and metadata fields, terms a document, neighbours a document."""
    count = lambda name, column: tables[name].agg(F.count_distinct(column).alias("n"))
    parts = {
        "total_terms": count("postings", "term"), "total_keywords": count("keywords", "value"), "total_categories": count("categories", "value"), "total_document_types": count("types", "value"),
        "total_metadata_fields": count("metadata", "field"), "avg_terms_per_doc": tables["postings"].groupBy("doc").count().agg(F.avg("count").alias("n")),
        "avg_similarity_connections": tables["similarity"].groupBy("a").count().agg(F.avg("count").alias("n")),
    }
    out = None
    for name, one in parts.items():
        one = one.withColumnRenamed("n", name)
        out = one if out is None else out.crossJoin(F.broadcast(one))
    return out


INDEXES = ("postings", "tfidf", "keywords", "categories", "types", "hierarchy", "metadata", "similarity")
FIELDS = ["chip_category", "document_type", "sub_category", "file_name", "file_path", "file_size", "created_time", "content_hash", "language"]


def build(docs: DataFrame) -> dict[str, DataFrame]:
    """All indexes of parsed documents, as long tables by document path; documents are numbered in the order of their paths for the similarity index."""
    text = indexed_text(docs)
    posts = postings(text, "doc")
    # paths have no number of their own: documents are counted by path in cells of the path's first characters
    numbered = _path_positions(text)
    near = banded_neighbours(numbered, "position", "text")
    name = lambda c: numbered.select(F.col("position").alias(c), F.col("doc").alias(c + "_doc"))
    near = near.join(name("a"), "a").join(name("b"), "b").select(F.col("a_doc").alias("a"), F.col("b_doc").alias("b"), "score", "rank")
    return {
        "postings": posts, "tfidf": tfidf(posts, docs.agg(F.count("*").alias("n"))), "keywords": value_index(docs, "keywords", "file_path"), "categories": value_index(docs, "chip_category", "file_path"),
        "types": value_index(docs, "document_type", "file_path"), "hierarchy": hierarchical_index(docs), "metadata": metadata_postings(docs, FIELDS, "file_path"), "similarity": near,
    }


def _path_positions(rows: DataFrame) -> DataFrame:
    """rows with a position by doc, counted in cells of one folder each."""
    r = rows.withColumn("cell", F.regexp_extract("doc", "^(.*)/[^/]*$", 1))
    sizes = r.groupBy("cell").agg(F.count("*").alias("n"))
    before = sizes.select("cell", F.coalesce(F.sum("n").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    own = r.withColumn("within", F.row_number().over(Window.partitionBy("cell").orderBy("doc")) - 1)
    return own.join(before, "cell").withColumn("position", F.col("before") + F.col("within")).drop("cell", "before", "within")


def metadata_postings(docs: DataFrame, fields: list[str], key: str = "doc_id") -> DataFrame:
    """(field, value, doc) of every field of a document that has a value."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.trim(F.col(f).cast("string")).alias("value")) for f in fields])).alias("x")
    return docs.select(pairs, F.col(key).alias("doc")).select("x.*", "doc").where("value is not null and value <> '' and value <> '0'")


def save(tables: dict[str, DataFrame], folder: str) -> None:
    """Every index as Parquet, and what a search may ask for as one small file."""
    import json

    from ..sources.sinks import write_text
    from .search import CAPABILITIES, SEARCHES

    for name in INDEXES:
        tables[name].write.mode("overwrite").parquet(f"{folder}/{name}")
    spark = tables["postings"].sparkSession
    back = load(spark, folder)
    values = lambda name, column, most=None: [r[0] for r in (back[name].select(column).distinct().orderBy(column).limit(most or 1000)).collect()]
    told = {
        "features": SEARCHES, "search_capabilities": CAPABILITIES, "index_statistics": full_stats(back).first().asDict(), "available_categories": values("categories", "value"),
        "available_document_types": values("types", "value"), "available_metadata_fields": ["metadata_" + f for f in values("metadata", "field")], "top_keywords": values("keywords", "value", 50),
    }
    write_text(spark, f"{folder}/search_config.json", json.dumps(told, ensure_ascii=False, indent=1))


def load(spark, folder: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in INDEXES}


def top_terms(posts: DataFrame, k: int = 50) -> DataFrame:
    return posts.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(k)
