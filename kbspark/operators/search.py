"""Dense search: cosine, threshold, filters, boosts, order."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import indexes


@dataclass(frozen=True)
class SearchConfig:
    top_k: int = 10
    score_threshold: float = 0.3
    keyword_boost: float = 1.2


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def vector_literal(vector: list[float]) -> Column:
    """A constant array, made of one literal however long it is."""
    return F.from_json(F.lit(json.dumps([float(x) for x in vector])), "array<double>")


def search(rows: DataFrame, query: list[float], config: SearchConfig = SearchConfig(), filters: dict | None = None, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The query's top rows: filters are pushed below the scoring, ties go to the smaller id."""
    for name, value in (filters or {}).items():
        if name in rows.columns:
            rows = rows.where(F.col(name).isin(*value) if isinstance(value, (list, tuple)) else F.col(name) == value)
    q = vector_literal(query)
    scored = rows.withColumn("score", cosine(F.col(vector), q)).where(F.col("score") >= config.score_threshold)
    return scored.orderBy(F.desc("score"), id_col).limit(config.top_k)


#: Rows of a block of vectors.
BLOCK = 4096


def _blocks(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """Unit vectors by the block: (ids array, m binary, width, block)."""
    kind = rows.schema[key].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            f = f[[v is not None for v in f["v"]]]
            for width, part in f.groupby(f["v"].map(len)):
                for a in range(0, len(part), BLOCK):
                    own = part.iloc[a : a + BLOCK]
                    m = np.array(own["v"].tolist(), float).reshape(len(own), width)
                    norm = np.linalg.norm(m, axis=1)
                    m[norm > 0] /= norm[norm > 0, None]
                    yield pd.DataFrame({"ids": [own["k"].tolist()], "m": [m.tobytes()], "width": [width]})

    out = rows.select(F.col(key).alias("k"), F.col(vector).alias("v")).mapInPandas(run, f"ids array<{kind}>, m binary, width int")
    return out


def nearest(queries: DataFrame, rows: DataFrame, query_key: str, key: str, k: int = 10, vector: str = "embedding", slots: int | None = None) -> DataFrame:
    """(query_key, key, score, rank): each query's k most similar rows by cosine, its own key left out, ties to the smaller key.

    Exact: a block of rows goes to one slot, a block of queries to all of them, and each pair of blocks is one matrix product.
    """
    spark = rows.sparkSession
    slots = slots or max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kinds = queries.schema[query_key].dataType.simpleString(), rows.schema[key].dataType.simpleString()
    q = _blocks(queries, query_key, vector).select(F.col("ids").alias("q_ids"), F.col("m").alias("q_m"), "width", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"))
    c = _blocks(rows, key, vector).withColumn("slot", F.pmod(F.xxhash64("m"), F.lit(slots)).cast("int"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.to_dict("records"):
                a, b = (np.frombuffer(r[x]).reshape(-1, r["width"]) for x in ("q_m", "m"))
                s = np.round(a @ b.T, 12)
                ids = np.array(r["ids"])
                rank = np.argsort(ids, kind="stable")
                for i, own in enumerate(r["q_ids"]):
                    at = rank[ids[rank] != own]
                    at = at[np.argsort(-s[i, at], kind="stable")[:k]]
                    yield pd.DataFrame({"q": [own] * len(at), "k": ids[at], "score": s[i, at]})

    found = c.join(q, ["slot", "width"]).mapInPandas(run, f"q {kinds[0]}, k {kinds[1]}, score double")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "k")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(F.col("q").alias(query_key), F.col("k").alias(key), "score", "rank")


def keyword_boost(score: Column, text: Column, query_tokens: list[str], factor: float = 1.2) -> Column:
    q = F.array(*[F.lit(t) for t in query_tokens])
    hits = F.size(F.array_intersect(q, F.array_distinct(F.split(F.lower(text), " "))))
    return score * (1 + factor * hits / max(1, len(query_tokens)))


def type_weight(score: Column, kind: Column) -> Column:
    return score * F.when(kind == "sections", 1.1).when(kind == "tables", 0.9).otherwise(1.0)


FUZZY, PRECISE = SearchConfig(score_threshold=0.1), SearchConfig(top_k=5, score_threshold=0.5)
# fixed values: words of a query that favour a type of document
TYPE_WORDS = {"datasheet": ["数据手册", "规格", "参数"], "user manual": ["用户手册", "使用说明", "操作指南"], "application": ["应用", "实例", "案例"], "troubleshooting": ["故障", "问题", "排除", "解决"]}


def metadata_boost(score: Column, query: str, tokens: list[str], file_name: Column, category: Column, doc_type: Column) -> Column:
    """1.1 for a query token in the file's name, 1.2 for the category in the query, 1.15 for a type the query hints at."""
    q = F.lit(query.lower())
    name, cat, kind = (F.lower(F.coalesce(c, F.lit(""))) for c in (file_name, category, doc_type))
    named = F.lit(False)
    for t in tokens:
        named = named | F.contains(name, F.lit(t.lower()))
    hinted = F.lit(False)
    for k, ws in TYPE_WORDS.items():
        if any(w in query.lower() for w in ws):
            hinted = hinted | F.contains(kind, F.lit(k))
    times = lambda cond, x: F.when(cond, x).otherwise(1.0)
    return score * times(named, 1.1) * times((cat != "") & F.contains(q, cat), 1.2) * times(hinted, 1.15)


def length_norm(rows: DataFrame, text: str = "text", score: str = "score") -> DataFrame:
    """Scores of texts much shorter or longer than the results' mean are lowered; the mean is one broadcast row."""
    mean = rows.agg(F.avg(F.length(text)).alias("_mean"))
    n = F.length(F.col(text))
    factor = F.when(n < 0.3 * F.col("_mean"), 0.95).when(n > 3 * F.col("_mean"), 0.98).otherwise(1.0)
    return rows.crossJoin(F.broadcast(mean)).withColumn(score, F.col(score) * factor).drop("_mean")


def similar(rows: DataFrame, key, config: SearchConfig = SearchConfig(top_k=5, score_threshold=-2.0), id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The rows nearest to the row ``key``, itself left out by id; no rows if there is none."""
    own = rows.where(F.col(id_col) == key).select(vector).first()
    others = rows.where(F.col(id_col) != key)
    return search(others, own[0], config, None, id_col, vector) if own else others.withColumn("score", F.lit(0.0)).limit(0)


def fulltext(weights: DataFrame, query_terms: DataFrame, k: int | None = 10) -> DataFrame:
    """(doc, score, n_matched) by the sum of the query terms' weights; weights: (doc, term, weight), query_terms: (term)."""
    hits = weights.join(query_terms.select("term").distinct(), "term", "left_semi")
    return _summed(hits, k)


def _summed(hits: DataFrame, k: int | None) -> DataFrame:
    out = hits.groupBy("doc").agg(F.round(F.sum("weight"), 9).alias("score"), F.count("*").alias("n_matched"))
    return out if k is None else out.orderBy(F.desc("score"), "doc").limit(k)


def fulltext_of(posts: DataFrame, n_docs: DataFrame, query_terms: DataFrame, k: int | None = 10) -> DataFrame:
    """``fulltext`` from postings: only the query's terms, which are few and broadcast, are counted and weighed."""
    asked = F.broadcast(query_terms.select("term").distinct())
    return _summed(indexes.tfidf(posts.join(asked, "term", "left_semi"), n_docs, few=True), k)


def keyword(keywords: DataFrame, query: str, fuzzy: bool = False) -> DataFrame:
    """Documents, once each, of which a keyword is the query, or holds it; keywords: (doc, keyword)."""
    hit = F.lower("keyword") == query.lower()
    if fuzzy:
        hit = hit | F.contains(F.lower("keyword"), F.lit(query.lower()))
    return keywords.where(hit).groupBy("doc").agg(F.lit(1.0).alias("score"), F.sort_array(F.collect_set("keyword")).alias("matched"))


def metadata(docs: DataFrame, query: str, id_col: str = "doc_id") -> DataFrame:
    """``field:value``; an unknown field finds nothing."""
    field, _, value = query.partition(":")
    found = docs.where(F.trim(F.col(field).cast("string")) == value.strip()) if field in docs.columns else docs.limit(0)
    return found.select(F.col(id_col).alias("doc"), F.lit(1.0).alias("score"))


def multi_criteria(parts: list[tuple[DataFrame, float]], k: int = 10) -> DataFrame:
    """Weighted sum of several searches' (doc, score)."""
    whole = None
    for rows, weight in parts:
        own = rows.select("doc", (F.col("score") * weight).alias("score"))
        whole = own if whole is None else whole.unionByName(own)
    return whole.groupBy("doc").agg(F.round(F.sum("score"), 9).alias("score")).orderBy(F.desc("score"), "doc").limit(k)


# Queries in words


#: What a chunk kind's results weigh, and the order of equal scores.
KINDS = ("documents", "sections", "tables")


def tokens(query: str) -> list[str]:
    """A query's distinct lower-case words."""
    return list(dict.fromkeys(query.lower().split()))


def prepared_query(spark, query: str | None) -> str | None:
    """Normalised, with synonyms; None if blank."""
    from ..functions.text import expanded_query, normalised_query

    if not query or not query.strip():
        return None
    return spark.createDataFrame([(query,)], "q string").select(expanded_query(normalised_query(F.col("q"))).alias("q")).first().q


def reranked(rows: DataFrame, query: str, score: str = "score") -> DataFrame:
    """Type weight, then metadata boosts, then length normalisation; no rows pass as they are."""
    out = rows.withColumn(score, type_weight(F.col(score), F.col("chunk_type")))
    out = out.withColumn(score, metadata_boost(F.col(score), query, tokens(query), F.col("file_name"), F.col("chip_category"), F.col("document_type")))
    return length_norm(out, "text", score)


def search_text(rows: DataFrame, query: str, vector: list[float], config: SearchConfig = SearchConfig(), kinds: tuple[str, ...] | None = None, rerank: bool = True, **filters) -> DataFrame:
    """One query in words over embedded chunks: chunk_id, chunk_type, text, file_name, chip_category, document_type, embedding.

    Filters and kinds are pushed below the scoring; the threshold is on the plain cosine; then keywords, reranking, order and
    top-k. A blank query, and a vector of length 0, find nothing. Equal scores go by kind, then by chunk_id.
    """
    out = rows.where(F.col("chunk_type").isin(*kinds)) if kinds else rows
    for name, value in filters.items():
        # a kind that has no such column passes
        if name in out.columns:
            out = out.where(F.col(name).isin(*value) if isinstance(value, (list, tuple)) else F.col(name) == value)
    if not query or not query.strip() or not any(vector):
        return out.withColumn("score", F.lit(0.0)).limit(0)
    q = vector_literal(vector)
    return _boosted(out.withColumn("score", cosine(F.col("embedding"), q)).where(F.col("score") >= config.score_threshold), query, config, rerank)


def search_sparse(rows: DataFrame, vectors: DataFrame, query: str, vector: list[float], config: SearchConfig = SearchConfig(), rerank: bool = True) -> DataFrame:
    """``search_text`` over chunks without an embedding column and their vectors as rows (chunk_id, index, weight) of length 1; only the query's places are read of them."""
    size = math.sqrt(math.fsum(x * x for x in vector))
    own = [(i, x / size) for i, x in enumerate(vector) if x]
    if not query or not query.strip() or not own:
        return rows.withColumn("score", F.lit(0.0)).limit(0)
    asked = rows.sparkSession.createDataFrame(own, "index int, asked double")
    dot = F.sum(F.col("weight") * F.col("asked"))
    scored = vectors.join(F.broadcast(asked), "index").groupBy("chunk_id").agg(dot.alias("score")).where(F.col("score") >= config.score_threshold)
    return _boosted(rows.join(scored, "chunk_id"), query, config, rerank)


def _boosted(out: DataFrame, query: str, config: SearchConfig, rerank: bool) -> DataFrame:
    out = out.withColumn("score", keyword_boost(F.col("score"), F.col("text"), tokens(query), config.keyword_boost))
    if rerank:
        out = reranked(out, query)
    at = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("chunk_type"))
    return out.orderBy(F.desc("score"), at, "chunk_id").limit(config.top_k)


@dataclass
class Searcher:
    """Searches over embedded chunks; ``embed`` makes a query's vector. A search's settings are its own and change no other's."""

    rows: DataFrame
    embed: object
    config: SearchConfig = SearchConfig()
    rerank: bool = True

    def search(self, query: str, kinds: tuple[str, ...] | None = None, config: SearchConfig | None = None, **filters) -> DataFrame:
        ready = prepared_query(self.rows.sparkSession, query)
        return search_text(self.rows, ready or "", self.embed(ready) if ready else [], config or self.config, kinds, self.rerank, **filters)

    def by_category(self, query: str, category: str, top_k: int = 10) -> DataFrame:
        return self.search(query, KINDS[:2], SearchConfig(top_k, self.config.score_threshold, self.config.keyword_boost), chip_category=category)

    def by_document_type(self, query: str, kind: str, top_k: int = 10) -> DataFrame:
        return self.search(query, KINDS[:2], SearchConfig(top_k, self.config.score_threshold, self.config.keyword_boost), document_type=kind)

    def fuzzy(self, query: str, top_k: int = 10) -> DataFrame:
        return self.search(query, None, SearchConfig(top_k, FUZZY.score_threshold, self.config.keyword_boost))

    def precise(self, query: str, top_k: int = 5) -> DataFrame:
        return self.search(query, None, SearchConfig(top_k, PRECISE.score_threshold, self.config.keyword_boost))

    def multi_modal(self, query: str, include_tables: bool = True, top_k: int = 10) -> DataFrame:
        return self.search(query, KINDS if include_tables else KINDS[:2], SearchConfig(top_k, self.config.score_threshold, self.config.keyword_boost))

    def similar(self, chunk_id, kind: str, top_k: int = 5) -> DataFrame:
        return similar(self.rows.where(F.col("chunk_type") == kind), chunk_id, SearchConfig(top_k, -2.0), "chunk_id")


# fixed values: what the knowledge base's search can and can't do
CAPABILITIES = {
    "supports_fuzzy_matching": True, "supports_boolean_search": False, "supports_phrase_search": False,
    "supports_wildcard_search": False, "supports_similarity_ranking": True, "supports_faceted_search": True,
}
# fixed values: kinds of search
SEARCHES = ["full_text_search", "keyword_search", "category_search", "similarity_search", "metadata_search", "multi_criteria_search"]


def facets(results: DataFrame, *columns: str) -> DataFrame:
    """(facet, value, n): how often each value of the columns is among the results."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).cast("string").alias("value")) for c in columns])).alias("x")
    return results.select(pairs).select("x.*").where("value is not null").groupBy("facet", "value").agg(F.count("*").alias("n"))


def neighbours(similarity: DataFrame, key, k: int = 5) -> DataFrame:
    """A document's neighbours by the similarity index (a, b, score, rank)."""
    return similarity.where((F.col("a") == key) & (F.col("rank") <= k)).select(F.col("b").alias("doc"), "score", "rank").orderBy("rank")


def dispatch(tables: dict[str, DataFrame], query: str, kind: str = "full_text", k: int = 10) -> DataFrame:
    """(doc, score) by the search of that kind; tables: docs, weights, keywords, similarity. An unknown kind is an error."""
    from ..functions.text import terms

    spark = tables["docs"].sparkSession
    if kind == "full_text":
        asked = spark.createDataFrame([(query,)], "q string").select(F.explode(terms(F.col("q"))).alias("term"))
        return fulltext(tables["weights"], asked, k).select("doc", "score")
    if kind in ("keyword", "fuzzy_keyword"):
        return keyword(tables["keywords"], query, kind != "keyword").select("doc", "score").orderBy("doc").limit(k)
    if kind in ("category", "type"):
        return metadata(tables["docs"], f"{'chip_category' if kind == 'category' else 'document_type'}:{query}", "doc").orderBy("doc").limit(k)
    if kind == "metadata":
        return metadata(tables["docs"], query, "doc").orderBy("doc").limit(k)
    if kind == "similarity":
        return neighbours(tables["similarity"], query, k).select("doc", "score")
    raise ValueError(f"no search of kind {kind}")


def exported(results: DataFrame, query: str, kind: str) -> DataFrame:
    """Results as they are written out: the query, the kind of search, a rank, and the result's own columns."""
    w = Window.partitionBy(F.lit(0)).orderBy(F.desc("score"), results.columns[0])
    return results.select(F.lit(query).alias("query"), F.lit(kind).alias("search_type"), F.row_number().over(w).alias("position"), "*")


def by_id(docs: DataFrame, key, id_col: str = "doc_id") -> DataFrame:
    return docs.where(F.col(id_col) == key)
