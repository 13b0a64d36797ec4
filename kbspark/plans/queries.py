"""Queries over the driver's tables, each with the SQL that says the same.

documents stand for parsed documents: source is the category, lang the type, doc_id the position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import chunking, datasets, indexes, search
from . import manuals


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _docs(name):
    return lambda spark, sf_dir: name(_t(spark, sf_dir, "documents"))


QUERIES = {
    "agg_category_counts": _docs(lambda d: d.groupBy("source").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))),
    "agg_type_share": _docs(lambda d: d.groupBy("lang").agg(F.count("*").alias("n")).withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1))),
    "agg_lengths": _docs(lambda d: d.agg(F.count("*").alias("n"), F.avg(F.length("text")).alias("avg_len"), F.max(F.length("text")).alias("max_len"), F.min(F.length("text")).alias("min_len"))),
    "agg_distinct_categories": _docs(lambda d: d.select("source", "lang").distinct()),
    "fn_language": _docs(lambda d: d.select("doc_id", T.language(F.col("text")).alias("language"), T.mainly_english(F.col("text")).alias("english"))),
    "fn_truncate": _docs(lambda d: d.select("doc_id", T.truncated(F.col("text")).alias("shown"))),
    "fn_difficulty": _docs(lambda d: d.select("doc_id", datasets.difficulty(F.length("text"), F.col("doc_id") % 6).alias("difficulty"))),
    "idx_inverted": _docs(lambda d: indexes.inverted(indexes.postings(d))),
    "idx_tfidf": _docs(lambda d: indexes.tfidf(indexes.postings(d), d.agg(F.count("*").alias("n"))).withColumn("weight", F.round("weight", 9))),
    "idx_metadata": _docs(lambda d: indexes.metadata_index(d, ["source", "lang", "n_chars"])),
    "idx_similarity": _docs(lambda d: indexes.banded_neighbours(d, "doc_id", "text").select("a", "rank", F.round("score", 6).alias("score"))),
    "chunk_windows": _docs(lambda d: chunking.chunked(d, "doc_id", "text")),
    "search_dense": lambda spark, sf_dir: search.search((e := _t(spark, sf_dir, "embeddings")), e.where("vec_id = 0").first()["embedding"]).select("vec_id", F.round("score", 6).alias("score")),
    "search_filtered": lambda spark, sf_dir: search.search((e := _t(spark, sf_dir, "embeddings")), e.where("vec_id = 0").first()["embedding"], search.SearchConfig(5, 0.1), {"label": [0, 1, 2]}).select("vec_id", F.round("score", 6).alias("score")),
}

_TERMS = """
    t as (select doc_id as doc, list_distinct(list_filter(list_concat(
            list_transform(regexp_extract_all(text, '[a-zA-Z]+'), lambda w: lower(w)), regexp_extract_all(regexp_replace(text, '[^\\x{4e00}-\\x{9fa5}a-zA-Z0-9]+', ' ', 'g'), '[0-9]+')),
            lambda w: length(w) >= 2)) as terms from documents),
    p as (select doc, unnest(terms) as term, len(terms) as n_terms from t)"""
_COSINE = "select vec_id, round(score, 6) as score from (select e.vec_id, e.label, list_cosine_similarity(list_transform(e.embedding, lambda x: cast(x as double)), list_transform(q.embedding, lambda x: cast(x as double))) as score from embeddings e, (select embedding from embeddings where vec_id = 0) q)"

ORACLES = {
    "agg_category_counts": "select source, count(*) as n, cast(sum(n_chars) as bigint) as chars from documents group by source",
    "agg_type_share": "select lang, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (), 1) as pct from documents group by lang",
    "agg_lengths": "select count(*) as n, avg(length(text)) as avg_len, max(length(text)) as max_len, min(length(text)) as min_len from documents",
    "agg_distinct_categories": "select distinct source, lang from documents",
    "fn_language": "select doc_id, case when 10 * len(regexp_extract_all(text, '[\\x{4e00}-\\x{9fff}]')) > length(text) then 'zh-cn' else 'en' end as language, coalesce(len(regexp_extract_all(text, '[a-zA-Z]')) / nullif(len(regexp_extract_all(text, '[a-zA-Z]')) + len(regexp_extract_all(text, '[\\x{4e00}-\\x{9fff}]')), 0) > 0.7, false) as english from documents",
    "fn_truncate": "select doc_id, case when length(text) > 200 then left(text, 200) || '...' else text end as shown from documents",
    "fn_difficulty": "select doc_id, case when length(text) < 1000 or doc_id % 6 <= 2 then 'basic' when length(text) < 2000 or doc_id % 6 <= 3 then 'intermediate' else 'advanced' end as difficulty from documents",
    "idx_inverted": f"with {_TERMS} select term, count(*) as df, min(doc) as first_doc, max(doc) as last_doc from p group by term",
    "idx_tfidf": f"with {_TERMS}, f as (select term, count(*) as df from p group by term), c as (select count(*) as n from documents) select doc, p.term, round(ln(n / (df + 1)) / n_terms, 9) as weight from p join f using (term), c",
    "idx_metadata": "select field, value, count(*) as n from (select 'source' as field, trim(source) as value from documents union all select 'lang', trim(lang) from documents union all select 'n_chars', cast(n_chars as varchar) from documents) where value is not null and value <> '' and value <> '0' group by 1, 2",
    "search_dense": f"{_COSINE} where score >= 0.3 order by score desc, vec_id limit 10",
    "search_filtered": f"{_COSINE} where score >= 0.1 and label in (0, 1, 2) order by score desc, vec_id limit 5",
}


def _fulltext(d: DataFrame, k: int | None = 10) -> DataFrame:
    return search.fulltext_of(indexes.postings(d), d.agg(F.count("*").alias("n")), _first_terms(d), k)


def _first_terms(d: DataFrame) -> DataFrame:
    """The terms of the document with the smallest id: a query by example."""
    return d.join(F.broadcast(d.agg(F.min("doc_id").alias("doc_id"))), "doc_id", "left_semi").select(F.explode(T.terms(F.col("text"))).alias("term"))


def _multi(d: DataFrame) -> DataFrame:
    return search.multi_criteria([(_fulltext(d, None), 0.6), (search.metadata(d, "lang:en"), 0.1)])


def _tasks(d: DataFrame) -> DataFrame:
    """Groups of a document and the two after it, as manuals; the default quotas."""
    m = manuals.manuals(d)
    third = m.groupBy(F.floor(F.col("doc_id") / 3).alias("group_id")).agg(F.array_sort(F.collect_list(F.struct("doc_id", "chip_category", "text"))).alias("m"))
    kinds = datasets.suitable_tasks(F.col("m")["chip_category"], F.col("m")["text"])
    groups = third.select("group_id", F.col("group_id").alias("position"), kinds.alias("tasks"))
    return datasets.with_quotas(groups, {"comparison": 0.25, "synthesis": 0.30, "analysis": 0.25, "reasoning": 0.20}, 1000).select("group_id", "task")


QUERIES |= {
    "agg_top_terms": _docs(lambda d: indexes.top_terms(indexes.postings(d))),
    "agg_sample_stats": _docs(lambda d: datasets.sample_stats(d.select(F.col("source").alias("instruction"), F.coalesce("lang", F.lit("")).alias("input"), F.col("text").alias("output")))),
    "idx_category": _docs(lambda d: indexes.value_index(d, "source")),
    "idx_stats": _docs(lambda d: indexes.index_stats(indexes.postings(d), d)),
    "fn_quality_score": _docs(lambda d: d.select("doc_id", datasets.quality_score(F.col("source"), F.col("text"), F.col("text"), (0.25, 0.3, 0.25, 0.2)).alias("score"))),
    "fn_preprocess": _docs(lambda d: d.select("doc_id", T.preprocessed(F.col("text")).alias("clean"))),
    "chunk_packed": _docs(lambda d: d.select("doc_id", F.posexplode(chunking.packed_paragraphs(F.col("text"))).alias("chunk_idx", "chunk"))),
    "search_fulltext": _docs(_fulltext),
    "search_metadata": _docs(lambda d: search.metadata(d, "lang:en")),
    "search_multi_criteria": _docs(_multi),
    "search_similar": lambda spark, sf_dir: search.similar(_t(spark, sf_dir, "embeddings"), 7).select("vec_id", F.round("score", 6).alias("score")),
    "search_length_norm": _docs(lambda d: search.length_norm(d.select("doc_id", "text", F.lit(1.0).alias("score"))).select("doc_id", "score")),
    "dataset_quotas": _docs(_tasks),
}

_WEIGHTS = f"{_TERMS}, f as (select term, count(*) as df from p group by term), c as (select count(*) as n from documents), w as (select doc, p.term, ln(n / (df + 1)) / n_terms as weight from p join f using (term), c)"
_FULL = f"{_WEIGHTS}, q as (select unnest(terms) as term from t where doc = (select min(doc) from t)), full_text as (select doc, round(sum(weight), 9) as score, count(*) as n_matched from w join q using (term) group by doc)"
_QUOTAS = manuals.ORACLES["fn_suitable_tasks"].replace("with m as", "with m as", 1)
_QUOTAS = f"""with g as (select group_id, '|' || tasks || '|' as x from ({_QUOTAS})),
    a as (select group_id from g where contains(x, '|comparison|') order by 1 limit 250),
    b as (select group_id from g where contains(x, '|synthesis|') and group_id not in (from a) order by 1 limit 300),
    c as (select group_id from g where contains(x, '|analysis|') and group_id not in (from a union all from b) order by 1 limit 250),
    d as (select group_id from g where contains(x, '|reasoning|') and group_id not in (from a union all from b union all from c) order by 1 limit 200)
    select * from (select group_id, 'comparison' as task from a union all select group_id, 'synthesis' from b union all select group_id, 'analysis' from c union all select group_id, 'reasoning' from d) order by group_id limit 1000"""
_STRIPPED = "regexp_replace({}, '^\\s+|\\s+$', '', 'g')"
_WINDOWS = f"""with s as (select doc_id, coalesce(text, '') as t, string_split(coalesce(text, ''), chr(10) || chr(10)) as parts from documents),
    q as (select doc_id, t, list_filter(list_transform(parts, lambda x, i: case when {_STRIPPED.format('x')} = '' then '' else {_STRIPPED.format('x')} || case when i < len(parts) then chr(10) || chr(10) else '' end end), lambda x: x <> '') as pieces from s),
    f as (select doc_id, t, array_to_string(pieces, '') as whole, list_transform(range(1, len(pieces) + 1), lambda k: length(array_to_string(pieces[1:k], ''))) as ends from q),
    w as (select doc_id, whole, ends, unnest(range(0, length(whole), 400)) as s from f where length(t) > 500),
    e as (select doc_id, whole, s, coalesce(list_min(list_filter(ends, lambda b: b > s + 250 and b <= least(s + 500, length(whole)))), least(s + 500, length(whole))) as e from w),
    d as (select *, min(case when e >= length(whole) then s end) over (partition by doc_id) as done from e),
    c as (select doc_id, s, {_STRIPPED.format('substr(whole, s + 1, e - s)')} as chunk from d where s <= done union all select doc_id, 0, {_STRIPPED.format('t')} from f where length(t) <= 500),
    k as (select doc_id, chunk, cast(row_number() over (partition by doc_id order by s) - 1 as integer) as chunk_idx from c where chunk <> '')
    select doc_id, chunk_idx, chunk, 'doc_' || doc_id || '_chunk_' || chunk_idx as chunk_id from k"""
_SIMILAR = f"""with {_TERMS}, c as (select count(*) as n from documents), f as (select term, pow(ln(n / (count(*) + 1)), 2) as w from p, c group by term, n),
    x as (select doc, term, w from p join f using (term)), norm as (select doc, sqrt(sum(w)) as norm from x group by doc),
    d as (select doc_id as doc, row_number() over (order by doc_id) as position from documents), band as (select case when n <= 100 then n else 10 end as band from c),
    pairs as (select i.doc as a, j.doc as b from d i join d j on i.doc <> j.doc, band where abs(i.position - j.position) <= band),
    dots as (select a, b, sum(l.w) as dot from pairs join x l on l.doc = a join x r on r.doc = b and r.term = l.term group by 1, 2),
    s as (select a, b, coalesce(dot / nullif(na.norm * nb.norm, 0), 0) as score from pairs left join dots using (a, b) left join norm na on na.doc = a left join norm nb on nb.doc = b),
    r as (select *, row_number() over (partition by a order by round(score, 12) desc, b) as rank from s) select a, cast(rank as integer) as rank, round(score, 6) as score from r where rank <= 5"""

ORACLES |= {
    "agg_top_terms": f"with {_TERMS} select term, count(*) as n from p group by term order by n desc, term limit 50",
    "agg_sample_stats": "select count(*) as total, count(*) filter (coalesce(lang, '') <> '') as with_input, count(*) filter (coalesce(lang, '') = '') as without_input, avg(length(text)) as avg_len, max(length(text)) as max_len, min(length(text)) as min_len from documents",
    "idx_category": "select distinct source as value, doc_id as doc from documents where trim(source) <> ''",
    "idx_stats": f"with {_TERMS} select (select count(*) from documents) as n_docs, count(distinct term) as n_terms, count(*) as n_postings, count(*) / count(distinct term) as docs_per_term, count(*) / (select count(*) from documents) as terms_per_doc from p",
    "search_fulltext": f"with {_FULL} select doc, score, n_matched from full_text order by score desc, doc limit 10",
    "search_metadata": "select doc_id as doc, cast(1.0 as double) as score from documents where trim(lang) = 'en'",
    "search_multi_criteria": f"with {_FULL} select doc, round(sum(score), 9) as score from (select doc, 0.6 * score as score from full_text union all select doc_id, 0.1 from documents where trim(lang) = 'en') group by doc order by score desc, doc limit 10",
    "search_similar": _COSINE.replace("vec_id = 0", "vec_id = 7") + " where vec_id <> 7 order by score desc, vec_id limit 5",
    "search_length_norm": "select doc_id, cast(case when length(text) < 0.3 * m then 0.95 when length(text) > 3 * m then 0.98 else 1 end as double) as score from documents, (select avg(length(text)) as m from documents)",
    "dataset_quotas": _QUOTAS,
    "fn_quality_score": "select doc_id, round_even(0.25 * least(length(text) / 1000, 1) + 0.3 * least(length(text) / 500, 1) + 0.25 * 0.8 + 0.2 * least((length(source) + length(text)) / 1000, 1), 3) as score from documents",
    "fn_preprocess": f"select doc_id, {manuals.prepared_sql("coalesce(text, '')")} as clean from documents",
    "chunk_windows": _WINDOWS,
    "chunk_packed": manuals.PACKED.replace("{text}", "coalesce(text, '')").replace("{table}", "documents"),
    "idx_similarity": _SIMILAR,
}
QUERIES |= manuals.QUERIES
ORACLES |= manuals.ORACLES
