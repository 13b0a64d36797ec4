"""The operators' queries over the driver's tables, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_extract, jaccard_join, line_dedup, lm_scoring, mixing, packing, quality, quality_rules, topk_search, toxicity
from .common import crc_mod, table

FOLDS, LM_FOLDS = 5, 10


def topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk_search.integer_terms(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 64)
    out = topk_search.top_k(vectors.where(F.pmod("id", F.lit(20)) == 0), vectors, 20)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(table(spark, sf_dir, "documents").select("doc_id", "text"), packing.tokenizer_path())


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    out = crc_mod("doc_id", FOLDS) == 0
    model = toxicity.trained(docs.where(~out), labels.select("doc_id", "toxic"))
    return toxicity.scored(docs, model).select("doc_id", out.alias("held_out"), "score", "predicted")


def good(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, n) for n in ("documents", "labels"))
    out = crc_mod("doc_id", FOLDS) == 0
    return quality.quality_scores(docs, labels.where(~out)).select("doc_id", out.alias("held_out"), "text_score", "metadata_score", "score", "kept")


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "first_slot")


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).select(*names)


def language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = crc_mod("doc_id", LM_FOLDS) == 0
    scores = lm_scoring.score(docs, lm_scoring.train(docs.where(~out)))
    return scores.select("doc_id", out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "text", F.col("_lines_removed").alias("lines_removed"))


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_exact_topk": topk,
    "op2_best_fit_packing": packed,
    "op3_toxicity": toxic,
    "op4_quality_classifier": good,
    "op5_mixing": mixed,
    "op6_ngram_jaccard_join": joined,
    "op7_quality_rules": ruled,
    "op8_lm_scoring": language_model,
    "op9_line_dedup": lines,
    "op10_html_extraction": extracted,
    "pipeline": pipeline,
}


def rule_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op7's result SQL can say."""
    return ruled(spark, sf_dir).drop("kept", "posterior")


def mix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of op5's result SQL can say."""
    return mixed(spark, sf_dir).select("doc_id", "size", "source_size", F.round("target", 3).alias("target"))


QUERIES |= {"rules_counts": rule_counts, "mixing_targets": mix_targets}

#: DuckDB SQL for the queries that it can say. The queries' own results are made by the named methods.
ORACLES = {
    "op1_exact_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as t from embeddings
            where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        c as (select vec_id, unnest(t) as x, generate_subscripts(t, 1) as i from v),
        s as (
            select q.vec_id as query_id, c.vec_id, sum(q.x * c.x) as score from c q join c on q.i = c.i and q.vec_id <> c.vec_id
            where q.vec_id % 20 = 0 group by 1, 2),
        r as (select query_id, vec_id, cast(score as bigint) as score, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
        select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 20""",
    "op9_line_dedup": """
        with l as (
            select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
        w as (
            select doc_id, text, i, regexp_replace(line, '^[ \\t\\x0B\\f\\r]+|[ \\t\\x0B\\f\\r]+$', '', 'g') as x,
                row_number() over (partition by doc_id, text order by i) - 1 as k, count(*) over (partition by doc_id, text) as n
            from l where regexp_matches(line, '[^ \\t\\x0B\\f\\r]')),
        t as (
            select doc_id, text, k, n, concat_ws(chr(10), x, lead(x, 1) over p, lead(x, 2) over p) || case when n < 3 then chr(10) || n else '' end as h from w
            window p as (partition by doc_id, text order by k)),
        g as (select *, row_number() over (partition by h order by doc_id, k) as o from t where k <= greatest(n - 3, 0)),
        c as (select distinct doc_id, text, k + d as k from g, (values (0), (1), (2)) z(d) where o > 1),
        lost as (select w.doc_id, w.text, w.i, w.k from w join c using (doc_id, text, k)),
        marks as (
            select l.doc_id, l.text, l.i, l.line, lost.i is not null as gone, w.i is not null as real,
                last_value(case when w.i is null then null else lost.i is not null end ignore nulls) over (partition by l.doc_id, l.text order by l.i) as before,
                first_value(case when w.i is null then null else lost.i is not null end ignore nulls) over (partition by l.doc_id, l.text order by l.i rows between current row and unbounded following) as after
            from l left join w using (doc_id, text, i) left join lost using (doc_id, text, i)),
        kept as (
            select doc_id, text, string_agg(line, chr(10) order by i) filter (where case when real then not gone else not (coalesce(before, false) and coalesce(after, true)) end) as new,
                count(*) filter (where gone) as lines_removed
            from marks group by doc_id, text)
        select d.doc_id, case when d.text is null then null else coalesce(k.new, '') end as text, cast(coalesce(k.lines_removed, 0) as bigint) as lines_removed
        from documents d left join kept k on d.doc_id = k.doc_id and d.text = k.text""",
    "rules_counts": """
        with d as (select doc_id, coalesce(text, '') as t from documents),
        w as (select doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') as ws from d),
        x as (select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as x from (select doc_id, ws, unnest(range(1, len(ws) - 1)) as i from w where len(ws) >= 3)),
        again as (select doc_id, i from (select *, count(*) over (partition by doc_id, x) as c from x) where c > 1),
        r as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from again) group by 1),
        l as (select doc_id, l from (select doc_id, unnest(string_split(t, chr(10))) as l from d) where regexp_matches(l, '[^\\x20\\x09-\\x0D]')),
        e as (select doc_id, count(*) - count(distinct l) as n from l group by 1)
        select w.doc_id, len(ws) as n_words, coalesce(length(array_to_string(ws, '')), 0) as word_chars, len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols, coalesce(e.n, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
            len(ws) < 50 or 100 * coalesce(r.n, 0) > 50 * len(ws) as base_failed
        from w left join r on r.doc_id = w.doc_id left join e on e.doc_id = w.doc_id""",
    "mixing_targets": """
        with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size from documents),
        s as (select source, sum(size) as n, row_number() over (order by source nulls last) as place from d group by source),
        w as (select *, [1, 2, 3][(place - 1) % 3 + 1] as weight, 3.0 * n as top from s),
        o as (select *, sum(n) over () - coalesce(sum(top) over (order by top / weight, place rows between unbounded preceding and 1 preceding), 0) as left_,
            sum(weight) over () - coalesce(sum(weight) over (order by top / weight, place rows between unbounded preceding and 1 preceding), 0) as weights from w),
        v as (select left_ / weights as level from o where left_ / weights <= top / weight order by top / weight, place limit 1)
        select d.doc_id, d.size, cast(o.n as bigint) as source_size, round(cast(least(o.top, v.level * o.weight) as double), 3) as target from d join o on o.source is not distinct from d.source, v""",
}
