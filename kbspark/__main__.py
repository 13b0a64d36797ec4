"""python -m kbspark ACTION: a Markdown tree to documents, chunks, reports, indexes, embeddings and training sets; searches over them."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import expanded_query, normalised_query, terms
from .operators import alpaca, chunking, embedding, indexes, integration, search
from .sources import corpus, markdown, sinks

#: Queries that ``demo`` asks one after the other.
DEMO = ("PWM 控制器配置", "ADC 采样时间", "低功耗模式", "电机驱动", "复位电路", "通信协议", "故障排除")


def convert(spark: SparkSession, root: str, out: str) -> dict:
    """Documents under ``out``; returns their statistics."""
    sinks.write_corpus(markdown.documents(markdown.scan(spark, root)), out)
    return sinks.corpus_stats(sinks.read_corpus(spark, out))


def chunk(spark: SparkSession, out: str, size: int = 500, overlap: int = 100) -> dict:
    return sinks.write_chunks(chunking.all_chunks(sinks.read_corpus(spark, out), size, overlap), out)


def reports(spark: SparkSession, out: str, stats: dict) -> None:
    sinks.write_summaries(sinks.read_corpus(spark, out), out)
    sinks.write_text(spark, f"{out}/report.md", sinks.report(stats))


def ingest(spark: SparkSession, root: str, out: str, size: int = 500, overlap: int = 100) -> dict:
    """Documents, chunks, summaries and report under ``out``; returns the statistics."""
    stats = convert(spark, root, out)
    stats |= {"chunks": chunk(spark, out, size, overlap)}
    reports(spark, out, stats)
    return stats


def pipeline(spark: SparkSession, root: str, out: str, size: int = 500, overlap: int = 100) -> dict:
    """ingest() in stages; what each did, and how the run ended, is in pipeline_stats.json."""
    stages = {
        "conversion": lambda: convert(spark, root, out),
        "analysis": lambda: reports(spark, out, sinks.corpus_stats(sinks.read_corpus(spark, out))),
        "chunks": lambda: chunk(spark, out, size, overlap),
    }
    return sinks.run_stages(spark, stages, f"{out}/pipeline_stats.json")


def index(spark: SparkSession, out: str) -> dict:
    """All indexes under ``out``; returns their statistics, which are added to the report."""
    docs = sinks.read_corpus(spark, out)
    indexes.save(indexes.build(docs), f"{out}/index")
    back = indexes.load(spark, f"{out}/index")
    statistics = indexes.full_stats(back).first().asDict()
    top = back["keywords"].groupBy("value").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(20).collect()
    sinks.write_text(spark, f"{out}/index_report.md", sinks.index_report(statistics, {r["value"]: r["n"] for r in top}))
    return statistics


def chunks_of(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/chunks").withColumn("file_name", F.regexp_extract("chunk_id", r"([^/]*\.md)", 1))


def embed(spark: SparkSession, out: str, config: embedding.EmbeddingConfig = embedding.EmbeddingConfig()) -> dict:
    chunks = chunks_of(spark, out)
    chunks = chunks.withColumn("text", embedding.embeddable_text(F.col("text"), F.col("chunk_type"), F.col("file_name"), F.col("title"), F.col("tags")))
    kinds = F.concat("chunk_type", F.lit("s"))
    embedded, words = embedding.embed_chunks(chunks.withColumn("chunk_type", kinds), config)
    return embedding.save(embedded, words, f"{out}/embedding", config)


def searcher(spark: SparkSession, out: str) -> search.Searcher:
    words = spark.read.parquet(f"{out}/embedding/vocabulary")
    settings = corpus.read_config(f"{out}/embedding/embedding_config.json", {})
    if settings.get("model_type", "tfidf") not in ("tfidf", "sentence_transformers", "transformers"):
        raise ValueError(f"no query embedding for {settings['model_type']}")
    return search.Searcher(embedding.load(spark, f"{out}/embedding"), lambda q: embedding.query_vector(q, words))


def fulltext(spark: SparkSession, out: str, query: str, k: int = 10) -> DataFrame:
    """Chunks that ingest() wrote, by the query's terms and their synonyms."""
    chunks = spark.read.parquet(f"{out}/chunks")
    posts = indexes.postings(chunks, "chunk_id")
    weights = indexes.tfidf(posts, chunks.agg(F.count("*").alias("n")))
    asked = spark.createDataFrame([(query,)], "q string").select(F.explode(terms(expanded_query(normalised_query(F.col("q"))))).alias("term"))
    return search.fulltext(weights, asked, k)


def alpaca_set(spark: SparkSession, out: str, most_qa: int | None = 5000, most_instructions: int | None = 3000) -> dict:
    """The complete, question and instruction datasets under ``out``; returns the first one's statistics."""
    chunks = chunks_of(spark, out)
    parts = {"complete": alpaca.complete_dataset(chunks, most_qa, most_instructions), "qa": alpaca.qa_dataset(chunks, most_qa), "instruction": alpaca.instruction_dataset(chunks, most_instructions)}
    told = {}
    for name, rows in parts.items():
        told[name] = alpaca.dataset_stats(rows).first().asDict()
        sinks.write_samples(rows.select("instruction", "input", "output"), f"{out}/alpaca_{name}", told[name])
    return told["complete"]


def integration_set(spark: SparkSession, out: str, config: str | None = None, sharegpt: bool = False) -> dict:
    """The integration dataset under ``out``; ``config``: a JSON file of Requirements and, under "outlines", wordings. Empty: an error is printed."""
    own = corpus.read_config(config, {}) if config else {}
    outlines = own.pop("outlines", None)
    chunks = chunks_of(spark, out).where("chunk_type = 'document'")
    rows = integration.integration_dataset(chunks, integration.Requirements(**own), outlines=outlines)
    told = integration.statistics(rows).first().asDict() | integration.distinct_sources(rows).first().asDict()
    for column in ("task_type", "difficulty"):
        told[column] = {r["value"]: r["n"] for r in integration.histogram(rows, column).collect()}
    if not told["total_samples"]:
        print("no tasks: no group of chunks meets the requirements")
        return told
    sinks.write_samples(integration.alpaca_rows(rows), f"{out}/integration_alpaca", told)
    if sharegpt:
        sinks.write_samples(integration.sharegpt_rows(rows), f"{out}/integration_sharegpt", told)
    return told


def _shown(rows: DataFrame) -> None:
    for k, r in enumerate(rows.collect(), 1):
        print(f"{k}. [{r['chunk_type']}] {r['score']:.3f}  {r['chunk_id']}\n   {r['text'][:100]}")


def _asked(s: search.Searcher, query: str, args) -> DataFrame:
    if args.category:
        return s.by_category(query, args.category, args.top_k)
    if args.doc_type:
        return s.by_document_type(query, args.doc_type, args.top_k)
    return {"fuzzy": s.fuzzy, "precise": s.precise}.get(args.mode, lambda q, top_k: s.multi_modal(q, top_k=top_k))(query, args.top_k)


def main() -> None:
    p = argparse.ArgumentParser(prog="kbspark")
    sub = p.add_subparsers(dest="action", required=True)
    for name in ("ingest", "pipeline", "convert"):
        a = sub.add_parser(name)
        a.add_argument("--input", required=True)
        a.add_argument("--output", required=True)
        a.add_argument("--chunk-size", type=int, default=500)
        a.add_argument("--overlap-size", type=int, default=100)
    for name in ("analyze", "index", "embed", "alpaca", "integration", "fulltext", "search", "demo", "interactive"):
        a = sub.add_parser(name)
        a.add_argument("--output", required=True)
        if name in ("search", "demo", "interactive"):
            a.add_argument("--category")
            a.add_argument("--doc-type")
            a.add_argument("--mode", choices=["multi", "fuzzy", "precise"], default="multi")
        if name in ("fulltext", "search", "demo", "interactive"):
            a.add_argument("--query", required=name in ("fulltext", "search"))
            a.add_argument("--top-k", type=int, default=10)
        if name == "embed":
            a.add_argument("--model-type", default="tfidf")
            a.add_argument("--model-name", default="")
            a.add_argument("--batch-size", type=int, default=16)
        if name == "alpaca":
            a.add_argument("--max-qa", type=int, default=5000)
            a.add_argument("--max-instructions", type=int, default=3000)
        if name == "integration":
            a.add_argument("--config")
            a.add_argument("--sharegpt", action="store_true")
    args = p.parse_args()
    spark = SparkSession.builder.appName("kbspark").getOrCreate()
    told = None
    if args.action in ("ingest", "pipeline"):
        told = (ingest if args.action == "ingest" else pipeline)(spark, args.input, args.output, args.chunk_size, args.overlap_size)
    elif args.action == "convert":
        told = convert(spark, args.input, args.output)
    elif args.action == "analyze":
        print(sinks.report(sinks.corpus_stats(sinks.read_corpus(spark, args.output))))
    elif args.action == "index":
        told = index(spark, args.output)
    elif args.action == "embed":
        told = embed(spark, args.output, embedding.EmbeddingConfig(model_type=args.model_type, model_name=args.model_name, batch_size=args.batch_size))
    elif args.action == "alpaca":
        told = alpaca_set(spark, args.output, args.max_qa, args.max_instructions)
    elif args.action == "integration":
        told = integration_set(spark, args.output, args.config, args.sharegpt)
    elif args.action == "fulltext":
        for r in fulltext(spark, args.output, args.query, args.top_k).collect():
            print(f"{r.score:.6f}  {r.doc}")
    else:
        s = searcher(spark, args.output)
        asked = [args.query] if args.action == "search" else DEMO if args.action == "demo" else iter(lambda: input("query> ").strip(), "")
        for query in asked:
            print(query)
            _shown(_asked(s, query, args))
    if told is not None:
        print(json.dumps(told, ensure_ascii=False, indent=1, default=str))
    spark.stop()


if __name__ == "__main__":
    main()
