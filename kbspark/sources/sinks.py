"""Sinks: tables as Parquet, JSON lines and CSV, small summaries as one JSON file or a Markdown report.

Whatever grows with the corpus is written by the executors; only aggregates come to the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, by Hadoop's file systems."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def corpus_stats(docs: DataFrame) -> dict:
    """Totals, and counts by category, type and language, of parsed documents."""
    good = docs.where("error is null")
    size = F.aggregate("sections", F.lit(0), lambda a, s: a + F.length(s["content"]))
    n = docs.agg(F.count("*").alias("total_files"), F.count_if(F.col("error").isNull()).alias("successful_conversions"), F.count_if(F.col("error").isNotNull()).alias("failed_conversions")).first().asDict()
    sums = good.agg(
        F.coalesce(F.sum(F.size("sections")), F.lit(0)).alias("total_sections"), F.coalesce(F.sum(F.size("tables")), F.lit(0)).alias("total_tables"), F.count_if(F.size("tables") > 0).alias("documents_with_tables"),
        F.avg(size).alias("avg_length"), F.max(size).alias("max_length"), F.min(size).alias("min_length"), F.coalesce(F.sum(size), F.lit(0)).alias("total_content_chars"), F.avg(F.size("tables")).alias("tables_per_document"),
    ).first().asDict()
    sums["sections_per_document"] = sums["total_sections"] / n["successful_conversions"] if n["successful_conversions"] else None
    sums["avg_section_length"] = sums["total_content_chars"] / sums["total_sections"] if sums["total_sections"] else None
    kinds = good.select(F.explode("sections.section_type").alias("k")).groupBy("k").count().orderBy(F.desc("count"), "k")
    sums["section_type"] = {r[0]: r[1] for r in kinds.collect()}
    for c in ("chip_category", "document_type", "language"):
        sums[c] = {r[0]: r[1] for r in good.groupBy(c).count().orderBy(F.desc("count"), c).collect()}
    return n | sums


def write_corpus(docs: DataFrame, folder: str) -> None:
    """documents/ by category (Parquet), errors/ (JSON lines), index.json."""
    # the folders' names are a copy: Spark would read a category such as 32F back as a number
    docs.where("error is null").drop("error").withColumn("category", F.col("chip_category")).write.partitionBy("category").mode("overwrite").parquet(f"{folder}/documents")
    docs.where("error is not null").select("file_path", "error").write.mode("overwrite").json(f"{folder}/errors")
    stats = corpus_stats(docs)
    files = {c: f"documents/category={c}" for c in stats["chip_category"]}
    told = {"total_documents": stats["successful_conversions"], "categories": list(stats["chip_category"]), "document_types": list(stats["document_type"]), "files": files, "statistics": stats}
    write_text(docs.sparkSession, f"{folder}/index.json", json.dumps(told, ensure_ascii=False, indent=1))
    write_text(docs.sparkSession, f"{folder}/analysis_result.json", json.dumps(stats, ensure_ascii=False, indent=1))


def read_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that write_corpus() wrote, with an empty error column."""
    return spark.read.parquet(f"{folder}/documents").drop("category").withColumn("error", F.lit(None).cast("string"))


def write_summaries(docs: DataFrame, folder: str) -> None:
    """CSV tables with one row per document and per section."""
    good = docs.where("error is null")
    size = F.aggregate("sections", F.lit(0), lambda a, s: a + F.length(s["content"]))
    good.select("file_path", "file_name", "chip_category", "document_type", "language", F.size("sections").alias("section_count"), F.size("tables").alias("table_count"), F.size("keywords").alias("keyword_count"), size.alias("content_length")).write.mode("overwrite").csv(f"{folder}/documents_summary", header=True)
    s = good.select("file_path", "chip_category", "document_type", F.explode("sections").alias("s"))
    s.select("file_path", "chip_category", "document_type", "s.section_id", "s.section_type", "s.title", "s.level", F.length("s.content").alias("content_length")).write.mode("overwrite").csv(f"{folder}/sections_summary", header=True)


def write_chunks(chunks: DataFrame, folder: str) -> dict:
    """chunks/ by kind; returns the counts by kind."""
    chunks.write.partitionBy("chunk_type").mode("overwrite").parquet(f"{folder}/chunks")
    back = chunks.sparkSession.read.parquet(f"{folder}/chunks")
    return {r[0]: r[1] for r in back.groupBy("chunk_type").count().collect()}


def write_ready(chunks: DataFrame, folder: str, settings: dict | None = None) -> dict:
    """JSON lines of each kind (documents, sections, tables) for other tools, and their numbers; returns these."""
    kinds = {"documents": "document", "sections": "section", "tables": "table"}
    counts = {r[0]: r[1] for r in chunks.groupBy("chunk_type").count().collect()}
    for name, kind in kinds.items():
        chunks.where(F.col("chunk_type") == kind).drop("chunk_type").write.mode("overwrite").json(f"{folder}/{name}_chunks")
    told = {f"total_{k}_chunks": counts.get(v, 0) for k, v in kinds.items()} | {"total_chunks": sum(counts.values())} | (settings or {})
    write_text(chunks.sparkSession, f"{folder}/vectorization_ready.json", json.dumps(told, ensure_ascii=False, indent=1))
    return told


def run_stages(spark: SparkSession, stages: dict, path: str) -> dict:
    """Runs the stages (name: function without arguments) in order and writes what each returned; a failure ends the run and is written as well."""
    from datetime import datetime

    now = lambda: datetime.now().isoformat()
    stats: dict = {"start_time": now(), "stages": {}, "status": "success"}
    try:
        for name, stage in stages.items():
            stats["stages"][name] = stage()
    except Exception as e:  # written, not hidden: the status says so
        stats |= {"status": "failed", "error": str(e)}
    stats["end_time"] = now()
    write_text(spark, path, json.dumps(stats, ensure_ascii=False, indent=1, default=str))
    return stats


def write_results(results: DataFrame, folder: str) -> None:
    """Search results, best first, as JSON lines."""
    results.write.mode("overwrite").json(folder)


def write_samples(rows: DataFrame, folder: str, statistics: dict) -> None:
    """Training samples as JSON lines, and their statistics."""
    rows.write.mode("overwrite").json(f"{folder}/samples")
    write_text(rows.sparkSession, f"{folder}/stats.json", json.dumps(statistics, ensure_ascii=False, indent=1))


def report(stats: dict) -> str:
    """corpus_stats() as Markdown: totals, and counts with shares, largest first."""
    lines = ["# Corpus", "", "| | |", "|-|-|"] + [f"| {k} | {v:,.1f} |" if isinstance(v, float) else f"| {k} | {v:,} |" for k, v in stats.items() if isinstance(v, (int, float))]
    for name in ("chip_category", "document_type", "section_type", "language"):
        whole = sum(stats[name].values()) or 1
        lines += ["", f"## {name}", "", "| value | documents | share |", "|-|-|-|"] + [f"| {k} | {n:,} | {100 * n / whole:.1f} % |" for k, n in stats[name].items()]
    return "\n".join(lines) + "\n"


def bullet_report(stats: dict) -> str:
    """The same as lists: no tables."""
    out = ["# Corpus", ""] + [f"- **{k}**: {v:,.1f}" if isinstance(v, float) else f"- **{k}**: {v:,}" for k, v in stats.items() if isinstance(v, (int, float))]
    for name in ("chip_category", "document_type", "section_type", "language"):
        whole = sum(stats[name].values()) or 1
        out += ["", f"## {name}", ""] + [f"- **{k}**: {n:,} ({100 * n / whole:.1f} %)" for k, n in stats[name].items()]
    return "\n".join(out) + "\n"


def index_report(statistics: dict, top_keywords: dict[str, int]) -> str:
    """The indexes' statistics and the commonest keywords."""
    out = ["## Indexes", "", "| | |", "|-|-|"] + [f"| {k} | {v:,.1f} |" if isinstance(v, float) else f"| {k} | {v} |" for k, v in statistics.items()]
    return "\n".join(out + ["", "| keyword | n |", "|-|-|"] + [f"| {k} | {n} |" for k, n in top_keywords.items()]) + "\n"
