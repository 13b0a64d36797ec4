"""Scores and classes of training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def difficulty(total_length: Column, sources: Column) -> Column:
    return F.when((total_length < 1000) | (sources <= 2), "basic").when((total_length < 2000) | (sources <= 3), "intermediate").otherwise("advanced")


def quality_score(instruction: Column, context: Column, output: Column, weights: tuple[float, float, float, float]) -> Column:
    part = lambda n, d: F.least(n / d, F.lit(1.0))
    i, c, o = (F.length(x) for x in (instruction, context, output))
    return F.bround(weights[0] * part(c, 1000) + weights[1] * part(o, 500) + weights[2] * 0.8 + weights[3] * part(i + o, 1000), 3)


def sharegpt(instruction: Column, context: Column, output: Column) -> Column:
    turn = lambda who, text: F.struct(F.lit(who).alias("from"), text.alias("value"))
    return F.array(turn("human", F.concat(instruction, F.lit("\n\n"), context)), turn("gpt", output))


# fixed values: parts of a document type's name and the kind of instruction, first match
INSTRUCTION_TYPES = [("troubleshooting", "troubleshooting"), ("datasheet", "datasheet"), ("selection", "selection"), ("brochure", "application"), ("manual", "technical")]
# fixed values: types of documents that complete each other
COMPLEMENTARY = [("datasheet", "user manual"), ("datasheet", "application"), ("troubleshooting", "user manual"), ("selection", "datasheet"), ("brochure", "datasheet")]
# fixed values: words that suit a group of texts to analysis and to reasoning
ANALYSIS, REASONING = "原理 机制 架构 实现 寄存器".split(), "故障 问题 优化 诊断".split()
TASKS = ("comparison", "synthesis", "analysis", "reasoning")


def _has(c: Column, part: str) -> Column:
    return F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(part))


def instruction_type(document_type: Column) -> Column:
    out = None
    for part, kind in INSTRUCTION_TYPES:
        out = F.when(_has(document_type, part), kind) if out is None else out.when(_has(document_type, part), kind)
    return out.otherwise("qa_basic")


def complementary(a: Column, b: Column) -> Column:
    out = F.lit(False)
    for x, y in COMPLEMENTARY:
        out = out | (_has(a, x) & _has(b, y)) | (_has(a, y) & _has(b, x))
    return out


def context_text(categories: Column, texts: Column) -> Column:
    return F.array_join(F.zip_with(categories, texts, lambda c, t: F.concat(F.lit("=== "), F.coalesce(c, F.lit("")), F.lit(" ===\n"), F.coalesce(t, F.lit("")), F.lit("\n"))), "\n")


def suitable_tasks(categories: Column, texts: Column) -> Column:
    """Kinds of task that a group of texts allows, in the order of TASKS."""
    text = F.array_join(texts, " ", "")
    said = lambda ws: sum((F.contains(text, F.lit(w)).cast("int") for w in ws), F.lit(0))
    kinds = F.size(F.array_distinct(F.filter(categories, lambda c: F.coalesce(c, F.lit("")) != "")))
    tests = (kinds >= 2, F.size(texts) >= 3, said(ANALYSIS) >= 2, said(REASONING) >= 1)
    return F.array_compact(F.array(*[F.when(t, F.lit(k)) for t, k in zip(tests, TASKS, strict=True)]))


def valid(instruction: Column, context: Column, output: Column, score: Column) -> Column:
    return (F.length(instruction) >= 10) & (F.length(context) >= 100) & (F.length(output) >= 50) & (score >= 0.3)


def with_quotas(groups: DataFrame, shares: dict[str, float], most: int, key: str = "group_id", order: str = "position", tasks: str = "tasks") -> DataFrame:
    """One task a group: kind by kind, the first int(most * share) groups left that suit it; then the first ``most``.

    The same as going through the groups in order and taking each one's first kind with room.
    Each kind's choice is a distributed top-n of a set size.
    """
    left, chosen = groups, None
    for kind in TASKS:
        own = left.where(F.array_contains(tasks, kind)).orderBy(order, key).limit(int(most * shares.get(kind, 0))).withColumn("task", F.lit(kind))
        chosen = own if chosen is None else chosen.unionByName(own)
        left = left.join(own.select(key), key, "left_anti")
    return chosen.orderBy(order, key).limit(most)


def sample_stats(rows: DataFrame) -> DataFrame:
    """One row over (instruction, input, output): counts, and lengths of outputs."""
    n = F.length("output")
    filled = F.count_if(F.col("input") != "")
    return rows.agg(F.count("*").alias("total"), filled.alias("with_input"), (F.count("*") - filled).alias("without_input"), F.avg(n).alias("avg_len"), F.max(n).alias("max_len"), F.min(n).alias("min_len"))
