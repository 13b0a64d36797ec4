"""The integration dataset: groups of related chunks, tasks over them, quotas, statistics.

Bases (chunks that groups are built around) are a set of stated size, taken in the order of a hash; each is held against all
chunks in one pass, so the work follows bases x chunks and nothing is compared twice. Chunks are rows of
chunk_id, text, chip_category, document_type (and embedding).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.batches import pieces
from ..functions.text import technical_keywords
from . import datasets, search
from .alpaca import picked

# fixed values: what a task of each kind is about, one of which is taken
FOCUS = {
    "comparison": ["技术架构对比", "性能指标比较", "功能特性分析", "应用场景适配", "成本效益评估", "技术成熟度评估"],
    "synthesis": ["系统架构设计", "技术方案整合", "产品开发策略", "应用场景优化", "技术路线规划", "集成方案设计"],
    "analysis": ["技术原理深度分析", "实现机制解析", "设计理念阐述", "技术演进分析", "性能瓶颈分析", "优化策略研究"],
    "reasoning": ["故障诊断与排除", "性能优化策略", "技术选型决策", "风险评估与控制", "技术演进预测", "解决方案评估"],
}
# fixed values: instructions by kind of task
INSTRUCTIONS = {
    "comparison": "比较以下技术资料中的{}，分析各方案的优劣势和适用场景",
    "synthesis": "基于以下技术资料，设计一个完整的{}方案",
    "analysis": "基于以下技术资料，进行{}，阐述核心技术要点",
    "reasoning": "基于以下技术资料，分析{}的解决方案",
}
# fixed values: integration points by kind of task
POINTS = {
    "comparison": ["比较分析多个技术方案", "识别关键技术差异", "评估优劣势和适用性", "提供选型建议"],
    "synthesis": ["整合多个技术模块", "设计系统架构", "制定实现策略", "考虑系统优化"],
    "analysis": ["深度分析技术原理", "阐述实现机制", "提供技术洞察", "系统性知识整合"],
    "reasoning": ["分析问题根因", "推理解决路径", "制定应对策略", "提供实施方案"],
}
#: What an answer is made from where the configuration has no wording of its own: an outline with the task's subject in place of the braces.
OUTLINES = {
    "comparison": "就{}逐项对照以上资料：\n\n一、各资料的做法与前提。\n二、关键指标与差异。\n三、各自的优势、代价与适用场合。\n四、选型时先看的条件与验证步骤。\n\n结论应按应用需求、成本与可维护性三方面给出，并注明依据的资料。",
    "synthesis": "围绕{}把以上资料合成一个方案：\n\n一、需求与边界。\n二、模块划分，以及每个模块取自哪份资料。\n三、模块之间的接口与时序。\n四、实施次序、风险与验证。\n\n方案应说明取舍的理由，并给出可以分步检查的结果。",
    "analysis": "就{}说明以上资料的内容：\n\n一、原理与前提。\n二、实现的步骤、寄存器与参数。\n三、性能、功耗与成本之间的取舍。\n四、限制与可改进之处。\n\n每一点都应指出依据的资料，并区分资料所述与推论。",
    "reasoning": "就{}由现象推到对策：\n\n一、现象与可复现的条件。\n二、按资料列出可能的原因，逐一排除。\n三、临时措施与根本措施。\n四、验证办法、回退办法与后续监测。\n\n推理的每一步都应写明所依据的资料与仍未确定之处。",
}
WEIGHTS = (0.25, 0.30, 0.25, 0.20)


@dataclass(frozen=True)
class Requirements:
    min_context: int = 500
    max_context: int = 8000
    min_chunks: int = 2
    max_chunks: int = 6
    similarity: float = 0.6
    max_samples: int = 1000
    shares: dict[str, float] = field(default_factory=lambda: {"comparison": 0.25, "synthesis": 0.30, "analysis": 0.25, "reasoning": 0.20})
    #: Bases that are tried; None: every chunk.
    bases: int | None = 20_000


def bases(chunks: DataFrame, most: int | None, min_length: int = 500, seed: str = "") -> DataFrame:
    """The chunks that are long enough, the first ``most`` by a hash of their id; position is that hash."""
    rows = chunks.where(F.length("text") >= min_length).withColumn("position", F.md5(F.concat(F.col("chunk_id").cast("string"), F.lit(seed)).cast("binary")))
    return rows if most is None else rows.orderBy("position", "chunk_id").limit(most)


def related_by_keyword(chunks: DataFrame, some: DataFrame, k: int = 5) -> DataFrame:
    """(base, chunk_id, score, rank): 2 for the same category, 1 for each of the base's keywords that the chunk holds, 1 for types that complete each other.

    ``some``: the bases, of a stated number; ties go to the smaller chunk_id; chunks without a point are left out.
    """
    asked = technical_keywords(F.coalesce("text", F.lit("")))
    q = some.select("chunk_id", "chip_category", "document_type", asked.alias("asked")).toArrow().to_pydict()
    c = chunks.select("chunk_id", "chip_category", "document_type", "text")
    kind = c.schema["chunk_id"].dataType.simpleString()
    if not q["chunk_id"]:
        return c.select(F.col("chunk_id").alias("base"), "chunk_id", F.lit(0).alias("score"), F.lit(1).alias("rank")).limit(0)
    scored = c.mapInArrow(_best_of_pieces(q, k), f"base {kind}, chunk_id {kind}, score int")
    w = Window.partitionBy("base").orderBy(F.desc("score"), "chunk_id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _best_of_pieces(q: dict[str, list], k: int):
    """For each piece of a batch of chunks, each base's k best of it: (base, chunk_id, score)."""
    ids, categories, types = q["chunk_id"], q["chip_category"], q["document_type"]
    words: dict[str, list[int]] = {}
    for i, own in enumerate(q["asked"]):
        for word in own:
            words.setdefault(word, []).append(i)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where = {w: np.array(at) for w, at in words.items()}
        base_at: dict = {}
        for i, base in enumerate(ids):
            base_at.setdefault(base, []).append(i)

        @cache
        def same(category: str | None) -> np.ndarray:
            return np.array([2 * bool(category) * (x == category) for x in categories], np.int32)

        @cache
        def completes(kind: str | None) -> np.ndarray:
            pairs = [(x in (a or "").lower() and y in (kind or "").lower()) or (y in (a or "").lower() and x in (kind or "").lower()) for a in types for x, y in datasets.COMPLEMENTARY]
            return np.array(pairs).reshape(len(types), -1).any(axis=1).astype(np.int32)

        for b in pieces(batches):
            b = b.filter(pc.is_valid(b.column(0)))
            b = b.take(pc.sort_indices(b.column(0)))
            own, score = b.column(0).to_pylist(), np.zeros((b.num_rows, len(ids)), np.int32)
            for i, (category, kind, text) in enumerate(zip(*[b.column(c).to_pylist() for c in (1, 2, 3)], strict=True)):
                score[i] += same(category) + completes(kind)
                for word, at in where.items():
                    if text and word in text:
                        score[i, at] += 1
                score[i, base_at.get(own[i], [])] = 0
            best = np.argsort(-score, axis=0, kind="stable")[:k]
            points = np.take_along_axis(score, best, 0)
            at, base = np.nonzero(points > 0)
            names = pa.array(ids, b.column(0).type)
            yield pa.RecordBatch.from_arrays([names.take(pa.array(base)), b.column(0).take(pa.array(best[at, base])), pa.array(points[at, base])], names=["base", "chunk_id", "score"])

    return run


def related_by_embedding(chunks: DataFrame, some: DataFrame, k: int = 5, threshold: float = 0.5) -> DataFrame:
    """(base, chunk_id, score, rank): the k most similar chunks, of which those that reach the threshold are kept."""
    return search.nearest(some.select(F.col("chunk_id").alias("base"), "embedding"), chunks, "base", "chunk_id", k).where(F.col("score") >= threshold)


def groups(chunks: DataFrame, some: DataFrame, related: DataFrame, need: Requirements = Requirements()) -> DataFrame:
    """(group_id, position, categories, types, texts, context): each base with its related chunks, in order.

    A group whose context is too long keeps its first ``min_chunks`` chunks; one that is then too short, or has too few chunks, goes.
    """
    own = some.select(F.col("chunk_id").alias("group_id"), F.lit(0).alias("rank"), F.col("chunk_id"))
    members = related.select(F.col("base").alias("group_id"), F.col("rank"), "chunk_id").unionByName(own)
    told = members.join(chunks.select("chunk_id", "text", "chip_category", "document_type"), "chunk_id")
    # at most max_chunks rows a group
    g = told.groupBy("group_id").agg(F.array_sort(F.collect_list(F.struct("rank", "text", "chip_category", "document_type"))).alias("m")).where(F.size("m") >= need.min_chunks)
    context = lambda m: datasets.context_text(F.transform(m, lambda x: F.coalesce(x["chip_category"], F.lit("技术资料"))), m["text"])
    g = g.withColumn("m", F.when(F.length(context(F.col("m"))) > need.max_context, F.slice("m", 1, need.min_chunks)).otherwise(F.col("m")))
    g = g.withColumn("context", context(F.col("m"))).where(F.length("context") >= need.min_context).join(some.select(F.col("chunk_id").alias("group_id"), "position"), "group_id")
    return g.select("group_id", "position", F.col("m")["chip_category"].alias("categories"), F.col("m")["document_type"].alias("types"), F.col("m")["text"].alias("texts"), "context")


def tasks(groups_: DataFrame, need: Requirements = Requirements(), outlines: dict[str, str] | None = None, focus: dict[str, list[str]] | None = None) -> DataFrame:
    """One task a group, as quotas allow: task_type, instruction, context, expected_output, difficulty, integration_points, quality_score, context_sources."""
    outlines, focus = OUTLINES | (outlines or {}), FOCUS | (focus or {})
    g = groups_.withColumn("tasks", datasets.suitable_tasks(F.col("categories"), F.col("texts")))
    by_kind = lambda make: F.coalesce(*[F.when(F.col("task") == k, make(k)) for k in datasets.TASKS])
    filled = lambda wording, x: F.replace(F.lit(wording), F.lit("{}"), x)

    def written(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("subject", by_kind(lambda k: picked(F.array(*[F.lit(x) for x in focus[k]]), F.col("group_id"), k)))
        rows = rows.withColumns({"instruction": by_kind(lambda k: filled(INSTRUCTIONS[k], F.col("subject"))), "expected_output": by_kind(lambda k: filled(outlines[k], F.col("subject")))})
        return rows.withColumn("quality_score", datasets.quality_score(F.col("instruction"), F.col("context"), F.col("expected_output"), WEIGHTS))

    # a kind whose task wouldn't be valid isn't open to the group
    each = written(g.select("*", F.explode("tasks").alias("task")))
    open_ = each.where(datasets.valid(F.col("instruction"), F.col("context"), F.col("expected_output"), F.col("quality_score")))
    allowed = open_.groupBy("group_id", "position").agg(F.collect_set("task").alias("tasks"))
    chosen = datasets.with_quotas(allowed, need.shares, need.max_samples)
    rows = written(g.drop("tasks").join(chosen.select("group_id", "task"), "group_id"))
    lengths = F.aggregate(F.transform("texts", lambda t: F.length(F.coalesce(t, F.lit("")))), F.lit(0), lambda a, n: a + n)
    sources = F.transform("categories", lambda c: F.coalesce(c, F.lit("Unknown")))
    return rows.select(
        "group_id", "position", F.col("task").alias("task_type"), "instruction", "context", "expected_output",
        datasets.difficulty(lengths, F.size(F.array_distinct(F.transform("categories", lambda c: F.coalesce(c, F.lit("")))))).alias("difficulty"),
        by_kind(lambda k: F.array(*[F.lit(x) for x in POINTS[k]])).alias("integration_points"), "quality_score", sources.alias("context_sources"),
    )


def integration_dataset(chunks: DataFrame, need: Requirements = Requirements(), seed: str = "", outlines: dict[str, str] | None = None) -> DataFrame:
    """Tasks of document chunks, related by embedding where every chunk has one, else by keywords."""
    some = bases(chunks, need.bases, need.min_context, seed)
    if "embedding" in chunks.columns and chunks.where("embedding is null").isEmpty():
        related = related_by_embedding(chunks, some, need.max_chunks - 1, need.similarity)
    else:
        related = related_by_keyword(chunks, some, need.max_chunks - 1)
    return tasks(groups(chunks, some, related, need), need, outlines)


def alpaca_rows(rows: DataFrame, fields: tuple[str, ...] = ("task_type", "difficulty", "integration_points", "context_sources", "quality_score")) -> DataFrame:
    return rows.select("instruction", F.col("context").alias("input"), F.col("expected_output").alias("output"), *[f for f in fields if f in rows.columns])


def sharegpt_rows(rows: DataFrame, fields: tuple[str, ...] = ("task_type", "difficulty", "integration_points", "context_sources", "quality_score")) -> DataFrame:
    return rows.select(datasets.sharegpt(F.col("instruction"), F.col("context"), F.col("expected_output")).alias("conversations"), *[f for f in fields if f in rows.columns])


def statistics(rows: DataFrame) -> DataFrame:
    """One row: scores, lengths, sources; nulls where there are no tasks."""
    n = lambda c: F.length(F.col(c))
    return rows.agg(
        F.count("*").alias("total_samples"), *[f("quality_score").alias(f"{a}_quality_score") for a, f in (("avg", F.avg), ("min", F.min), ("max", F.max))],
        F.avg(n("instruction")).alias("avg_instruction_length"), F.avg(n("context")).alias("avg_context_length"), F.avg(n("expected_output")).alias("avg_output_length"), F.max(n("context")).alias("max_context_length"),
        F.avg(F.size("context_sources")).alias("avg_sources_per_task"),
    )


def distinct_sources(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("context_sources").alias("source")).agg(F.count_distinct("source").alias("unique_context_sources"))


def histogram(rows: DataFrame, column: str) -> DataFrame:
    """Counts by task type, or difficulty."""
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
