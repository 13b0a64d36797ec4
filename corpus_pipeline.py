"""The corpus pipeline: five stages, each a function (spark, docs, sf_dir) -> DataFrame.

Quality classifier, line dedup, n-gram Jaccard join, mixing, packing. Every stage works on all rows that the one
before kept; all but the last return the columns of documents.

Defined cases, in every stage: null texts count as empty and stay null; empty tables give empty tables; equal rows and repeated ids are
rows of their own (but equal rows are copies of each other for the join); null ids come first; ties go to the smaller id, then to the
row that comes first in the stored input; extra columns are kept, whatever their names; texts are never cut but by the mix (where a source's target ends) and by packing.

A stage begins by deleting what earlier ones stored and no DataFrame reads any more, so disks hold the texts of a stage and of the one before, not of all.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kbspark.llm import jaccard_join, line_dedup, mixing, packing, quality
from kbspark.llm.common import forget, forget_unread, fresh, stored, table
from kbspark.llm.packing import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _tidy(stage: Stage) -> Stage:
    @wraps(stage)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        forget_unread(spark)
        return stage(spark, docs, sf_dir)

    return begin


@_tidy
def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return stored(quality.good_documents(docs, table(spark, sf_dir, "labels").select("doc_id", "quality")), "good")


@_tidy
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later occurrences of three-line passages; a document of which nothing is left goes."""
    (removed,) = fresh(docs, "_lines_removed")
    return stored(line_dedup.line_dedup(docs, removed=removed).where(f"`{removed}` = 0 or text <> ''").select(*docs.columns), "cut")


@_tidy
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by near copies, the first by id (null first); repeated ids are rows of their own."""
    (row,) = fresh(docs, "_row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = jaccard_join.jaccard_join(rows.select(F.col(row).alias("doc_id"), "text"))
    groups = stored(found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("of")), "groups")
    linked = groups.join(groups.where("row <> of").select("of").distinct(), "of", "left_semi").join(rows.select(F.col(row).alias("row"), "doc_id"), "row")
    linked = stored(linked, "linked")
    first = linked.groupBy("of").agg(F.min(F.struct("doc_id", "row"))["row"].alias("first"))
    others = stored(linked.join(first, "of").where("row <> first").select(F.col("row").alias(row)), "others")
    forget(spark, groups, linked)
    return rows.join(others, row, "left_anti").select(*docs.columns)


@_tidy
def to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, in schedule order: documents as often as it takes them, the last one of a source as far as its target goes."""
    return mixing.taken_texts(docs)


@_tidy
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens: a row per piece of a document."""
    return packing.best_fit_pack(docs.select("doc_id", "text"), tokenizer_path())


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing", to_target_weights),
    ("best-fit packing", pack),
]

#: The classifier's decisions can't be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        docs = out if hasattr(out, "_stored_at") else stored(out, "stage-" + name.replace(" ", "-"))
    return docs
