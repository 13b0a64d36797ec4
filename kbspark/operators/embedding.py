"""Embeddings of chunks: TF-IDF with a stored vocabulary, hashed terms, or a model given as a function.

An embedding is kept by chunk_id, so a chunk without usable text has none and no other chunk's row shifts. TF-IDF vectors
are sparse rows (chunk, index, weight); ``dense`` makes arrays of them. A query is embedded with the vocabulary
that the corpus was, read from where ``save`` put it.
"""

from __future__ import annotations

import importlib.util
import json
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.batches import ROWS, pieces
from ..functions.text import lists_of, preprocessed, truncated, words_of

# fixed values: stop words of the segmentation
SEGMENT_STOP_WORDS = (
    "的 了 在 是 我 有 和 就 不 人 都 一 一个 上 也 很 到 说 要 去 你 会 着 没有 看 好 自己 这 那 这个 那个 这些 那些 他 她 它 们 啊 吧 呢 嘛 哦 呀 啦 哈 呵 嗯 噢"
).split()


@dataclass(frozen=True)
class EmbeddingConfig:
    model_type: str = "tfidf"
    model_name: str = ""
    max_features: int = 5000
    min_df: int = 2
    max_df: float = 0.8
    output_dimension: int = 384
    batch_size: int = 32
    max_sequence_length: int = 512


def stop_words(spark: SparkSession, *paths: str) -> list[str]:
    """The fixed list, and the lines of the first file of ``paths`` that exists."""
    out = list(SEGMENT_STOP_WORDS)
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            out += [r.w for r in spark.read.text(path).select(F.trim("value").alias("w")).where("w <> ''").distinct().collect()]
            break
    return sorted(set(out))


def segmented(c: Column, stop: list[str] | None = None) -> Column:
    """Words of a text in order: runs of letters and digits, and each two neighbouring CJK characters; stop words and single characters left out."""
    listed = _listed(stop)

    def run(texts: pa.Array) -> pa.Array:
        return pa.concat_arrays([lists_of(texts.slice(a, ROWS), lambda t: words_of(t, listed, False)) for a in range(0, max(1, len(texts)), ROWS)])

    return F.arrow_udf(run, "array<string>")(c)


def _listed(stop: list[str] | None = None) -> frozenset[bytes]:
    return frozenset(w.encode() for w in (SEGMENT_STOP_WORDS if stop is None else stop))


def keywords(rows: DataFrame, key: str, text: str, k: int = 20) -> DataFrame:
    """(key, keyword, weight, rank): each text's k segmented words of the largest TF-IDF, ties by word."""
    words = _counts(rows, key, text, plain=True).withColumnRenamed("term", "keyword")
    n = rows.agg(F.count("*").alias("n"))
    df = words.groupBy("keyword").agg(F.count("*").alias("df"))
    weighed = words.join(df, "keyword").crossJoin(F.broadcast(n)).withColumn("weight", F.col("tf") * F.ln(F.col("n") / F.col("df")))
    w = Window.partitionBy(key).orderBy(F.desc("weight"), "keyword")
    return weighed.select(key, "keyword", "weight").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def embeddable_text(text: Column, kind: Column, file_name: Column, title: Column, tags: Column) -> Column:
    """A chunk's text; where it is empty, a document's file name and tags, or a section's or table's title."""
    empty = F.coalesce(text, F.lit("")) == ""
    said = F.when(kind.isin("document", "documents"), F.concat_ws(" ", F.nullif(file_name, F.lit("")), F.nullif(F.array_join(tags, " "), F.lit("")))).otherwise(F.coalesce(title, F.lit("")))
    return F.when(empty, said).otherwise(text)


def _by_key(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t): equal keys are neighbours in one partition."""
    return rows.select(F.col(key).alias("k"), F.col(text).alias("t")).repartition("k").sortWithinPartitions("k")


def _tallies(batches: Iterator[pa.RecordBatch], plain: bool = False) -> Iterator[tuple[object, Counter]]:
    """A key and its terms' counts: of all texts of the key, which are neighbours. Terms are words and pairs of neighbouring words of prepared texts; ``plain``: words of texts as they are."""
    listed, held, key = _listed(), None, None
    for b in pieces(batches):
        for k, t in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
            if held is None or k != key:
                if held is not None:
                    yield key, held
                key, held = k, Counter()
            words = words_of(t or b"", listed, not plain)
            held.update(words)
            if not plain:
                held.update(a + b" " + z for a, z in zip(words, words[1:]))
    if held is not None:
        yield key, held


#: Rows of a batch that a worker gives back, or few more.
GIVEN = 50_000


def _counts(rows: DataFrame, key: str, text: str, plain: bool = False) -> DataFrame:
    """(key, term, tf): words and pairs of neighbouring words; ``plain``: words of texts as they are. A row per key and term."""
    by_key = _by_key(rows, key, text)
    kind = to_arrow_type(by_key.schema["k"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, terms, counts = [], [], []
        give = lambda: pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64())], names=[key, "term", "tf"])
        for k, tally in _tallies(batches, plain):
            keys += [k] * len(tally)
            terms += tally.keys()
            counts += tally.values()
            if len(keys) >= GIVEN:
                yield give()
                keys, terms, counts = [], [], []
        yield give()

    return by_key.mapInArrow(run, f"`{key}` {by_key.schema['k'].dataType.simpleString()}, term string, tf long")


def tfidf_vocabulary(rows: DataFrame, key: str = "chunk_id", text: str = "text", config: EmbeddingConfig = EmbeddingConfig()) -> DataFrame:
    """(term, index, idf): the ``max_features`` commonest terms (ties by term) that are in min_df texts or more and at most max_df of them."""
    n = rows.count()
    by_term = _counts(rows, key, text).groupBy("term").agg(F.sum("tf").alias("total"), F.count("*").alias("df"))
    kept = by_term.where((F.col("df") >= config.min_df) & (F.col("df") <= config.max_df * n)).orderBy(F.desc("total"), "term").limit(config.max_features)
    # at most max_features rows
    rows_ = sorted(kept.select("term", (F.ln(F.lit(1.0 + n) / (F.col("df") + 1)) + 1).alias("idf")).collect())
    return rows.sparkSession.createDataFrame([(t, i, w) for i, (t, w) in enumerate(rows_)], "term string, index int, idf double")


def tfidf_vectors(rows: DataFrame, vocabulary: DataFrame, key: str = "chunk_id", text: str = "text", only: set[int] | None = None) -> DataFrame:
    """(key, index, weight) of length 1 for each text with a known term; the vocabulary is of bounded size and sent to the workers. ``only``: the places that are given back."""
    by_key = _by_key(rows, key, text)
    kind = to_arrow_type(by_key.schema["k"].dataType)
    known = {r["term"].encode(): (r["index"], r["idf"]) for r in vocabulary.collect()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, places, weights = [], [], []
        give = lambda: pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(places, pa.int32()), pa.array(weights, pa.float64())], names=[key, "index", "weight"])
        for k, tally in _tallies(batches):
            own = [(known[t][0], n * known[t][1]) for t, n in tally.items() if t in known]
            length = math.sqrt(math.fsum(w * w for _, w in own))
            for place, w in own:
                if only is None or place in only:
                    keys.append(k)
                    places.append(place)
                    weights.append(w / length)
            if len(keys) >= GIVEN:
                yield give()
                keys, places, weights = [], [], []
        yield give()

    return by_key.mapInArrow(run, f"`{key}` {by_key.schema['k'].dataType.simpleString()}, index int, weight double")


def dense(vectors: DataFrame, dimension: int, key: str = "chunk_id") -> DataFrame:
    """(key, embedding array<double>)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for places, weights in zip(f["i"], f["w"], strict=True):
                v = np.zeros(dimension)
                v[places] = weights
                out.append(v)
            yield pd.DataFrame({key: f[key], "embedding": out})

    pair = F.collect_list(F.struct("index", "weight")).alias("p")
    held = vectors.groupBy(key).agg(pair).select(key, F.col("p")["index"].alias("i"), F.col("p")["weight"].alias("w"))
    return held.mapInPandas(run, f"`{key}` {vectors.schema[key].dataType.simpleString()}, embedding array<double>")


def hashed_vectors(rows: DataFrame, dimension: int = 384, key: str = "chunk_id", text: str = "text") -> DataFrame:
    """(key, index, weight): terms hashed to ``dimension`` places with a sign each, of length 1; needs no vocabulary."""
    h = F.xxhash64("term")
    places = _counts(rows, key, text).select(key, F.pmod(h, F.lit(dimension)).cast("int").alias("index"), (F.when(F.shiftright(h, 40) % 2 == 0, 1).otherwise(-1) * F.col("tf")).alias("w"))
    sums = places.groupBy(key, "index").agg(F.sum("w").alias("w")).where("w <> 0")
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return sums.select(key, "index", (F.col("w") / length).alias("weight"))


def encoded(rows: DataFrame, load: Callable[[], Callable[[list[str]], list]], key: str = "chunk_id", text: str = "text", batch: int = 32, unit: bool = True) -> DataFrame:
    """(key, embedding) by a model: ``load`` runs once in each worker and gives a function from texts to vectors."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = load()
        for f in frames:
            for a in range(0, len(f), batch):
                part = f.iloc[a : a + batch]
                out = [[float(x) for x in v] for v in model(part["t"].tolist())]
                if unit:
                    out = [[x / (sum(y * y for y in v) ** 0.5 or 1.0) for x in v] for v in out]
                yield pd.DataFrame({key: part[key], "embedding": out})

    own = rows.select(key, preprocessed(F.col(text)).alias("t")).where("t <> ''")
    return own.mapInPandas(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, embedding array<double>")


def backend(wanted: str = "sentence_transformers") -> str:
    """The first back end of the chain that can be imported: a sentence encoder, a plain encoder, TF-IDF."""
    chain = ["sentence_transformers", "transformers", "tfidf"]
    for name in chain[chain.index(wanted) if wanted in chain else 2 :]:
        if name == "tfidf" or importlib.util.find_spec(name):
            return name
    return "tfidf"


def sentence_encoder(name: str, device: str = "cpu") -> Callable[[], Callable[[list[str]], list]]:
    def load():
        from sentence_transformers import SentenceTransformer

        model = SentenceTransformer(name, device=device)
        return lambda texts: model.encode(texts, normalize_embeddings=True)

    return load


def plain_encoder(name: str, device: str = "cpu", longest: int = 512) -> Callable[[], Callable[[list[str]], list]]:
    """Means of the last hidden states over each text's own tokens."""

    def load():
        import torch
        from transformers import AutoModel, AutoTokenizer

        tokenizer, model = AutoTokenizer.from_pretrained(name), AutoModel.from_pretrained(name).to(device).eval()

        def run(texts):
            given = tokenizer(texts, padding=True, truncation=True, max_length=longest, return_tensors="pt").to(device)
            with torch.no_grad():
                states = model(**given).last_hidden_state
            mask = given["attention_mask"].unsqueeze(-1)
            return ((states * mask).sum(1) / mask.sum(1)).cpu().tolist()

        return run

    return load


def embed_chunks(chunks: DataFrame, config: EmbeddingConfig = EmbeddingConfig()) -> tuple[DataFrame, DataFrame | None]:
    """(chunks with an embedding column, null where there is no usable text; the vocabulary, if the back end has one)."""
    kind = backend(config.model_type)
    if config.model_type == "hashed":
        return chunks.join(dense(hashed_vectors(chunks, config.output_dimension), config.output_dimension), "chunk_id", "left"), None
    if kind == "tfidf":
        words = tfidf_vocabulary(chunks, config=config)
        return chunks.join(dense(tfidf_vectors(chunks, words), max(1, words.count())), "chunk_id", "left"), words
    load = sentence_encoder(config.model_name) if kind == "sentence_transformers" else plain_encoder(config.model_name, longest=config.max_sequence_length)
    return chunks.join(encoded(chunks, load, batch=config.batch_size, unit=kind == "sentence_transformers"), "chunk_id", "left"), None


def save(embedded: DataFrame, vocabulary: DataFrame | None, folder: str, config: EmbeddingConfig = EmbeddingConfig()) -> dict:
    """embeddings/ by kind (texts cut to what a result shows), vocabulary/, stats and configuration; returns the counts by kind."""
    from ..sources.sinks import write_text

    spark = embedded.sparkSession
    if vocabulary is not None:
        vocabulary.write.mode("overwrite").parquet(f"{folder}/vocabulary")
    shown = embedded.where("embedding is not null").withColumn("text", truncated(F.col("text")))
    shown.write.partitionBy("chunk_type").mode("overwrite").parquet(f"{folder}/embeddings")
    counts = embedding_stats(spark.read.parquet(f"{folder}/embeddings")).collect()
    stats = {r["chunk_type"]: r["n"] for r in counts} | {"dimension": max((r["dimension"] for r in counts), default=0)}
    write_text(spark, f"{folder}/embedding_stats.json", json.dumps(stats, ensure_ascii=False, indent=1))
    write_text(spark, f"{folder}/embedding_config.json", json.dumps(asdict(config), indent=1))
    return stats


def load(spark: SparkSession, folder: str) -> DataFrame:
    """What ``save`` wrote; an error names the folder if there is nothing."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/embeddings")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        raise FileNotFoundError(f"no embeddings in {folder}")
    return spark.read.parquet(f"{folder}/embeddings")


def embedding_stats(embedded: DataFrame) -> DataFrame:
    return embedded.groupBy("chunk_type").agg(F.count("embedding").alias("n"), F.max(F.size("embedding")).alias("dimension"))


def query_vector(query: str, vocabulary: DataFrame) -> list[float]:
    """The query's TF-IDF vector by a stored vocabulary; all zero if it knows no term of it."""
    spark = vocabulary.sparkSession
    dimension = vocabulary.count()
    asked = spark.createDataFrame([(0, query)], "chunk_id long, text string")
    out = [0.0] * dimension
    for r in tfidf_vectors(asked, vocabulary).collect():
        out[r["index"]] = r["weight"]
    return out
