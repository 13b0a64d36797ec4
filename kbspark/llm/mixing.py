"""Mixing sources to target weights by a low-discrepancy schedule.

Targets: each source's share of all words by weight, at most ``most`` times its size, the excess
reshared by weight: the closed form min(most * size, level * weight) with one level for all.

Schedule: 2**m slots. Slot t is the van der Corput point bitrev(t) / 2**m; mapped through the
cumulative targets, a source owns the points of an interval, so within any stretch of the schedule it
comes within a few slots of its share. A source's slots are ranked in schedule order, and its k-th slot
takes the k-th block of equally many words of the source's stream: its documents in shuffled order,
again and again, at most ``most`` times. ``schedule`` has a row for each slot and document that
meet; ``mix`` adds up what is taken of each document and says where it first comes; ``taken_texts`` are the texts of the mix in
schedule order.

No source's rows meet in one task: ranks and stream positions are sums over cells (a stretch of
slots, a range of the shuffle) plus a window within a cell. Only one row per source is ever
ordered in one place, and what there is one row of for each source is broadcast up to FEW_SOURCES of them, and joined beyond. Every step is a DataFrame expression; reruns give the same mix.

Defined cases: null text and wordless documents have size 0 and nothing is taken (``taken_texts`` keeps them once, last); null is a source of
its own, last in order; null ids come first and stay null; repeated ids: rows are told apart by a number, equal ones are interchangeable;
texts of any length are one document each, cut only where a source's target ends; extra columns are passed on by ``taken_texts``, whatever their names;
an empty table gives no rows; if no document has a word, all targets are 0.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NOT_SPACE, SPACES, fresh, stored

WEIGHTS = (1, 2, 3)
MOST = 3
#: Slots grow with the square root of the words: blocks of 4 words at 70 thousand, 200 at 140 million.
SLOTS_PER_ROOT = 60
#: Slots, and documents, of a cell.
CELL = 1 << 13
#: Tables of a row for each source are broadcast if there are no more (about 60 bytes each).
FEW_SOURCES = 100_000
#: Sizes, slots and the result are narrow rows: a task, and so a file, for so many rows, or for each core if that is more.
FILE_ROWS = 1 << 13


def sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(NOT_SPACE)), F.lit(0)).cast("long"))


def _few_files(df: DataFrame, rows: int) -> DataFrame:
    """The same rows in fewer tasks, if there are more than such narrow rows need."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // FILE_ROWS)))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes: (source, source_size), a row per source. Adds weight, target, and cumulative targets lo, hi."""
    everything = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    w = sizes.withColumn("place", F.row_number().over(everything) - 1)
    w = w.withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("place") % len(weights) + 1).cast("int")))
    w = w.withColumn("top", most * F.col("source_size").cast("double"))
    by_ratio = Window.orderBy(F.col("top") / F.col("weight"), "place")
    so_far = by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole).cast("double")
    # with the sources up to this one at their top, what level do the others share?
    w = w.withColumn("total", total).withColumn("level", F.try_divide(F.col("total") - F.coalesce(F.sum("top").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), F.sum("weight").over(whole) - F.sum("weight").over(so_far) + F.col("weight")))
    fits = F.when(F.col("level") <= F.col("top") / F.col("weight"), F.col("level"))
    w = w.withColumn("level", F.coalesce(F.min(F.struct(fits.isNull(), by := F.col("top") / F.col("weight"), fits.alias("v"))).over(whole)["v"], F.lit(float("inf"))))
    w = w.withColumn("target", F.least(F.col("top"), F.col("level") * F.col("weight")))
    hi = F.sum("target").over(everything.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return w.withColumn("hi", hi).withColumn("lo", F.coalesce(F.lag("hi").over(everything), F.lit(0.0))).select("source", "place", "source_size", "weight", "target", "lo", "hi", F.max("hi").over(whole).alias("all"), "total")


def _bitrev(column: str, bits: int):
    return F.conv(F.reverse(F.lpad(F.bin(column), bits, "0")), 2, 10).cast("long") if bits else F.lit(0).cast("long")


def _ranked(rows: DataFrame, key: str, cell: str, order: list, amount: str, name: str) -> DataFrame:
    """name: the sum of amount over the rows of the same key before this one, cell by cell."""
    sums = rows.groupBy(key, cell).agg(F.sum(amount).alias("cell_sum"))
    w = Window.partitionBy(key).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("cell_sum").over(w), F.lit(0)))
    inner = Window.partitionBy(key, cell).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = rows.withColumn("within", F.coalesce(F.sum(amount).over(inner), F.lit(0)))
    return out.join(sums.drop("cell_sum"), [key, cell]).withColumn(name, F.col("before") + F.col("within")).drop("before", "within")


def schedule(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs: (doc_id, source, size). Returns (numbered documents, sources, takes).

    takes: (slot, row, turn, place, start, words): slot ``slot`` takes ``words`` words of document ``row``
    from word ``start`` on, as the stream runs through it for the ``turn``-th time (from 0).
    """
    spark = docs.sparkSession
    sources = stored(targets(docs.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "sources")
    first = sources.select("total", "all").first()
    total = int(first.total or 0) if first else 0
    few = F.broadcast if sources.count() <= FEW_SOURCES else lambda df: df
    bits = max(0, math.ceil(math.log2(SLOTS_PER_ROOT * math.sqrt(total)))) if total else 0
    slots = 1 << bits
    block = total / slots if total else 1.0
    # shuffled documents, numbered apart by their hash
    n = docs.count()
    cells = max(1, n // CELL)
    numbered = docs.join(few(sources.select("place", F.col("source").alias("s"))), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    numbered = numbered.withColumn("h", F.xxhash64("doc_id", F.lit(17)))
    numbered = numbered.withColumn("cell", F.floor((F.col("h").cast("double") / 2.0**64 + 0.5) * cells).cast("long"))
    placed = stored(_ranked(numbered, "place", "cell", ["h", "doc_id", "size", "row"], "size", "begin"), "placed")
    # the points of each source: an interval of [0, slots), made in stretches
    span = sources.withColumn("from", F.ceil(F.coalesce(F.try_divide(F.col("lo"), F.col("all")), F.lit(0.0)) * slots).cast("long")).withColumn("to", F.ceil(F.when(F.col("hi") == F.col("all"), F.lit(1.0)).otherwise(F.try_divide(F.col("hi"), F.col("all"))) * slots).cast("long")).where(F.col("to") > F.col("from"))
    stretches = span.select("place", "source_size", "from", "to", F.explode(F.sequence(F.col("from"), F.col("to") - 1, F.lit(CELL).cast("long"))).alias("a"))
    stretches = stretches.repartition(F.xxhash64("place", "a"))
    points = stretches.select("place", "source_size", F.explode(F.sequence("a", F.least(F.col("a") + CELL, F.col("to")) - 1)).alias("point"))
    points = points.withColumn("slot", _bitrev("point", bits)).withColumn("cell", F.floor(F.col("slot") / CELL)).withColumn("one", F.lit(1).cast("long"))
    ranked = _ranked(points.select("place", "source_size", "slot", "cell", "one"), "place", "cell", ["slot"], "one", "rank")
    # the k-th block of a source's stream
    ranked = ranked.withColumn("b0", F.floor(F.col("rank") * F.lit(block)).cast("long"))
    ranked = ranked.withColumn("b1", F.least(F.floor((F.col("rank") + 1) * F.lit(block)).cast("long"), most * F.col("source_size"))).where("b1 > b0")
    ranked = stored(_few_files(ranked.select("place", "slot", "rank", "b0", "b1"), slots), "slots")
    ends = stored(sources.select("place", "source_size").join(ranked.groupBy("place").agg(F.max("b1").alias("end")), "place"), "ends")
    turns = placed.where("size > 0").join(few(ends), "place")
    turns = turns.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(most - 1)))).withColumn("d0", F.col("turn") * F.col("source_size") + F.col("begin")).where("d0 < end")
    turns = turns.withColumn("d1", F.least(F.col("d0") + F.col("size"), F.col("end")))
    k0 = F.greatest(F.floor(F.col("d0") / F.lit(block)).cast("long") - 1, F.lit(0))
    k1 = F.floor((F.col("d1") - 1) / F.lit(block)).cast("long") + 1
    turns = turns.select("place", "row", "turn", "d0", "d1", F.explode(F.sequence(k0, k1)).alias("rank"))
    met = turns.join(ranked, ["place", "rank"]).where("b0 < d1 and d0 < b1")
    takes = met.select("slot", "row", "turn", "place", (F.greatest("b0", "d0") - F.col("d0")).alias("start"), (F.least("b1", "d1") - F.greatest("b0", "d0")).alias("words"))
    return placed, sources, takes


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """docs: (doc_id, text, source). One row per row: row (a number), doc_id, source, size, source_size, target, taken, first_slot (null: in none)."""
    n = docs.count()
    rows = sized(docs.select("doc_id", "text", "source")).drop("text").withColumn("row", F.monotonically_increasing_id())
    rows = stored(_few_files(rows, n), "sized")
    placed, sources, takes = schedule(rows, weights, most)
    taken = takes.groupBy("row").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"))
    few = F.broadcast if sources.count() <= FEW_SOURCES else lambda df: df
    out = placed.join(few(sources.select("place", "source_size", "target")), "place").join(taken, "row", "left")
    out = out.select("row", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot")
    return _few_files(out, n)


def taken_texts(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """docs: doc_id, text, source and any others. The rows of the mix, in schedule order, with the columns of docs.

    A document comes once for each turn that takes of it, at the first slot of that turn: whole, but where the source's target ends
    within it, as far as that; n_chars, if there, is that of the text.
    """
    row, turn, slot, words, size = fresh(docs, "_row", "_turn", "_slot", "_words", "_size")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    sizes = stored(sized(rows.select(F.col(row).alias("row"), "doc_id", "text", "source")).drop("text"), "sized")
    placed, _, takes = schedule(sizes, weights, most)
    # a turn's words are the first ones: all, but for the last document that a source's stream comes to
    turns = takes.groupBy("row", "turn").agg(F.min("slot").alias("slot"), F.sum("words").alias("words")).join(placed.select("row", "size"), "row")
    empty = placed.where("size = 0").select("row", F.lit(0).alias("turn"), F.lit(None).cast("long").alias("slot"), F.lit(0).cast("long").alias("words"), "size")
    turns = stored(turns.unionByName(empty), "turns")
    names = [(c, n) for c, n in zip(("row", "turn", "slot", "words", "size"), (row, turn, slot, words, size), strict=True)]
    joined = rows.join(turns.select(*[F.col(c).alias(n) for c, n in names]), row)
    begun = F.regexp_replace("text", "\\A" + SPACES, "")
    rest = F.element_at(F.split(begun, SPACES, (F.col(words) + 1).cast("int")), -1)
    first = F.regexp_replace(F.substring(begun, F.lit(1), F.length(begun) - F.length(rest)), SPACES + "\\z", "")
    text = F.when(F.col(words) < F.col(size), first).otherwise(F.col("text"))
    out = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(words) < F.col(size), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.orderBy(F.col(slot).asc_nulls_last(), row, turn).select(*docs.columns)
