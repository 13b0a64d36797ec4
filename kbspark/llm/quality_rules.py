"""Quality rules as weak supervision.

Each rule looks at a document's counts and votes good, bad, or abstains. Two base rules stand outside: under 50 words,
or more than half of the words in repeated windows. The votes of all documents that pass these are
counted by pattern (at most 3 ** rules of them, however many documents); expectation-maximisation
on these counts estimates, for each rule, how often it votes each way on good and on bad documents,
and the share of good ones. A document is kept if it passes the base rules and the posterior probability that it is good,
given all its votes, is at least ``threshold``: a single failed rule doesn't condemn it, and one that the others agree with does.

No rule repeats a base rule: what those let through is judged by the rest. Rules are kept the right way round: a rule's votes for good are at least as likely on good documents as
on bad ones, and the other way. EM starts where a rule finds three in ten bad documents and two in a hundred good ones bad: a bad document passes most rules, so
votes for good say less than votes against.

Defined cases: null and empty texts have no words and fail the base rule; no documents, no patterns, no
rows; if none passes the base rules, the rates are those that EM starts with, smoothed; rows are scored one by one, so repeated ids are rows of their own and get the same result; null ids stay null; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import sliced, stored
from .stats import COUNTS, text_counts
from .words import as_bytes

ROUNDS, THRESHOLD = 100, 0.5
BAD, NONE, GOOD = 0, 1, 2


def _ratio(a: str, b: str) -> Column:
    return F.coalesce(F.try_divide(F.col(a), F.col(b)), F.lit(0.0))


#: name: (measure, good from, good to, bad below, bad above); abstain between. Fixed values.
RULES: dict[str, tuple[str | tuple[str, str], float, float, float, float]] = {
    "symbols": (("n_symbols", "n_words"), 0, 0.02, -1, 0.1),
    "letters": (("n_letters", "word_chars"), 0.9, 1, 0.8, 2),
    "digits": (("n_digits", "word_chars"), 0, 0.08, -1, 0.2),
    "word_length": (("word_chars", "n_words"), 3.5, 7, 3, 8),
    "line_ends": (("n_ended", "n_lines"), 0.9, 1, 0.5, 2),
    "same_lines": (("n_dup_lines", "n_lines"), 0, 0.05, -1, 0.3),
    "capitals": (("n_upper", "n_letters"), 0.001, 0.1, -1, 0.3),
    "shouts": (("n_shouts", "n_words"), 0, 0.02, -1, 0.1),
    "line_words": (("n_words", "n_lines"), 10, 200, 4, 1000),
    "distinct": (("n_distinct", "n_words"), 0.6, 1, 0.4, 2),
}


def counted(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            c = text_counts(as_bytes(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c[k]) for k in COUNTS]], ["doc_id", *COUNTS])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{k} long" for k in COUNTS))


def votes() -> list[Column]:
    out = []
    for measure, lo, hi, below, above in RULES.values():
        x = F.col(measure).cast("double") if isinstance(measure, str) else _ratio(*measure)
        out.append(F.when((x < below) | (x > above), F.lit(BAD)).when((x >= lo) & (x <= hi), F.lit(GOOD)).otherwise(F.lit(NONE)))
    return out


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """EM over vote patterns (rows of 0, 1, 2). Returns rates[class, rule, vote] and the share of good ones."""
    rules = patterns.shape[1]
    rates = np.empty((2, rules, 3))
    one = np.eye(3)[patterns]
    seen = np.einsum("p,prv->rv", counts, one) / max(1, counts.sum())
    for c, bad in ((0, 0.3), (1, 0.02)):
        rates[c, :, NONE] = np.clip(seen[:, NONE], 0.01, 0.98)
        rates[c, :, BAD] = bad * (1 - rates[c, :, NONE])
        rates[c, :, GOOD] = (1 - bad) * (1 - rates[c, :, NONE])
    share = 0.8
    for _ in range(rounds):
        p = posterior(patterns, rates, share)
        for c, q in ((0, 1 - p), (1, p)):
            m = np.einsum("p,prv->rv", counts * q, one) + 1.0
            rates[c] = m / m.sum(1, keepdims=True)
        # the right way round
        for v, c in ((GOOD, 1), (BAD, 0)):
            rates[c, :, v] = np.maximum(rates[c, :, v], rates[1 - c, :, v])
        rates /= rates.sum(2, keepdims=True)
        share = float(np.clip((counts @ p + 1) / (counts.sum() + 2), 0.05, 0.95))
    return rates, share


def posterior(patterns: np.ndarray, rates: np.ndarray, share: float) -> np.ndarray:
    at = np.arange(patterns.shape[1])
    logs = [np.log(s) + np.log(rates[c][at, patterns]).sum(1) for c, s in ((0, 1 - share), (1, share))]
    return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def quality_rules(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """docs: (doc_id, text). One row per row: doc_id, counts, base_failed, posterior, kept."""
    pattern = F.lit(0)
    for v in votes():
        pattern = pattern * 3 + v
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = stored(counted(docs).withColumns({"pattern": pattern, "base_failed": failed}), "counts")
    seen = rows.groupBy("pattern").agg(F.sum((~F.col("base_failed")).cast("long")).alias("passed")).collect()
    codes = np.array([r["pattern"] for r in seen], np.int64)
    table = np.stack([(codes // 3**k) % 3 for k in reversed(range(len(RULES)))], 1) if len(codes) else np.zeros((0, len(RULES)), np.int64)
    rates, share = estimate(table, np.array([r["passed"] for r in seen], float))
    known = docs.sparkSession.createDataFrame([(int(c), float(p)) for c, p in zip(codes, posterior(table, rates, share), strict=True)], "pattern int, posterior double")
    # at most 3 ** rules rows
    out = rows.join(F.broadcast(known), "pattern")
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold)).drop("pattern")
