"""The text functions by name, for SQL: ``register(spark)`` makes them temporary functions of the session."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import alpaca, chunking
from . import text as T

_CJK = r"regexp_count(t, r'[\u4e00-\u9fff]')"


def _replaced(c: str, steps: list[tuple[str, str]]) -> str:
    for pattern, to in steps:
        c = f"regexp_replace({c}, r'{pattern}', r'{to}')"
    return c


def terms_of(text: str | None) -> list[str]:
    """What functions.text.terms gives, a text at a time."""
    words = re.findall("[a-zA-Z]+", text or "")
    numbers = re.findall("[0-9]+", text or "")
    cjk = "".join(re.findall("[\u4e00-\u9fa5]+", text or ""))
    grams = [cjk[i : i + n] for i in range(len(cjk)) for n in (4, 3, 2)]
    stop = set(T.STOP_WORDS)
    return [w for w in dict.fromkeys([*map(str.lower, words), *numbers, *grams]) if len(w) >= 2 and w not in stop]


def table_text_of(headers: list[str], rows: list[list[str]], most: int = 10, label: str = "总共") -> str:
    lines = ["表头: " + " | ".join(headers)] + [f"行{i}: " + " | ".join(r) for i, r in enumerate(rows[:most], 1)]
    return "\n".join(lines + [f"... ({label}{len(rows)}行数据)"] * (len(rows) > most))


def register(spark: SparkSession) -> None:
    """kb_language, kb_mainly_english, kb_preprocess, kb_localised (SQL), kb_terms, kb_table_text, kb_chunks (UDFs)."""
    clean = _replaced("coalesce(t, '')", [*T.CLEANING, (T.STRIP, "")])
    localised = _replaced("t", [(rf"(?iU)\b{re.escape(term)}\b", word) for term, word in alpaca.TERMS.items()] + alpaca.UNITS)
    bodies = {
        "kb_language": ("string", f"if({_CJK} * 10 > length(t), 'zh-cn', 'en')"),
        "kb_mainly_english": ("boolean", f"coalesce(try_divide(regexp_count(t, '[a-zA-Z]'), regexp_count(t, '[a-zA-Z]') + {_CJK}) > 0.7, false)"),
        "kb_preprocess": ("string", f"if(length({clean}) < 5, '', {clean})"),
        "kb_localised": ("string", localised),
    }
    for name, (kind, body) in bodies.items():
        spark.sql(f"create or replace temporary function {name}(t string) returns {kind} return {body}")
    lists = lambda of: F.pandas_udf(lambda s: pd.Series([of(t) for t in s], dtype=object), "array<string>")
    spark.udf.register("kb_terms", lists(terms_of))
    spark.udf.register("kb_chunks", lists(chunking.windows_of))
    spark.udf.register("kb_table_text", F.udf(table_text_of, "string"))
