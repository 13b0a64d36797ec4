"""Windowed counts of an event stream (an extra; the batch form is the same plan)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed(events: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
