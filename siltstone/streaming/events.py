"""Windowed counts over event streams: an extension beyond code corpora."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str = "1 day", late: str | None = None) -> DataFrame:
    """(start, event_type, n, value) of windows of `width`; on a stream, events later than `late` are dropped."""
    rows = events.withWatermark("ts", late) if late else events
    out = rows.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("value"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "value")


def sliding(events: DataFrame, width: str = "2 days", slide: str = "1 day") -> DataFrame:
    """(start, n) of overlapping windows."""
    return events.groupBy(F.window("ts", width, slide)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "1 hour") -> DataFrame:
    """(user_id, start, n) of each user's runs of events with less than `gap` between them."""
    return events.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")
