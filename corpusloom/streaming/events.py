"""Structured Streaming forms of the history operators. An extension: the batch forms are the reference semantics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicated(stream: DataFrame, keys: list[str], time: str, late: str) -> DataFrame:
    """The first event of each key within the watermark; state older than it is dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def latest_uses(stream: DataFrame, owner: str, item: str, time: str) -> DataFrame:
    """Move to front as a running table: last use and number of uses of each item; update or complete mode."""
    return stream.groupBy(owner, item).agg(F.max(time).alias("last_used"), F.count("*").alias("uses"))


def change_feed(stream: DataFrame, *keys: str) -> DataFrame:
    """Full counts, emitted again after each change; complete mode."""
    return stream.groupBy(*keys).agg(F.count("*").alias("n"))


def windowed_counts(stream: DataFrame, time: str, late: str, width: str, *keys: str) -> DataFrame:
    """Counts in tumbling windows; a window leaves once the watermark has passed it (append mode)."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), *keys).agg(F.count("*").alias("n")).select("window.start", "window.end", *keys, "n")


def live_items(stream: DataFrame, owner: str, item: str, time: str, ttl: str) -> DataFrame:
    """Sessions of use: an item expires ``ttl`` after its last use."""
    return stream.withWatermark(time, ttl).groupBy(F.session_window(time, ttl), owner, item).agg(F.count("*").alias("uses")).select(owner, item, "uses", F.col("session_window.start").alias("since"), F.col("session_window.end").alias("expires"))
