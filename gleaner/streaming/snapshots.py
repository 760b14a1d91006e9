"""Snapshots as a stream: pages seen before are dropped, and events are counted by window.

Beyond the batch operators; for feeds that are read again and again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def new_pages(pages: DataFrame, at: str = "fetched_at", late: str = "1 day") -> DataFrame:
    """The pages (source_key, text, at) whose content was not seen within `late`; state is bounded by that watermark."""
    hashed = pages.withColumn("content_hash", F.sha2(F.coalesce("text", F.lit("")), 256))
    return hashed.withWatermark(at, late).dropDuplicatesWithinWatermark(["source_key", "content_hash"])


def window_counts(events: DataFrame, at: str, by: str, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """(start, by, n) of events by tumbling window; late ones count until the watermark passes."""
    counted = events.withWatermark(at, late).groupBy(F.window(at, width), F.col(by)).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), by, "n")
