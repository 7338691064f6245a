"""Windows over the event stream: an extension without counterpart in the catalog's own operators.

Each function works on a batch and on a stream alike; on a stream it takes a watermark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _marked(events: DataFrame, late: str) -> DataFrame:
    """A watermark for a stream; watermarks need a timestamp with a time zone."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late) if events.isStreaming else events


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Counts and sums by window and type; ``slide`` makes the windows overlap."""
    rows = _marked(events, late)
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return rows.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a user: events no further apart than ``gap``."""
    rows = _marked(events, late)
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "user_id", "n")
