"""Sessions over an event stream: the streaming form of islands, with time in place of position."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions(events: DataFrame, key: str = "user_id", ts: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(key, start, end, n) of runs of events no more than ``gap`` apart; works on batches and streams."""
    rows = events.withColumn("__ts", F.col(ts).cast("timestamp"))
    if rows.isStreaming:
        rows = rows.withWatermark("__ts", late)
    got = rows.groupBy(F.col(key), F.session_window("__ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return got.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
