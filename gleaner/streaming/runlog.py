"""Continuous forms of the audit: windowed decision counts and first-seen hits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def decision_counts(log: DataFrame, time: str = "ts", every: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Decisions counted in tumbling windows of event time; rows later than ``late`` are let go."""
    stamped = log.withColumn(time, F.col(time).cast("timestamp"))
    counted = stamped.withWatermark(time, late).groupBy(F.window(time, every), "decision").count()
    return counted.select(F.col("window.start").alias("start"), "decision", "count")


def first_seen(hits: DataFrame, key: str = "recording_id", time: str = "ts", late: str = "2 hours") -> DataFrame:
    """Each key once while the watermark remembers it."""
    stamped = hits.withColumn(time, F.col(time).cast("timestamp"))
    return stamped.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
