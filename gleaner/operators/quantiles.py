"""Exact quantiles of groups of any size: no task holds a group's values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dedupe import _checkpoint


def exact_quantiles(rows: DataFrame, key: str, value: str, quantiles: Sequence[float]) -> DataFrame:
    """(key, quantile, value): quantiles of each key's values, between two of them by their distance.

    Rows are sorted by range and numbered, so a large group lies over many partitions; how many values of
    a key each partition holds says where a rank is, and only the values at the ranks are fetched. Null and NaN values are left out, a
    null key is a key; the value column is a double.
    """
    known = rows.select(F.col(key).alias("key"), F.col(value).cast("double").alias("value")).where("value is not null and not isnan(value)")
    placed = known.repartitionByRange("key", "value").sortWithinPartitions("key", "value").withColumn("place", F.monotonically_increasing_id())
    placed = _checkpoint(placed)
    run = placed.groupBy("key", F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n"), F.min("place").alias("first"))
    whole, before = Window.partitionBy("key"), Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    run = run.withColumns({"total": F.sum("n").over(whole), "before": F.coalesce(F.sum("n").over(before), F.lit(0))})  # a row a key and partition
    asked = run.withColumn("quantile", F.explode(F.array(*map(F.lit, map(float, quantiles))))).withColumn("rank", F.col("quantile") * (F.col("total") - 1))
    low = F.floor("rank")
    ends = asked.withColumns({"share": F.col("rank") - low, "at": F.explode(F.array_distinct(F.array(low, F.ceil("rank"))))})
    ends = ends.where("at >= before and at < before + n").select("key", "quantile", "share", "at", (F.col("first") + F.col("at") - F.col("before")).alias("place"))
    met = ends.join(placed.select("place", "value"), "place").groupBy("key", "quantile").agg(F.min_by("value", "at").alias("a"), F.max_by("value", "at").alias("b"), F.first("share").alias("share"))
    return met.select(F.col("key").alias(key), "quantile", (F.col("a") + (F.col("b") - F.col("a")) * F.col("share")).alias(value))
