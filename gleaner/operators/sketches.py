"""Audit reports from sketches: each batch of the log leaves a few small rows, and any report merges those.

A row holds, for one category and decision, the number of records, a HyperLogLog sketch of their ids (how many distinct ones;
``2 ** ID_BITS`` registers, a standard error of about 1.04 / sqrt of that, 1.6 %) and a KLL sketch of their scores (quantiles; with ``SCORE_K`` a rank
error of about 1.7 % at 99 % confidence). Merged sketches are as good as one made of all records at once, whatever the batches were.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ID_BITS, SCORE_K = 12, 200
ID_ERROR, RANK_ERROR = 0.016, 0.017
BY = ("category_slug", "decision")


def summarise(records: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """(*by, records, ids, scores) of a batch ``(recording_id, *by, final_score)``; ids and scores are sketches, null scores count nowhere."""
    ids = F.hll_sketch_agg(F.col("recording_id").cast("string"), F.lit(ID_BITS))
    return records.groupBy(*by).agg(F.count("*").alias("records"), ids.alias("ids"), F.kll_sketch_agg_double("final_score", F.lit(SCORE_K)).alias("scores"))


def merged(sketches: DataFrame, by: Sequence[str] = BY) -> DataFrame:
    """Rows of ``summarise`` made one a group of ``by``, which may be fewer columns than they were made by, or none."""
    return sketches.groupBy(*by).agg(F.sum("records").alias("records"), F.hll_union_agg("ids").alias("ids"), F.kll_merge_agg_double("scores", F.lit(SCORE_K)).alias("scores"))


def report(sketches: DataFrame, by: Sequence[str] = BY, quantiles: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """(*by, records, distinct_ids, quantiles): the merged sketches read off; quantiles are null where no record has a score."""
    wanted = F.array(*map(F.lit, quantiles))
    known = F.kll_sketch_get_n_double("scores") > 0
    return merged(sketches, by).select(
        *by, "records", F.hll_sketch_estimate("ids").alias("distinct_ids"), F.when(known, F.kll_sketch_get_quantile_double("scores", wanted)).alias("quantiles")
    )


def share_below(scores: Column, limit: float) -> Column:
    """The share of a sketch's scores up to a limit: how many a threshold would let go."""
    return F.kll_sketch_get_rank_double(scores, F.lit(limit))


def append_sketches(records: DataFrame, path: str, by: Sequence[str] = BY) -> None:
    summarise(records, by).write.mode("append").parquet(path)


def stored_report(spark: SparkSession, path: str, by: Sequence[str] = BY, quantiles: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """The report over all batches that were appended; only sketches are read."""
    return report(spark.read.parquet(path), by, quantiles)
