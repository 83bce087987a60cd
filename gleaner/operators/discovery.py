"""Query variants, contributors and multi-round discovery."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.search import Fetch, search
from .dedupe import _checkpoint, first_copies


def numbered(rows: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """The rows with their position, from 1, in the order of the given columns; no task sees more than a range of them.

    Rows that are equal in all of ``order`` are numbered in any order.
    """
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id())
    placed = _checkpoint(sorted_).withColumn("_part", F.shiftright("_place", 33))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("n"), F.min("_place").alias("_first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row a partition
    starts = sizes.select("_part", "_first", before.alias("_before"))
    return placed.join(starts, "_part").withColumn(name, F.col("_before") + F.col("_place") - F.col("_first") + 1).drop("_part", "_place", "_first", "_before")


def interleave(rows: DataFrame, variant: str, within: str, by: str | None = None) -> DataFrame:
    """``pos`` numbers rows round-robin over the variants: first of each, then second of each; inside ``by`` if given."""
    keys = [by] if by else []
    turn = F.row_number().over(Window.partitionBy(*keys, variant).orderBy(within))
    rows = rows.withColumn("_turn", turn)
    if not by:
        return numbered(rows, "_turn", variant).drop("_turn")
    whole = Window.partitionBy(by).orderBy("_turn", variant)
    return rows.withColumn("pos", F.row_number().over(whole)).drop("_turn")


def seeded_order(value: Column, seed: int) -> Column:
    """A key that orders values at random, the same way for the same seed."""
    return F.xxhash64(F.lit(seed), value)


def ordered_distinct(rows: DataFrame, value: str, order: str) -> DataFrame:
    """The first row of each value, trimmed and in any case; empty values are dropped."""
    keyed = rows.withColumn("_key", F.lower(F.trim(value))).where("_key <> ''")
    return first_copies(keyed, "_key", order).drop("_key")


def top_contributors(hits: DataFrame, channel: str, order: str, k: int = 5) -> DataFrame:
    """The k channels with most hits; ties go to the one seen first."""
    counted = hits.where(F.col(channel).isNotNull()).groupBy(channel).agg(F.count("*").alias("hits"), F.min(order).alias("first_seen"))
    return counted.orderBy(F.desc("hits"), "first_seen").limit(k)


def discover(
    fetch: Callable[[int, DataFrame], DataFrame], seen: DataFrame, key: str = "recording_id", order: str = "ord",
    max_rounds: int = 3, patience: int = 2, limit: int = 0,
) -> DataFrame:
    """Hits of successive rounds that no earlier round or ``seen`` has, first source order first.

    ``fetch(round, hits so far)`` gives a round's hits with ``key`` and ``order``. Stops after
    ``max_rounds``, after ``patience`` empty rounds in a row, or at ``limit`` hits (0: none).
    """
    hits, empty, total = None, 0, 0
    known = seen.select(key)
    for n in range(1, max_rounds + 1):
        found = fetch(n, hits if hits is not None else seen.limit(0))
        new = first_copies(found.join(known, key, "left_anti"), key, order).withColumn("round", F.lit(n))
        new = _checkpoint(new)
        fresh = new.count()
        total += fresh
        hits = new if hits is None else hits.unionByName(new)
        known = known.unionByName(new.select(key))
        empty = 0 if fresh else empty + 1
        if empty >= patience or (limit and total >= limit):
            break
    return hits.orderBy("round", order).limit(limit) if limit else hits


CHANNEL_LISTING = "https://www.youtube.com/channel/%s/videos"


def search_rounds(
    queries: DataFrame, fetch: Fetch, seen: DataFrame, most: int = 100, channels: int = 5, channel_most: int = 300,
    listing: str = CHANNEL_LISTING, max_rounds: int = 3, patience: int = 2, limit: int = 0,
) -> DataFrame:
    """Hits of ``queries(query, source_ord)`` over rounds; from the second on, of the best channels so far as well.

    Channels (ids that begin with UC) are ranked by hits, the one seen first on ties, and their listings are searched
    after all queries. ``place`` is (source, hit), the order inside a round.
    """
    asked = queries.select("query", F.col("source_ord").cast("int").alias("source_ord"), F.lit(most).alias("most"))

    def fetch_round(n: int, hits: DataFrame) -> DataFrame:
        sources = asked
        if n > 1 and channels:
            known = hits.withColumn("channel_id", F.trim("channel_id")).where("channel_id like 'UC%'")
            best = top_contributors(known.withColumn("first", F.struct("round", "place")), "channel_id", "first", channels)
            ranked = best.withColumn("source_ord", F.row_number().over(Window.orderBy(F.desc("hits"), "first_seen")))  # a few rows
            after = F.lit(1 << 30) + F.col("source_ord")
            sources = asked.unionByName(ranked.select(F.format_string(listing, "channel_id").alias("query"), after.alias("source_ord"), F.lit(channel_most).alias("most")))
        return search(sources, fetch).withColumn("place", F.struct("source_ord", "hit_ord"))

    return discover(fetch_round, seen, "recording_id", "place", max_rounds, patience, limit)


def chosen(categories: DataFrame, slugs: str | None = None) -> DataFrame:
    """The categories that a comma list names, or all; a name that isn't there fails the job."""
    if slugs is None:
        return categories
    wanted = [s.strip() for s in slugs.split(",") if s.strip()]
    named = categories.sparkSession.createDataFrame([(s,) for s in wanted], "folder_slug string").distinct()
    known = named.join(categories.select("folder_slug", F.lit(True).alias("_known")), "folder_slug", "left")
    checked = known.select(F.when(F.col("_known"), F.col("folder_slug")).otherwise(F.raise_error(F.concat(F.lit("unknown category: "), "folder_slug"))).alias("folder_slug"))
    return categories.join(checked, "folder_slug").select(categories.columns)


def first_candidates(found: DataFrame, limit: int | None, order: str = "ord") -> DataFrame:
    """The first ``limit`` candidates in the order of discovery, as the feature asks; all without a limit (none or 0)."""
    return found.orderBy(order).limit(limit) if limit else found


def category_report(counts: DataFrame, category: str = "category") -> DataFrame:
    """Rows of counts sorted by category, the row of totals (``TOTAL``) last."""
    numbers = [c for c in counts.columns if c != category]
    total = counts.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers)).withColumn(category, F.lit("TOTAL"))
    both = counts.withColumn("_last", F.lit(0)).unionByName(total.withColumn("_last", F.lit(1)))
    return both.orderBy("_last", category).drop("_last")
