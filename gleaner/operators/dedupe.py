"""Near-duplicate decisions in arrival order over bit fingerprints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scoring import hamming_similarity
from . import tiles


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a private one is made for local masters alone."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="gleaner-"))
    return sc.getCheckpointDir()


def _checkpoint(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint()


SLACK = 1.125  # lengths of one class: from its base up to so many times that
WORD_GROUP = 64  # prints that may share a word at its place and still meet on it
FIRST_ROWS = 8192  # undecided prints that one task decides in order
LINK_PLACES, LINK_WORDS = (0, 8, 16, 24, 32), 2  # where prints meet that most likely are copies, and on how many words
WAYS = ("all", "blocks", "words")


def length_classes(sizes: list[int], threshold: float) -> list[tuple[int, int]]:
    """(base, k) ascending: the class of a length is the greatest base up to it, and of any two prints whose shorter has a
    length of the class at most k of the first ``base`` words' bits differ."""
    classes: list[tuple[int, int]] = []
    sizes = sorted(sizes)
    for i, n in enumerate(sizes):
        if not classes or n > classes[-1][0] * SLACK:
            top = max(m for m in sizes[i:] if m <= n * SLACK)
            classes.append((n, int((1 - threshold) * 32 * top + 1e-9)))
    return classes


def _blocks(prints: DataFrame, classes: list[tuple[int, int]]) -> DataFrame:
    """(id, base, own, block, value) for every class whose base a print's length reaches; ``own`` marks its own class.

    The first ``base`` words are cut into k + 1 blocks of bits; as k bits may differ, one block at least is equal.
    """
    word = lambda x: F.lpad(F.conv(x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("string"), 10, 2), 32, "0")
    known = F.array(*(F.struct(F.lit(base).alias("base"), F.lit(k).alias("k")) for base, k in classes))
    fitting = F.filter(known, lambda c: c["base"] <= F.size("fp"))
    rows = prints.select("id", F.array_join(F.transform("fp", word), "").alias("bits"), fitting.alias("classes"))
    rows = rows.select("id", "bits", F.element_at("classes", -1)["base"].alias("last"), F.explode("classes").alias("c"))
    cut = F.expr("transform(sequence(0, c.k), i -> substring(bits, i * 32 * c.base div (c.k + 1) + 1, (i + 1) * 32 * c.base div (c.k + 1) - i * 32 * c.base div (c.k + 1)))")
    return rows.select("id", F.col("c.base").alias("base"), (F.col("c.base") == F.col("last")).alias("own"), F.posexplode(cut).alias("block", "value"))


def _met_on_blocks(prints: DataFrame, threshold: float) -> DataFrame:
    """(a, b): candidates among which every pair within the threshold is."""
    sizes = [r["n"] for r in prints.select(F.size("fp").alias("n")).where("n > 0").distinct().collect()]  # lengths, not rows
    if not sizes:
        return prints.select(F.col("id").alias("a"), F.col("id").alias("b")).limit(0)
    blocks = _checkpoint(_blocks(prints.where(F.size("fp") > 0), length_classes(sizes, threshold)))
    other = blocks.select("base", "block", "value", F.col("id").alias("other"), F.col("own").alias("other_own"))
    met = blocks.where("own").drop("own").join(other, ["base", "block", "value"]).where("id < other or (id > other and not other_own)")
    return met.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))


def _met_on_words(prints: DataFrame) -> DataFrame:
    """(a, b): prints that have one whole word in common at the same place; words of many prints (silence, say) tell nothing."""
    words = _checkpoint(prints.select("id", F.posexplode("fp").alias("place", "word")))
    few = words.groupBy("place", "word").agg(F.count("*").alias("n")).where(F.col("n").between(2, WORD_GROUP)).drop("n")
    shared = words.join(few, ["place", "word"])
    return shared.join(shared.withColumnRenamed("id", "other"), ["place", "word"]).where("id < other").select(F.col("id").alias("a"), F.col("other").alias("b"))


def _packed(prints: DataFrame, threshold: float | None = None) -> DataFrame:
    return tiles.packed(prints, _checkpoint, threshold)


def similar_prints(prints: DataFrame, threshold: float, by: str = "all") -> DataFrame:
    """(a, b, similarity), a before b, of distinct prints ``(id, fp)`` within the threshold over their common prefix.

    By ``all`` every print is compared with every other in tiles (``operators/tiles.py``): exact, and nothing but the result is sent.
    By ``blocks`` every such pair is found too: lengths fall into few classes, and all meet in one join on blocks of the prefix that a class is
    sure to share; this is for thresholds so near 1 that blocks are long (16 bits and more), else nearly all pairs are sent. By ``words``
    prints meet that share a whole word at its place, whatever their lengths: far fewer
    candidates, but a pair may be missed (a word stays whole with a chance of the similarity to the 32nd power, and prints have
    hundreds of words). Only ids travel; a pair is made once and then verified on its prints.
    """
    if by not in WAYS:
        raise ValueError(f"no way to meet by {by}")
    if by == "all":
        blocks = _packed(prints, threshold)
        return tiles.near_earlier(blocks, blocks, threshold).select(F.col("other").alias("a"), F.col("id").alias("b"), "similarity")
    met = _met_on_blocks(prints, threshold) if by == "blocks" else _met_on_words(prints)
    left = prints.select(F.col("id").alias("a"), F.col("fp").alias("fp_a"))
    right = prints.select(F.col("id").alias("b"), F.col("fp").alias("fp_b"))
    both = met.distinct().join(left, "a").join(right, "b")
    near = both.withColumn("similarity", hamming_similarity(F.col("fp_a"), F.col("fp_b"))).where(F.col("similarity") >= threshold)
    return near.select("a", "b", "similarity")


def _distinct_prints(prints: DataFrame) -> DataFrame:
    """(id, fp) once for each print; the id is the first ``ord`` that has it."""
    return prints.where(F.size("fp") > 0).groupBy("fp").agg(F.min("ord").alias("id")).select("id", "fp")


def similar_pairs(prints: DataFrame, threshold: float, by: str = "all") -> DataFrame:
    """(ord, other, similarity) of every earlier ``other`` within the threshold, for ``prints(ord, fp)``.

    All pairs are the result here, so copies are paired too; ``any_earlier`` and ``greedy`` need none of that. By ``all`` the
    pairs come from the tiles as they are and are neither stored nor sent.
    """
    if by == "all":
        blocks = _packed(prints.select(F.col("ord").alias("id"), "fp"), threshold)
        return tiles.near_earlier(blocks, blocks, threshold).withColumnRenamed("id", "ord")
    known = _checkpoint(_distinct_prints(prints))
    near = _checkpoint(similar_prints(known, threshold, by))
    own = known.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("similarity"))
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "similarity")).unionByName(own)
    member = prints.join(known, "fp").select("id", "ord")
    named = both.join(member.select(F.col("id").alias("a"), "ord"), "a").join(member.select(F.col("id").alias("b"), F.col("ord").alias("other")), "b")
    return named.where("other < ord").select("ord", "other", "similarity")


def _neighbours(prints: DataFrame, threshold: float, by: str) -> tuple[DataFrame, DataFrame]:
    """Rows (ord, id) with the first row of their print, and (id, other, similarity) both ways."""
    known = _checkpoint(_distinct_prints(prints))
    near = _checkpoint(similar_prints(known, threshold, by)).select(F.col("a").alias("id"), F.col("b").alias("other"), "similarity")
    both = near.unionByName(near.select(F.col("other").alias("id"), F.col("id").alias("other"), "similarity"))
    return _checkpoint(prints.join(known, "fp").select("ord", "id")), both


def _best(pairs: DataFrame) -> DataFrame:
    """(ord, duplicate_of, similarity): the most similar ``other`` of each row, the first on ties."""
    best = F.max(F.struct("similarity", (-F.col("other")).alias("o")))
    return pairs.groupBy("ord").agg(best.alias("b")).select("ord", (-F.col("b.o")).alias("duplicate_of"), F.col("b.similarity"))


def any_earlier(prints: DataFrame, threshold: float, by: str = "all") -> DataFrame:
    """(ord, duplicate_of, similarity): the best earlier neighbour, whether that was kept or not.

    A copy's best is its first copy, or what that equals over a shorter length and comes before it;
    so only first copies need their neighbours.
    """
    if by == "all":
        prints = tiles.comparable(prints)
        known = _checkpoint(_distinct_prints(prints))
        member, blocks = prints.join(known, "fp").select("ord", "id"), _packed(known, threshold)
        firsts = _checkpoint(tiles.best_earlier(blocks, blocks, threshold)).toDF("ord", "duplicate_of", "similarity")
    else:
        member, near = _neighbours(prints, threshold, by)
        firsts = _best(near.where("other < id").select(F.col("id").alias("ord"), "other", "similarity"))
    equal = firsts.where("similarity = 1").select(F.col("ord").alias("id"), F.col("duplicate_of").alias("before"))
    copies = member.where("ord <> id").join(equal, "id", "left")
    return firsts.unionByName(copies.select("ord", F.coalesce("before", "id").alias("duplicate_of"), F.lit(1.0).alias("similarity")))


def _without(rows: DataFrame, kept: DataFrame, fresh: DataFrame, threshold: float) -> DataFrame:
    """``rows(id, fp)`` but for those decided: the ids of ``fresh``, and those near an earlier one of ``kept(id, fp)``."""
    near = tiles.near_any(_packed(rows), _packed(kept), threshold)
    return _checkpoint(rows.join(fresh.unionByName(near).distinct(), "id", "left_anti"))


def _links(prints: DataFrame, threshold: float) -> DataFrame:
    """(id, other, similarity, alike) of some pairs of ``prints(id, fp)`` within the threshold, ``other`` being the smaller id; ``alike``: of one length.

    Each print is compared with the first that has the same few words at one of ``LINK_PLACES``. That finds most copies at a cost
    that grows with the prints; who uses it looks for the others among all pairs.
    """
    at = F.explode(F.array(*(F.lit(p) for p in LINK_PLACES)))
    words = prints.select("id", "fp", at.alias("place")).where(F.size("fp") >= F.col("place") + LINK_WORDS)
    met = _checkpoint(words.select("id", "place", F.xxhash64(F.slice("fp", F.col("place") + 1, LINK_WORDS)).alias("words")))
    first = met.groupBy("place", "words").agg(F.min("id").alias("other"), F.count("*").alias("n")).where("n > 1").drop("n")
    pairs = met.join(first, ["place", "words"]).where("other < id").select("id", "other").distinct()
    both = pairs.join(prints, "id").join(prints.select(F.col("id").alias("other"), F.col("fp").alias("fp_b")), "other")
    named = both.select("id", "other", hamming_similarity(F.col("fp"), F.col("fp_b")).alias("similarity"), (F.size("fp") == F.size("fp_b")).alias("alike"))
    return _checkpoint(named.where(F.col("similarity") >= threshold))


def _kept_by_links(rows: DataFrame, links: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame] | None:
    """(id, fp) of ``rows(id, fp)`` that are kept, and of those that stay undecided; or nothing, where that can't be told this way.

    Only rows without a link are compared with each other: those without an earlier neighbour there are the heads. If every other row has an
    earlier neighbour among the heads, the pass keeps just these: in order, a head has no neighbour among those kept before it, and any other row has one.
    Rows without such a neighbour are undecided; heads stand if none of those is an earlier neighbour of one.
    """
    own = links.join(rows.select("id"), "id", "left_semi").join(rows.select(F.col("id").alias("other")), "other", "left_semi")
    own = _checkpoint(own.select("id", "other"))
    free = _checkpoint(rows.join(own, "id", "left_anti"))
    blocks = _packed(free, threshold)
    heads = _checkpoint(free.join(tiles.near_any(blocks, blocks, threshold), "id", "left_anti"))
    led = own.join(heads.select(F.col("id").alias("other")), "other", "left_semi").select("id")
    rest = _checkpoint(rows.join(heads.select("id").unionByName(led).distinct(), "id", "left_anti"))
    if not rest.isEmpty():
        packed = _packed(heads)
        rest = _checkpoint(rest.join(tiles.near_any(_packed(rest), packed, threshold), "id", "left_anti"))
        if not rest.isEmpty() and not tiles.near_any(packed, _packed(rest), threshold).isEmpty():
            return None
    return heads, rest


def _kept(prints: DataFrame, seeds: DataFrame | None, threshold: float, first_rows: int, links: DataFrame | None) -> DataFrame:
    """(id, fp) of what one pass in order keeps of distinct ``prints(id, fp)``, and the ``seeds`` kept before.

    The first rows that are undecided go through one pass in a task; then all that are near what was kept leave. Where that leaves more
    than half, neighbours are few: all that ``_kept_by_links`` can tell of are decided at once, or else all rows that have no earlier
    undecided neighbour are kept at once. Every round decides ``first_rows`` at least, and no other neighbours than ``links`` are stored.
    """
    kept, rows = prints.limit(0), _checkpoint(prints)
    if seeds is not None:
        kept = _checkpoint(seeds)
        rows = _without(rows, kept, kept.select("id"), threshold)
    n = rows.count()
    while n:
        last = rows.orderBy("id").limit(first_rows).agg(F.max("id")).first()[0] if n > first_rows else None
        first = rows if last is None else rows.where(F.col("id") <= last)
        new = _checkpoint(rows.join(tiles.kept_of_first(first, threshold, first_rows), "id", "left_semi").select("id", "fp"))
        kept = kept.unionByName(new)
        if last is None:
            break
        rows = _without(rows.where(F.col("id") > last), new, new.select("id"), threshold)
        left = rows.count()
        if left > max(first_rows, n // 2):
            told = _kept_by_links(rows, links, threshold)
            if told:
                new, rows = told
                kept = kept.unionByName(new)
            else:
                blocks = _packed(rows, threshold)
                new = _checkpoint(rows.join(tiles.near_any(blocks, blocks, threshold), "id", "left_anti"))
                kept = kept.unionByName(new)
                rows = _without(rows, new, new.select("id"), threshold)
            left = rows.count()
        n = left
    return _checkpoint(kept)


def greedy(prints: DataFrame, threshold: float, stored: DataFrame | None = None, by: str = "all", first_rows: int = FIRST_ROWS) -> DataFrame:
    """(ord, duplicate_of) where only kept rows block later ones; null for kept rows.

    ``stored(ord, fp)`` are prints that were kept before, with orders below all others: they block and are not
    part of the result. Copies follow their first copy. The result is that of one pass in order. Rows without a print are kept.
    By ``all``, rows are compared with kept ones only (``_kept``), so the work is that of rows times kept rows; for those that a cheap link
    leads to their best kept row it is that of reading them (``_led``).
    Otherwise neighbours are found first; rows without an undecided or kept
    earlier neighbour are kept, rows with a kept one dropped, until none is undecided; each round
    is checkpointed.
    """
    if by == "all":
        return _greedy_by_all(prints, threshold, stored, first_rows)
    return _greedy_by_neighbours(prints, threshold, stored, by)


def _led(prints: DataFrame, known: DataFrame, kept: DataFrame, links: DataFrame, threshold: float) -> DataFrame:
    """(id, other) of those ``prints(id, fp)`` whose best kept row ``other`` is sure from a link alone. No two of ``kept(id, fp)`` are within the threshold.

    Bits that differ obey the triangle inequality. Over m words, any other kept row differs from ``other`` in more than (1 - threshold) * 32 * m bits, so from
    a row that is d bits from that one in more than these less d. With d small enough for both lengths that is a lesser similarity than that with ``other``.
    """
    least = kept.agg(F.min(F.size("fp"))).first()[0] or 0
    m = F.least(F.size("fp"), F.lit(least))
    sure = (1 - F.col("similarity")) * (F.size("fp") + m) < (1 - threshold) * m * (1 - 1e-9)
    best = links.where("alike").join(kept.select(F.col("id").alias("other")), "other", "left_semi").join(known, "id").where(sure).select("id", "other")
    best = best.unionByName(kept.select("id", F.col("id").alias("other")))
    member = prints.join(known.withColumnRenamed("id", "first"), "fp").select("id", "first")
    return member.join(best.withColumnRenamed("id", "first"), "first").where("id <> other").select("id", "other").distinct()


def _greedy_by_all(prints: DataFrame, threshold: float, stored: DataFrame | None, first_rows: int) -> DataFrame:
    seeds = None if stored is None else tiles.comparable(_distinct_prints(stored))
    known = _checkpoint(_distinct_prints(prints))
    fresh = known if stored is None else known.join(_distinct_prints(stored).select("fp"), "fp", "left_anti").select("id", "fp")
    fresh = tiles.comparable(fresh)
    links = _links(fresh, threshold) if known.count() > first_rows else None
    kept = _kept(fresh, seeds, threshold, first_rows, links)
    rows = prints.select(F.col("ord").cast("long").alias("id"), "fp")
    rows = rows if stored is None else rows.join(stored.select(F.col("ord").alias("id")), "id", "left_anti")
    open_ = rows.join(kept, "id", "left_anti")
    if stored is None and links is not None:
        led = _checkpoint(_led(tiles.comparable(open_), fresh, kept, links, threshold))
        reason = tiles.best_earlier(_packed(open_.join(led, "id", "left_anti")), _packed(kept), threshold).select("id", "other").unionByName(led)
    else:
        reason = tiles.best_earlier(_packed(open_), _packed(kept), threshold)
    found = rows.select("id").join(reason.select("id", F.col("other").alias("duplicate_of")), "id", "left")
    return found.select(F.col("id").alias("ord"), F.col("duplicate_of").cast("long"))


def _greedy_by_neighbours(prints: DataFrame, threshold: float, stored: DataFrame | None, by: str) -> DataFrame:
    old = stored.select("ord", "fp", F.lit(True).alias("kept")) if stored is not None else None
    rows = prints.select("ord", "fp", F.lit(None).cast("boolean").alias("kept"))
    rows = rows if old is None else rows.unionByName(old)
    member, near = _neighbours(rows, threshold, by)
    edges = _checkpoint(near.where("other < id").select(F.col("id").alias("ord"), "other", "similarity"))
    seeds = rows.where("kept").select("ord", "kept")
    state = _checkpoint(member.where("ord = id").select("ord").join(seeds, "ord", "left"))
    while state.where("kept is null").limit(1).count():
        seen = edges.join(state.select(F.col("ord").alias("other"), F.col("kept").alias("other_kept")), "other")
        around = seen.groupBy("ord").agg(
            F.coalesce(F.bool_or("other_kept"), F.lit(False)).alias("blocked"),
            F.bool_or(F.col("other_kept").isNull()).alias("open"),
        )
        joined = state.join(around, "ord", "left")
        state = _checkpoint(
            joined.select(
                "ord",
                F.when(F.col("kept").isNotNull(), F.col("kept"))
                .when(F.coalesce("blocked", F.lit(False)), F.lit(False))
                .when(~F.coalesce("open", F.lit(False)), F.lit(True))
                .alias("kept"),
            )
        )
    kept = state.where("kept").select(F.col("ord").alias("other"))
    own = kept.select(F.col("other").alias("id"), "other", F.lit(1.0).alias("similarity"))
    blockers = near.join(kept, "other").select("id", "other", "similarity").unionByName(own)
    reason = _best(member.join(blockers, "id").where("other < ord").select("ord", "other", "similarity"))
    found = member.select("ord").join(reason.select("ord", "duplicate_of"), "ord", "left")
    bare = prints.where("fp is null or size(fp) = 0").select("ord", F.lit(None).cast("long").alias("duplicate_of"))
    new = prints.select("ord") if old is None else prints.select("ord").join(old, "ord", "left_anti")
    return found.select("ord", F.col("duplicate_of").cast("long")).unionByName(bare).join(new, "ord", "left_semi")


def first_copies(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key by ``order``."""
    w = Window.partitionBy(key).orderBy(order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
