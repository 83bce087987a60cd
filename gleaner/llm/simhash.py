"""SimHash near-duplicate groups by a segment-popcount embedding.

A 64-bit fingerprint becomes the vector of bit counts of its 32 two-bit segments. The
Manhattan distance of two such vectors never exceeds the Hamming distance of the
fingerprints. Every count is kept in thermometer code (0, 1, 2 as 00, 01, 11), so the whole
vector fits a long and the Manhattan distance is one XOR and one bit count.

The grid: the 32 coordinates form groups, four for a small table and more for a large one, so that
cells stay small. Vectors within Manhattan distance 2 differ in two groups at most; a grid
leaves two groups free and has the coordinates of all others for its axes (six grids for
four groups), and one more axis, cut in bins: the sum of the free coordinates, which differs by
2 at most. Vectors are joined with those of their cell and of the bins in range. Pairs so met
pass the Manhattan bound and are then verified exactly.

A column of bins with more than ``HOT_CELL`` fingerprints is not paired off. Its members are expanded to
their 65 values within one bit; two fingerprints are within two bits exactly if they share
such a value, and a star on the smallest member links all that share one. This is linear in
the number of fingerprints and loses no link.

Defined cases: a null or empty text has fingerprint zero and is linked like any other; rows
with equal fingerprints form one group; a row whose ``doc_id`` is null gets the component of
its fingerprint, or null if no row with an id has that fingerprint; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from .common import materialize
from .graph import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 2
HOT_CELL = 256
RANGE_BIN = 3
GRIDS = ((1 << 20, 4), (1 << 28, 6), (1 << 33, 8), (1 << 62, 12))  # groups for tables of up to so many fingerprints
_BLOCK = 1 << 16
_LOW_BITS = 0x5555555555555555


def fingerprint_of(text: str | None) -> int:
    """Signed 64-bit SimHash of the word shingles of one text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)), strict=False)))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), _BLOCK):
        part = shingles[at : at + _BLOCK]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, part, repeat(42)), np.uint64, len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(shingles), bitorder="little").view(np.int64)[0])


@pandas_udf(LongType())
def fingerprint(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint_of(t) for t in texts], dtype="int64")


def segment_counts(fp: Column) -> Column:
    """The 32 two-bit segment counts of a fingerprint, in thermometer code."""
    low = F.lit(_LOW_BITS)
    right = F.shiftrightunsigned(fp, 1)
    any_bit = fp.bitwiseOR(right).bitwiseAND(low)
    both_bits = fp.bitwiseAND(right).bitwiseAND(low)
    return any_bit.bitwiseOR(F.shiftleft(both_bits, 1))


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _cells(nodes: DataFrame, groups: int) -> DataFrame:
    """A row (grid, fixed, free, node, fp, counts) for each distinct fingerprint and grid.

    ``fixed`` holds the coordinates that are axes of the grid, ``free`` the sum of the others.
    """
    edges = [2 * (32 * i // groups) for i in range(groups + 1)]
    bits = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    signed = lambda mask: mask - (1 << 64) if mask >> 63 else mask
    masks = F.array(*(F.lit(signed(bits[i] | bits[j])).cast("long") for i, j in combinations(range(groups), 2)))
    rows = nodes.withColumn("counts", segment_counts(F.col("fp"))).select("node", "fp", "counts", F.posexplode(masks).alias("grid", "mask"))
    return rows.select(
        "grid",
        F.col("counts").bitwiseAND(F.bitwise_not("mask")).alias("fixed"),
        F.bit_count(F.col("counts").bitwiseAND(F.col("mask"))).alias("free"),
        "node",
        "fp",
        "counts",
    )


def _links_by_flips(nodes: DataFrame) -> DataFrame:
    """Star links among fingerprints that share a value within one bit of each."""
    one_bit = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    near = F.concat(F.array("fp"), F.transform(one_bit, lambda bit: F.col("fp").bitwiseXOR(bit)))
    reach = nodes.select(F.explode(near).alias("value"), "node")
    least = reach.groupBy("value").agg(F.min("node").alias("v"), F.count("*").alias("n")).where("n > 1").drop("n")
    return reach.join(least, "value").where("node <> v").select(F.col("node").alias("u"), "v").distinct()


def fingerprint_links(nodes: DataFrame, hot_cell: int = HOT_CELL, groups: int | None = None) -> DataFrame:
    """(u, v) links that connect all ``nodes(node, fp)`` within two bits; fp is distinct."""
    if groups is None:
        n = nodes.count()
        groups = next(g for most, g in GRIDS if n <= most)
    cells = materialize(_cells(nodes, groups))
    sizes = cells.groupBy("grid", "fixed").agg(F.count("*").alias("size")).where("size > 1")
    kept = cells.join(sizes, ["grid", "fixed"])
    hot = kept.where(F.col("size") > hot_cell).select("node", "fp").distinct()
    mild = kept.where(F.col("size") <= hot_cell).drop("size")
    bin_of = lambda x: F.floor(x / RANGE_BIN)
    in_range = F.explode(F.sequence(bin_of(F.col("free") - MAX_BITS), bin_of(F.col("free") + MAX_BITS)))
    other = mild.select("grid", "fixed", in_range.alias("bin"), *(F.col(c).alias(f"{c}_b") for c in ("node", "fp", "counts")))
    pairs = (
        mild.withColumn("bin", bin_of(F.col("free")))
        .join(other, ["grid", "fixed", "bin"])
        .where(F.col("node") < F.col("node_b"))
        .where(_distance("counts", "counts_b") <= MAX_BITS)
        .where(_distance("fp", "fp_b") <= MAX_BITS)
        .select(F.col("node").alias("u"), F.col("node_b").alias("v"))
    )
    return pairs.unionByName(_links_by_flips(hot)).distinct()


def near_duplicates(docs: DataFrame, hot_cell: int = HOT_CELL) -> DataFrame:
    """(doc_id, fp, component_id) for each row of ``docs(doc_id, text)``."""
    marked = materialize(docs.select("doc_id", fingerprint("text").alias("fp")))
    nodes = materialize(
        marked.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    )
    groups = connected_components(fingerprint_links(nodes, hot_cell))
    label = nodes.join(groups, "node", "left").select(
        F.col("fp").alias("label_fp"), F.coalesce("component", "node").alias("component_id")
    )
    return marked.join(label, marked["fp"] == label["label_fp"], "left").select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, further: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> DataFrame:
    """The rows of ``docs`` that are first (smallest id) in their group; rows without an id stay.

    Groups are those of the fingerprints. ``further(docs, groups)`` may check them exactly and link what they don't
    reach (``jaccard.checked_and_extended``); it gives (doc_id, component_id).
    Rows that share an id are one document: of those, the one whose text has the least MD5 stays.
    """
    found = near_duplicates(docs)
    if further:
        found = further(docs, materialize(found))
    first = found.where("doc_id = component_id").select("doc_id").distinct()
    with_id = docs.where("doc_id is not null").join(first, "doc_id", "left_semi")
    one = F.min_by(F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    # The aggregate reads the exchange that the join made.
    kept = with_id.groupBy("doc_id").agg(one.alias("row")).select("row.*")
    return kept.unionByName(docs.where("doc_id is null"))
