"""Connected components by alternating star contractions on an edge table.

Links are contracted where they stand first: what a task holds is made into stars, each node under the least of those it
reaches there. No link is lost by that, none is added, and most rounds are saved.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize

SALTS = 8  # parts that the links of one node are dealt over
BLOCK = 1 << 18  # links that a task contracts at once


def least_reached(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the links (u, v), and for each the least one that these links connect it with."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))  # only roots are hung elsewhere
        while (root[root] != root).any():
            root = root[root]
    return nodes, nodes[root]


def _contracted(edges: DataFrame, by_node: bool = False) -> DataFrame:
    """Stars that connect what ``edges(u, v)`` connect, made of some ``BLOCK`` links of a partition at once.

    ``by_node``: partitions are sorted by u, and no u is cut. What comes out of a block has a u once, so a later cut by node gathers a row a block.
    """

    def stars(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def flushed(u: np.ndarray, v: np.ndarray) -> pd.DataFrame:
            nodes, least = least_reached(u, v)
            return pd.DataFrame({"u": nodes[nodes != least], "v": least[nodes != least]})

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= BLOCK:
                u, v = (np.concatenate([x[c].to_numpy() for x in held]) for c in ("u", "v"))
                end = int(np.searchsorted(u, u[-1])) if by_node else len(u)
                if end:
                    yield flushed(u[:end], v[:end])
                held = [pd.DataFrame({"u": u[end:], "v": v[end:]})]
                rows = len(u) - end
        if rows:
            yield flushed(*(np.concatenate([x[c].to_numpy() for x in held]) for c in ("u", "v")))

    return edges.mapInPandas(stars, edges.schema)


def _gathered(edges: DataFrame) -> DataFrame:
    """The same with the stars of all partitions contracted again, where those of a node meet."""
    return _contracted(_contracted(edges).repartition("u").sortWithinPartitions("u"), by_node=True)


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is u of one link and v of none, or v only."""
    ends = F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"))))
    seen = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("least"))
    return seen.where("up > 1 or (up = 1 and least = 0)").agg(F.count("*")).first()[0] == 0


def _with_least(links: DataFrame, least: DataFrame) -> DataFrame:
    """``links(u, v)`` with the value of their u; the links of a hub are dealt over ``SALTS`` tasks."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    return dealt.join(least.withColumn("salt", salts), ["u", "salt"]).drop("salt")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return _with_least(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(u, v)``; component is its smallest node.

    Loops and repeated edges are ignored. Each round writes the edge table to the shared
    folder, so a lost executor costs one round; the number of rounds grows with the
    logarithm of the longest path. Only whether all links are stars reaches the driver.
    """
    down = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialize(_gathered(down))
    while not _all_stars(edges):
        last, edges = edges, materialize(_gathered(_large_star(_contracted(edges))))
        discard(last)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
