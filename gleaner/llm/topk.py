"""Exact top-k inner products by a three-phase uniform threshold.

Components become integers, floor(256 * x). A vector is cut into ``SITES`` parts, and each part
is a site with local scores: the inner product of query and candidate over that part alone. The
score of a candidate is the sum of its local scores.

Phase 1: every task finds, for each query and site, the candidates with the ``LEADERS`` times k
best local scores of a tile. The full score of these leaders is the sum of their local ones; the k-th best among the leaders of all
tasks is one that k candidates are known to reach, the safe cutoff of the query. Phase 2: the
cutoffs go out with the queries. Sites are scored one after another, and a candidate stays only
while it has a sufficient entry (a local score of cutoff / sites or more, without which no sum
reaches the cutoff) or its query may still get one in the tile, and while what it has, with the most that the
lengths of the parts left allow, reaches the cutoff. Phase 3: where few candidates are left, their
remaining local scores are resolved one by one, exactly. The k best of those that reach the
cutoff are the result; it is exact for any data.

Vectors are packed into tiles and queries into blocks of about ``BLOCK``; every tile meets every
block of its length. Blocks go out in waves of ``BROADCAST_BYTES``, a size that is known from their number; each
wave is broadcast and answered for good before the next, so tiles are read once a wave where they lie and never
shuffled. Only short lists are.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part;
only candidates of the query's length are compared; rows that repeat a query's id are the
query's own and no candidates of it; repeated candidate rows each count; repeated query rows
are answered once; null ids are candidates of nobody; fewer than k candidates give fewer rows;
scores must fit a 64-bit integer, or the job fails rather than return a wrong one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

K = 5
SITES = 4
BLOCK = 1024
SCALE = 256
LEADERS = 8
FEW = 0.25  # share of candidates left below which they are resolved one by one; it sets the time that takes, never the result
BROADCAST_BYTES = 8 << 20
_TILE_ROWS, _TILE_BYTES = 2048, 4 << 20
_SCORES, _LIST = "query_id long, score long", "query_id long, score long, vec_id long"
_NONE = -(1 << 63)


def _integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, v) with integer-valued double components; rows that take no part are left out."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("double"))
    fits = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = vectors.where("vec_id is not null and embedding is not null and size(embedding) > 0").where(fits)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), scaled.alias("v"))


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tiles (dim, ids, data) of neighbouring rows of like length, bounded in rows and bytes."""
    for batch in batches:
        for dim, part in batch.groupby("dim"):
            rows = max(1, min(_TILE_ROWS, _TILE_BYTES // (8 * int(dim))))
            for at in range(0, len(part), rows):
                cut = part.iloc[at : at + rows]
                data = np.stack(cut["v"].to_numpy()).astype(np.float64)
                yield pd.DataFrame({"dim": [dim], "ids": [cut["vec_id"].to_numpy("int64").tobytes()], "data": [data.tobytes()]})


def _pack_block(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    cuts = rows["cut"].to_numpy("int64").tobytes()
    data = np.stack(rows["v"].to_numpy()).astype(np.float64).tobytes()
    return pd.DataFrame({"block": [key[0]], "dim": [key[1]], "query_ids": [rows["vec_id"].to_numpy("int64").tobytes()], "cuts": [cuts], "queries": [data]})


def _numbers(q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Queries and rows in the narrowest numbers in which all their products are exact: singles, doubles, else Python integers.

    No partial sum of an inner product of integers is above the product of the lengths.
    """
    most = np.linalg.norm(q, axis=1).max(initial=0) * np.linalg.norm(v, axis=1).max(initial=0)
    if most < 2**50:
        kind = np.float32 if most < 2**24 else np.float64
        return q.astype(kind), v.astype(kind)
    return _whole(q), _whole(v)


def _whole(m: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape)


def _lengths(m: np.ndarray, sites: list[slice]) -> np.ndarray:
    """The length of each row's part at each site, as doubles."""
    return np.stack([np.linalg.norm(m[:, s].astype(np.float64), axis=1) for s in sites], axis=1)


def _sites(dim: int) -> list[slice]:
    edges = np.linspace(0, dim, min(SITES, dim) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def _own(query_ids: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a query and a row with its own id."""
    columns = np.flatnonzero(np.isin(ids, query_ids))
    at, which = np.nonzero(query_ids[:, None] == ids[columns][None, :])
    return at, columns[which]


def leading(q: np.ndarray, v: np.ndarray, own: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Phase 1: scores of the pairs (query, row) that are among the n best of a query at some site, ties included; -inf elsewhere."""
    chosen, total = np.zeros((len(q), len(v)), bool), 0
    last = max(0, len(v) - n)
    for s in _sites(q.shape[1]):
        local = q[:, s] @ v[:, s].T
        local[own] = -np.inf
        total = total + local
        chosen |= local >= np.partition(local, last, axis=1)[:, [last]]
    return np.where(chosen, total, -np.inf)


def leaders(q: np.ndarray, v: np.ndarray, own: tuple[np.ndarray, np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1: the pairs themselves."""
    return np.nonzero(leading(q, v, own, n) > -np.inf)


def _best(score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best finite scores of each query: its place, and the score. They are taken one by one, as partitions are slow where most is -inf."""
    row, rest, best = np.arange(len(score)), score.copy(), np.full((len(score), k), -np.inf, score.dtype)
    for n in range(k):
        at = rest.argmax(axis=1)
        best[:, n] = rest[row, at]
        rest[row, at] = -np.inf
    qi, nth = np.nonzero(best > -np.inf)
    return qi, best[qi, nth]


def reaching(q: np.ndarray, v: np.ndarray, cuts: np.ndarray, own: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Phases 2 and 3: pairs that reach the cutoffs, their scores, and how many pairs were scored in full."""
    sites = _sites(q.shape[1])
    m = len(sites)
    kind = np.float64 if q.dtype == object else q.dtype
    a, b = _lengths(q, sites), _lengths(v, sites)
    least = np.where(cuts == _NONE, -np.inf, cuts.astype(np.float64))
    room = 1 + 16 * np.finfo(kind).eps * np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1).max()
    low = (least - room).astype(kind)  # bounds are rounded, so they are given some room
    a, b = a.astype(kind), b.astype(kind)
    pairs: tuple[np.ndarray, np.ndarray] | None = None
    total, enough = 0, False
    for n, s in enumerate(sites):
        left, right = a[:, n + 1 :], b[:, n + 1 :]
        may = (left * right.max(axis=0)).max(axis=1, initial=-np.inf) * m >= low  # queries that may still get a sufficient entry
        if pairs is None:
            local = q[:, s] @ v[:, s].T
            total = total + local
            enough = enough | (local >= (low / m)[:, None])
            stay = (enough | may[:, None]) & (total + left @ right.T >= low[:, None])
            stay[own] = False
            if n + 1 == m or np.count_nonzero(stay) < FEW * stay.size:
                pairs = np.divmod(np.flatnonzero(stay), len(v))
                total, enough = total[pairs], enough[pairs]
                scored = len(pairs[0]) if n + 1 < m else stay.size
        else:
            qi, vi = pairs
            local = np.einsum("ij,ij->i", q[qi, s], v[vi, s])
            total = total + local
            enough = enough | (local >= (low / m)[qi])
            stay = (enough | may[qi]) & (total + np.einsum("ij,ij->i", left[qi], right[vi]) >= low[qi])
            pairs = (qi[stay], vi[stay])
            total, enough = total[stay], enough[stay]
            if n + 1 < m:
                scored = len(pairs[0])
    assert pairs is not None
    reach = total >= cuts[pairs[0]]
    return pairs[0][reach], pairs[1][reach], total[reach], scored


def _top(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best candidates of each query; ties go to the smaller id, where there is one."""
    query, score, *ids = (rows[c] for c in rows)
    rows = rows.iloc[np.lexsort((*ids, ~score, query))]  # ~: the larger first
    return rows[rows.groupby("query_id", sort=False).cumcount() < k]


def _scan(k: int, first: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A pass over (tile, block) pairs: the best scores of leaders, or the rows that reach the cutoffs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for dim, ids_, data, q_ids, cuts, queries in zip(*(batch[c] for c in _PAIR), strict=True):
                ids, v = np.frombuffer(ids_, np.int64), np.frombuffer(data).reshape(-1, dim)
                query_ids, q = np.frombuffer(q_ids, np.int64), np.frombuffer(queries).reshape(-1, dim)
                own = _own(query_ids, ids)
                q, v = _numbers(q, v)
                if first:
                    qi, score = _best(leading(q, v, own, LEADERS * k), k)
                    found = {"query_id": query_ids[qi], "score": score.astype("int64")}
                else:
                    qi, vi, score, _ = reaching(q, v, np.frombuffer(cuts, np.int64), own)
                    found = {"query_id": query_ids[qi], "score": score.astype("int64"), "vec_id": ids[vi]}
                held.append(_top(pd.DataFrame(found), k))
                size += len(held[-1])
                if size > 1 << 18:
                    held = [_top(pd.concat(held), k)]
                    size = len(held[0])
                    if size > 1 << 17:  # many queries: what is known so far goes on
                        yield held.pop()
                        size = 0
        if held:
            yield _top(pd.concat(held), k)

    return run


_PAIR = ("dim", "ids", "data", "query_ids", "cuts", "queries")


def _met(tiles: DataFrame, asked: DataFrame) -> DataFrame:
    """Every tile with every block of a wave's queries of its length."""
    packed = asked.groupBy("block", "dim").applyInPandas(_pack_block, "block int, dim int, query_ids binary, cuts binary, queries binary")
    return tiles.join(F.broadcast(packed), "dim").select(*_PAIR)


def _ranked(found: DataFrame, k: int, *ties: str) -> DataFrame:
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), *ties)
    return found.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for each vector of ``queries`` against all ``vectors``."""
    tiles = materialize(_integers(vectors).mapInPandas(_pack, "dim int, ids binary, data binary"))
    asked = materialize(_integers(queries).dropDuplicates(["vec_id"]))
    seen = asked.agg(F.count("*").alias("n"), F.coalesce(F.max("dim"), F.lit(0)).alias("dim")).first()
    blocks = max(1, -(-seen["n"] // BLOCK))
    asked = asked.withColumns({"block": F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"), "cut": F.lit(_NONE)})
    wave = max(1, BROADCAST_BYTES // (BLOCK * max(1, seen["dim"]) * 8))  # blocks
    if blocks <= wave:
        return _answered(tiles, asked, k)
    done = [materialize(_answered(tiles, asked.where(F.col("block").between(b, b + wave - 1)), k)) for b in range(0, blocks, wave)]
    return done[0].sparkSession.read.schema(done[0].schema).parquet(*(d.table_path for d in done))


def _cutoffs(tiles: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """(vec_id, least): the k-th best score of each query that has as many leaders. A pair meets in one tile and block only, so no score comes twice."""
    gathered = _met(tiles, asked).mapInPandas(_scan(k, first=True), _SCORES)
    return _ranked(gathered, k).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("least"))


def _answered(tiles: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The three phases for the queries of one wave."""
    cutoffs = materialize(_cutoffs(tiles, asked, k))
    asked = asked.join(cutoffs, "vec_id", "left").withColumn("cut", F.coalesce("least", "cut")).drop("least")
    found = _met(tiles, asked).mapInPandas(_scan(k, first=False), _LIST)
    return _ranked(found, k, "vec_id").select("query_id", "rank", "vec_id", "score")


ORACLE_SQL = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(x::double * {SCALE})::bigint) as v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id,
    list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s
)
select query_id, rank, vec_id, score from r where rank <= {K}
"""
