"""All prints against all, tile by tile, held against plain loops."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from gleaner.operators import dedupe, tiles
from gleaner.plans import queries

SCHEMA = "ord long, fp array<long>"


def likeness(a, b):
    n = min(len(a), len(b))
    return 1 - sum(((x ^ y) & 0xFFFFFFFF).bit_count() for x, y in zip(a, b, strict=False)) / (32 * n) if n else 0.0


def made(rng, n, sizes, flips):
    """Prints around a few centres, some of them equal, some empty or null."""
    centres = rng.integers(0, 1 << 32, (6, max(sizes))).tolist()
    rows = []
    for i in range(n):
        fp = list(centres[rng.integers(6)][: int(rng.choice(sizes))])
        for _ in range(int(rng.integers(flips))):
            fp[int(rng.integers(len(fp)))] ^= 1 << int(rng.integers(32))
        rows.append((3 * i + 1, fp))
    return [*rows, (3 * n + 1, []), (3 * n + 4, None)]


def one_pass(rows, threshold, stored=()):
    kept, out = list(stored), {}
    for o, fp in rows:
        found = [(likeness(fp, g), -k) for k, g in kept if fp and likeness(fp, g) >= threshold]
        out[o] = -max(found)[1] if found else None
        if fp and not found:
            kept.append((o, fp))
    return out


@pytest.mark.parametrize(("sizes", "threshold", "flips"), [((2,), 0.8, 30), ((1, 2, 3, 5, 8), 0.85, 40), ((30, 37, 44), 0.95, 120)])
def test_tiles_match_loops(spark, sizes, threshold, flips):
    rows = made(np.random.default_rng(len(sizes)), 150, sizes, flips)
    df = spark.createDataFrame(rows, SCHEMA)
    want = {(o, p): likeness(f, g) for o, f in rows for p, g in rows if p < o and f and g and likeness(f, g) >= threshold}
    assert {(r["ord"], r["other"]): r["similarity"] for r in dedupe.similar_pairs(df, threshold).collect()} == want
    best = {o: max((s, -p) for (q, p), s in want.items() if q == o) for o in {q for q, _ in want}}
    assert {r["ord"]: (r["similarity"], -r["duplicate_of"]) for r in dedupe.any_earlier(df, threshold).collect()} == best
    assert dict(map(tuple, dedupe.greedy(df, threshold).collect())) == one_pass(rows, threshold)
    old = [r for r in rows[:25] if r[1]]
    stored = spark.createDataFrame(old, SCHEMA)
    assert dict(map(tuple, dedupe.greedy(spark.createDataFrame(rows[25:], SCHEMA), threshold, stored, first_rows=40).collect())) == one_pass(rows[25:], threshold, old)


def test_pairs_over_several_blocks_and_no_exchange_of_pairs(spark):
    rng = np.random.default_rng(5)
    words = rng.integers(0, 1 << 32, (2 * tiles.BLOCK_ROWS + 50, 2))
    df = spark.createDataFrame(pd.DataFrame({"ord": np.arange(len(words)), "fp": words.tolist()}), SCHEMA)
    found = dedupe.similar_pairs(df, 0.75)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "CartesianProduct" in plan
    both = words[:, 0].astype(np.uint64) << np.uint64(32) | words[:, 1].astype(np.uint64)
    want = set()
    for i in range(len(both)):
        want |= {(i, int(j)) for j in np.flatnonzero(1 - np.bitwise_count(both[:i] ^ both[i]) / 64 >= 0.75)}
    assert {(r["ord"], r["other"]) for r in found.collect()} == want and len(want) > 100


def test_rows_with_few_neighbours_are_kept_at_once(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, fp) for i, fp in enumerate(rng.integers(0, 1 << 32, (400, 4)).tolist())]
    rows = [*rows, *((400 + i, [*fp[:3], fp[3] ^ 1]) for i, (_, fp) in enumerate(rows[:100]))]
    calls = []
    first = tiles.kept_of_first
    monkeypatch.setattr(tiles, "kept_of_first", lambda *a: calls.append(1) or first(*a))
    assert dict(map(tuple, dedupe.greedy(spark.createDataFrame(rows, SCHEMA), 0.9, first_rows=20).collect())) == one_pass(rows, 0.9)
    assert len(calls) == 1


def test_a_null_word_is_like_nothing(spark):
    rows = [(1, [1, 2]), (2, [1, None]), (3, [1, None]), (4, [1, 2])]
    df = spark.createDataFrame(rows, SCHEMA)
    assert [tuple(r) for r in dedupe.similar_pairs(df, 0.9).collect()] == [(4, 1, 1.0)]
    assert dict(map(tuple, dedupe.greedy(df, 0.9).collect())) == {1: None, 2: None, 3: None, 4: 1}


def test_tunes_are_made_a_few_pages_at_a_time():
    pages = pd.DataFrame({"page_id": np.arange(40), "digest": [bytes(range(i, i + 32)) for i in range(40)]})
    frames = list(queries._tunes(iter([pages])))
    assert sum(map(len, frames)) == 80 and max(f["content"].map(len).sum() for f in frames) < 4 << 20


def chained(rng, n, size):
    """Prints that differ step by step from one before, so that a neighbour of a neighbour may be none; and some on their own."""
    rows = [rng.integers(0, 1 << 32, size).tolist()]
    while len(rows) < n:
        fp = list(rows[int(rng.integers(max(0, len(rows) - 6), len(rows)))]) if rng.random() < 0.6 else rng.integers(0, 1 << 32, size).tolist()
        first = int(rng.integers(size // 2))
        for _ in range(int(rng.integers(int(size * 32 * 0.12)))):
            fp[int(rng.integers(first, len(fp)))] ^= 1 << int(rng.integers(32))
        rows.append(fp[: len(fp) - int(rng.integers(3)) * (rng.random() < 0.1 and len(fp) > 15)])
    return [(2 * i + 5, fp) for i, fp in enumerate(rows)]


@pytest.mark.parametrize("seed", range(3))
def test_links_decide_as_the_pass_does(spark, monkeypatch, seed):
    rows = chained(np.random.default_rng(seed), 160, 20)
    rows += [(1000 + o, fp) for o, fp in rows[::3]]
    told = []
    by_links = dedupe._kept_by_links
    monkeypatch.setattr(dedupe, "_kept_by_links", lambda *a: told.append(by_links(*a)) or told[-1])
    assert dict(map(tuple, dedupe.greedy(spark.createDataFrame(rows, SCHEMA), 0.9, first_rows=10).collect())) == one_pass(rows, 0.9)
    assert told


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (0, 2, 1, 3), (3, 1, 2, 0)])
def test_a_head_that_may_fall_is_not_believed(spark, order):
    """A chain of four, each near the next alone, where only some neighbours are linked: what is told is what the pass keeps, or nothing."""
    base = np.random.default_rng(2).integers(0, 1 << 32, 40).tolist()
    chain = []
    for k in range(4):
        fp = list(base)
        for at in range(3 * k):
            fp[20 + at] ^= 0xFFFFFFFF
        chain.append(fp)
    prints = [(i, chain[k]) for i, k in enumerate(order)]
    for linked in ([(1, 0)], [(2, 1)], [(2, 1), (3, 2)]):
        links = [(a, b) for a, b in linked if likeness(prints[a][1], prints[b][1]) >= 0.9]
        frame = spark.createDataFrame(links, "id long, other long")
        told = dedupe._kept_by_links(spark.createDataFrame(prints, "id long, fp array<long>"), frame, 0.9)
        want = {o for o, d in one_pass(prints, 0.9).items() if d is None}
        if told:
            heads, rest = ([(r["id"], r["fp"]) for r in f.collect()] for f in told)
            assert {o for o, _ in heads} | {o for o, d in one_pass(sorted(rest), 0.9).items() if d is None} == want


def test_copies_are_not_compared_with_all(spark, monkeypatch):
    """Rows that a link leads to their kept row meet no others; only rows on their own are compared with each other."""
    rng = np.random.default_rng(4)
    rows = [(2 * i, fp) for i, fp in enumerate(rng.integers(0, 1 << 32, (300, 40)).tolist())]
    rows += [(o + 1, [*fp[:30], fp[30] ^ 5, *fp[31:]]) for o, fp in rows]
    met = []
    joined = tiles._met
    count = lambda x: sum(len(r["sizes"]) // 4 for r in x.select("sizes").collect())
    monkeypatch.setattr(tiles, "_met", lambda a, b: met.append((count(a), count(b))) or joined(a, b))
    assert dict(map(tuple, dedupe.greedy(spark.createDataFrame(rows, SCHEMA), 0.9, first_rows=20).collect())) == one_pass(rows, 0.9)
    assert sum(a * b for a, b in met) < 300 * 300 + 4 * 20 * 600


def test_sketches_lose_no_pair(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = [(o, fp) for o, fp in made(rng, 260, (30, 33, 36), 150) if fp] + [(1, [3, 4]), (900, [3, 4])]
    monkeypatch.setattr(tiles, "BLOCK_ROWS", 40)
    monkeypatch.setattr(tiles, "SKETCHED_BLOCKS", 1)
    held = []
    axes = tiles._axes
    monkeypatch.setattr(tiles, "_axes", lambda *a: held.append(axes(*a)) or held[-1])
    monkeypatch.setattr(tiles, "SKETCH_PASSES", 1.0)
    want = {(o, p): likeness(f, g) for o, f in rows for p, g in rows if p < o and likeness(f, g) >= 0.93}
    assert {(r["ord"], r["other"]): r["similarity"] for r in dedupe.similar_pairs(spark.createDataFrame(rows, SCHEMA), 0.93).collect()} == want
    assert held and held[0] and len(want) > 500
    n, middle, turned = held[0]
    whole = [fp for _, fp in rows if len(fp) >= n]
    sizes, words = np.array([len(fp) for fp in whole], np.int32), np.concatenate(whole).astype(np.uint32)
    block = tiles.Block(np.arange(len(whole)), sizes, words, (tiles._first_bits(sizes, words, n) - middle) @ turned)
    assert len(tiles._passed(block.sketch, block.facing, tiles._limits(0.93, 36)[36])[0]) < 0.9 * len(whole) ** 2
