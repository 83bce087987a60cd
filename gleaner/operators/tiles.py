"""Comparison of all prints with all, tile by tile: exact at any threshold, bounded in memory, and no candidate is ever sent.

Prints are sorted by id over partitions and packed into blocks, one row each. Every block meets every block that begins before its
end; a task compares the two as arrays of words, so of the pairs only those within the threshold (or the best of a print) leave
it. What is stored or shuffled grows with the prints, what is computed with their pairs: one machine instruction for 64 bits.

Prints of many words that are compared among themselves have a sketch each: their bits turned and cut to ``SKETCH`` numbers. A turn keeps distances
and a cut lessens them, so pairs whose sketches are further apart than the bits may be are left at once, at a matrix product; all others
are compared word by word. The axes are the main ones of a bounded sample; they decide the time alone, not what is found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS, BLOCK_BYTES = 4096, 1 << 19
STRIPS, STRIP_BLOCKS = 16, 64  # partitions of blocks: so many at most, or more where one would hold more blocks than that
CELLS, SKETCHED_CELLS = 1 << 18, 1 << 20  # pairs that are compared at once
LOOK = 8  # columns of 64 bits after which pairs that are too far already are left
SKETCH, SKETCH_ROWS, SKETCH_WORDS = 64, 2048, 48  # numbers a sketch, prints that its axes are made from, words that it is made of at most
SKETCHED_BLOCKS = 4  # so many blocks at least, else sketches cost more than they save
SKETCH_PASSES = 0.1  # share of pairs that may pass
KEPT_ROWS = 1 << 20
CHUNK = 256
_LOW = np.uint64(0xFFFFFFFF)
_PACKED = "low long, high long, ids binary, sizes binary, words binary, sketch binary"


class Block:
    """Prints, longest first: ids, sizes in words, columns of two words each (an odd last word has zeros behind it), and sketches or none."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, words: np.ndarray, sketch: np.ndarray | None = None) -> None:
        order = np.argsort(-sizes, kind="stable")
        held = np.arange(int(sizes.max()) + int(sizes.max()) % 2)[None, :] < sizes[:, None]
        rows = np.zeros(held.shape, np.uint32)
        rows[held] = words
        self.ids, self.sizes = ids[order], sizes[order].astype(np.int64)
        self.columns = np.ascontiguousarray(rows[order].view(np.uint64).T)
        self.sketch = None
        if sketch is not None:  # with minus half the square of its length, and a one
            half = -0.5 * np.einsum("ij,ij->i", sketch, sketch)
            self.sketch = np.column_stack([sketch, half, np.ones(len(sketch), np.float32)])[order]

    def part(self, rows: slice | np.ndarray) -> Block:
        """Some of the rows, in order."""
        new = object.__new__(Block)
        new.ids, new.sizes, new.columns = self.ids[rows], self.sizes[rows], self.columns[:, rows]
        new.sketch = None if self.sketch is None else self.sketch[rows]
        return new

    @cached_property
    def facing(self) -> np.ndarray:
        """Sketches as columns, so that a row of ``sketch`` times one is minus half the square of the distance of the two."""
        return np.ascontiguousarray(self.sketch[:, [*range(SKETCH), SKETCH + 1, SKETCH]].T)

    def longer(self, n: int) -> int:
        """How many prints have at least ``n`` words."""
        return int(np.searchsorted(-self.sizes, -n, "right"))


def _limits(threshold: float, most: int) -> np.ndarray:
    """The most bits that may differ over n words, by n, in the arithmetic of ``hamming_similarity``; -1 if not even none."""
    out = np.full(most + 1, -1, np.int64)
    for n in range(1, most + 1):
        d = int((1 - threshold) * 32 * n) + 2
        while d >= 0 and 1 - d / (32 * n) < threshold:
            d -= 1
        out[n] = min(d, 32 * n)
    return out


def _near(a: Block, b: Block, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of a, row of b, bits that differ) of the pairs within the limit of their common prefix."""
    longest = int(min(a.sizes[0], b.sizes[0]))
    if a.sketch is not None and b.sketch is not None:
        r, c = _passed(a.sketch, b.facing, limits[longest])
        if len(r) * LOOK <= len(a.ids) * len(b.ids):
            return _rest(a, b, r, c, np.zeros(len(r), np.int64), 0, limits)
    kind = np.uint16 if longest < 2048 else np.int32
    bits = np.zeros((len(a.ids), len(b.ids)), kind)
    n_columns = -(-longest // 2)
    # Limits rise with the length, so the lesser of two is that of the common prefix.
    own = [limits[np.minimum(x.sizes, longest)] for x in (a, b)]
    if own[0][-1] < 0:  # a threshold above 1
        none = np.zeros(0, np.int64)
        return none, none, none
    most = np.minimum(own[0].astype(kind)[:, None], own[1].astype(kind)[None, :])
    for k in range(n_columns):
        (full_a, any_a), (full_b, any_b) = ((x.longer(2 * k + 2), x.longer(2 * k + 1)) for x in (a, b))
        # Where the common prefix ends within the column, its first word alone counts.
        for i, j, mask in ((slice(0, full_a), slice(0, full_b), None), (slice(full_a, any_a), slice(0, any_b), _LOW), (slice(0, full_a), slice(full_b, any_b), _LOW)):
            if i.start < i.stop and j.start < j.stop:
                differ = a.columns[k, i, None] ^ b.columns[k, None, j]
                bits[i, j] += np.bitwise_count(differ if mask is None else differ & mask)
        if k % LOOK == LOOK - 1 and k + LOOK < n_columns:
            r, c = np.nonzero(bits <= most)
            if len(r) * LOOK <= bits.size:
                return _rest(a, b, r, c, bits[r, c].astype(np.int64), k + 1, limits)
    r, c = np.nonzero(bits <= most)
    return _rest(a, b, r, c, bits[r, c].astype(np.int64), n_columns, limits)


def _passed(sketch: np.ndarray, facing: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of one, row of the other) of the sketches that are no further apart than ``most`` bits; those of prints that have none pass."""
    near = np.zeros(-(-len(sketch) * facing.shape[1] // 8) * 8, bool)
    flat = near[: len(sketch) * facing.shape[1]]
    np.logical_not(np.less(sketch @ facing, -0.5 * (float(most) + 0.5)).ravel(), out=flat)  # half a bit is left to rounding
    eights = np.flatnonzero(near.view(np.uint64))  # few pairs pass
    at = (eights[:, None] * 8 + np.arange(8))[near.reshape(-1, 8)[eights]]
    return np.divmod(at, facing.shape[1])


def _rest(a: Block, b: Block, r: np.ndarray, c: np.ndarray, bits: np.ndarray, column: int, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs (r, c), with ``bits`` over the columns before ``column``, over all others."""
    common = np.minimum(a.sizes[r], b.sizes[c])
    while len(r) and 2 * (column + LOOK) <= common.min():  # columns that all pairs have whole
        own = slice(column, column + LOOK)
        bits = bits + np.bitwise_count(a.columns[own, r] ^ b.columns[own, c]).sum(axis=0, dtype=np.int64)
        keep = bits <= limits[common]
        r, c, bits, common = r[keep], c[keep], bits[keep], common[keep]
        column += LOOK
    for k in range(column, -(-int(common.max(initial=0)) // 2)):
        differ = a.columns[k, r] ^ b.columns[k, c]
        differ = np.where(common >= 2 * k + 2, differ, np.where(common == 2 * k + 1, differ & _LOW, np.uint64(0)))
        bits += np.bitwise_count(differ)
        if k % LOOK == LOOK - 1:
            keep = bits <= limits[common]
            r, c, bits, common = r[keep], c[keep], bits[keep], common[keep]
    keep = bits <= limits[common]
    return r[keep], c[keep], bits[keep]


def _earlier(a: Block, b: Block, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(id of a, smaller id of b, similarity) of the pairs within the threshold, some at a time."""
    limits = _limits(threshold, int(max(a.sizes[0], b.sizes[0])))
    ordered = b.ids.max() < a.ids.min()
    step = max(1, (CELLS if a.sketch is None else SKETCHED_CELLS) // len(b.ids))
    for at in range(0, len(a.ids), step):
        some = a.part(slice(at, at + step))
        r, c, bits = _near(some, b, limits)
        if not ordered:
            before = b.ids[c] < some.ids[r]
            r, c, bits = r[before], c[before], bits[before]
        if len(r):
            yield some.ids[r], b.ids[c], 1 - bits / (32 * np.minimum(some.sizes[r], b.sizes[c]))


def _block(row: tuple) -> Block:
    ids, sizes, words, sketch = row
    numbers = np.frombuffer(sketch, np.float32).reshape(-1, SKETCH) if sketch else None
    return Block(np.frombuffer(ids, np.int64), np.frombuffer(sizes, np.int32), np.frombuffer(words, np.uint32), numbers)


def _flat(prints: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of prints, and all their words."""
    sizes = np.array([len(p) for p in prints], np.int32)
    words = np.concatenate([np.asarray(p, np.int64) for p in prints]) if len(sizes) else np.zeros(0, np.int64)
    return sizes, (words & 0xFFFFFFFF).astype(np.uint32)


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ids = batch["id"].to_numpy(np.int64)
        sizes, words = _flat(batch["fp"])
        ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
        at = 0
        while at < len(ids):
            end = int(np.searchsorted(ends, ends[at] + BLOCK_BYTES // 4, "right")) - 1
            end = max(at + 1, min(end, at + BLOCK_ROWS, len(ids)))
            own = slice(at, end)
            row = (ids[own].min(), ids[own].max(), ids[own].tobytes(), sizes[own].tobytes(), words[ends[at] : ends[end]].tobytes(), b"")
            yield pd.DataFrame([row], columns=["low", "high", "ids", "sizes", "words", "sketch"])
            at = end


def comparable(prints: DataFrame) -> DataFrame:
    """Prints that can be like another: those with words, none of which is null."""
    return prints.where((F.size("fp") > 0) & ~F.exists("fp", lambda w: w.isNull()))


def _first_bits(sizes: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
    """The bits of the first ``n`` words of each print, in rows; prints of fewer words have no row."""
    ends = np.cumsum(sizes, dtype=np.int64)
    at = (ends - sizes)[sizes >= n, None] + np.arange(n)
    return np.unpackbits(words[at].view(np.uint8), axis=1).astype(np.float32)


def _axes(block: tuple, threshold: float) -> tuple[int, np.ndarray, np.ndarray] | None:
    """Words that sketches are made of, the point they are seen from and their axes, of the prints of a block; none where too few pairs would be left."""
    sizes, words = np.frombuffer(block[0], np.int32), np.frombuffer(block[1], np.uint32)
    n = min(SKETCH_WORDS, int(np.quantile(sizes, 0.1, method="lower")))
    if n * 32 < 4 * SKETCH:
        return None
    bits = _first_bits(sizes, words, n)
    bits = bits[:: -(-len(bits) // SKETCH_ROWS)]
    middle = bits.mean(axis=0)
    seen = bits - middle
    axes = np.linalg.eigh(seen.T @ seen)[1][:, : -SKETCH - 1 : -1].astype(np.float32)
    some = (seen @ axes)[:: -(-len(seen) // 256)]
    apart = ((some[:, None] - some) ** 2).sum(axis=2)
    passed = (apart <= _limits(threshold, int(sizes.max()))[int(np.median(sizes))]).mean() - 1 / len(some)
    return (n, middle, axes) if passed <= SKETCH_PASSES else None


def _sketched(n: int, middle: np.ndarray, axes: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                sizes, words = np.frombuffer(row["sizes"], np.int32), np.frombuffer(row["words"], np.uint32)
                numbers = np.full((len(sizes), SKETCH), np.nan, np.float32)
                numbers[sizes >= n] = (_first_bits(sizes, words, n) - middle) @ axes
                yield pd.DataFrame([row | {"sketch": numbers.tobytes()}])

    return run


def packed(prints: DataFrame, checkpoint: Callable[[DataFrame], DataFrame], threshold: float | None = None) -> DataFrame:
    """``prints(id, fp)`` in blocks of neighbouring ids, dealt evenly over partitions; with sketches where a threshold is given and they help."""
    rows = comparable(prints).select(F.col("id").cast("long").alias("id"), "fp")
    blocks = checkpoint(rows.repartitionByRange("id").sortWithinPartitions("id").mapInPandas(_pack, _PACKED))
    n = blocks.count()
    if threshold is not None and n >= SKETCHED_BLOCKS:
        block = blocks.orderBy(F.xxhash64("low")).select("sizes", "words").first()
        axes = _axes(tuple(block), threshold)
        if axes:
            blocks = blocks.mapInPandas(_sketched(*axes), _PACKED)
    few = max(min(n, 4), min(STRIPS, n // 4))  # of n partitions n * n tasks are made
    return checkpoint(blocks.repartition(max(1, few, -(-n // STRIP_BLOCKS))))


def _met(later: DataFrame, earlier: DataFrame) -> DataFrame:
    """Every block of ``later`` beside every one of ``earlier`` that holds a smaller id. Sketches of different frames have different axes."""
    if later is not earlier:
        later, earlier = (x.withColumn("sketch", F.lit(b"")) for x in (later, earlier))
    other = earlier.select(*(F.col(c).alias(f"{c}_b") for c in earlier.columns)).hint("shuffle_replicate_nl")  # not broadcast
    return later.crossJoin(other).where("low_b < high").select("ids", "sizes", "words", "sketch", "ids_b", "sizes_b", "words_b", "sketch_b")


def _tiles(batch: pd.DataFrame) -> Iterator[tuple[Block, Block]]:
    for row in batch.itertuples(index=False, name=None):
        yield _block(row[:4]), _block(row[4:])


def near_earlier(later: DataFrame, earlier: DataFrame, threshold: float) -> DataFrame:
    """(id, other, similarity) of every pair of packed prints within the threshold, ``other`` being the smaller id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in _tiles(batch):
                for ids, others, similarity in _earlier(a, b, threshold):
                    yield pd.DataFrame({"id": ids, "other": others, "similarity": similarity})

    return _met(later, earlier).mapInPandas(run, "id long, other long, similarity double")


def _best_of(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, others, similarity = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.lexsort((others, -similarity, ids))
    first = order[np.append(True, np.diff(ids[order]) != 0)]
    return ids[first], others[first], similarity[first]


def best_earlier(later: DataFrame, earlier: DataFrame, threshold: float) -> DataFrame:
    """(id, other, similarity): of each print that has one, the most similar print with a smaller id, the first on ties."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        n = 0
        for batch in batches:
            for a, b in _tiles(batch):
                for rows in _earlier(a, b, threshold):
                    held.append(rows)
                    n += len(rows[0])
                    if n >= KEPT_ROWS:
                        held = [_best_of(held)]
                        n = len(held[0][0])
                        if n >= KEPT_ROWS // 2:
                            yield pd.DataFrame(dict(zip(("id", "other", "similarity"), held[0], strict=True)))
                            held, n = [], 0
        if held:
            yield pd.DataFrame(dict(zip(("id", "other", "similarity"), _best_of(held), strict=True)))

    found = _met(later, earlier).mapInPandas(run, "id long, other long, similarity double")
    best = F.max(F.struct("similarity", (-F.col("other")).alias("o")))
    return found.groupBy("id").agg(best.alias("b")).select("id", (-F.col("b.o")).alias("other"), F.col("b.similarity"))


def near_any(later: DataFrame, earlier: DataFrame, threshold: float) -> DataFrame:
    """(id) of each packed print that is within the threshold of one with a smaller id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in _tiles(batch):
                found = [np.unique(ids) for ids, _, _ in _earlier(a, b, threshold)]
                if found:
                    yield pd.DataFrame({"id": np.unique(np.concatenate(found))})

    return _met(later, earlier).mapInPandas(run, "id long").distinct()


def kept_in_order(block: Block, threshold: float) -> np.ndarray:
    """The ids that one pass over the prints of a block in order of their ids keeps."""
    blocked = np.zeros(len(block.ids), bool)
    limits = _limits(threshold, int(block.sizes[0]))
    rank = np.argsort(block.ids)
    kept: list[np.ndarray] = []
    for at in range(0, len(rank), CHUNK):
        rows = np.sort(rank[at : at + CHUNK][~blocked[rank[at : at + CHUNK]]])  # longest first, as in the block
        if not len(rows):
            continue
        some = block.part(rows)
        r, c, _ = _near(some, some, limits)
        near: dict[int, list[int]] = {}
        for i, j in zip(r[some.ids[c] < some.ids[r]].tolist(), c[some.ids[c] < some.ids[r]].tolist(), strict=True):
            near.setdefault(i, []).append(j)
        keep = np.zeros(len(rows), bool)
        for i in np.argsort(some.ids).tolist():
            keep[i] = not any(keep[j] for j in near.get(i, ()))
        new = some.part(np.flatnonzero(keep))
        kept.append(new.ids)
        rest = np.sort(rank[at + CHUNK :][~blocked[rank[at + CHUNK :]]])
        step = CELLS // CHUNK
        for k in range(0, len(rest), step):
            later = rest[k : k + step]
            blocked[later[_near(block.part(later), new, limits)[0]]] = True
    return np.concatenate(kept) if kept else np.zeros(0, np.int64)


def kept_of_first(prints: DataFrame, threshold: float, rows: int) -> DataFrame:
    """(id) of what one pass keeps of the ``rows`` first of ``prints(id, fp)``; a task sees these alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(batch["id"].to_numpy(np.int64), *_flat(batch["fp"])) for batch in batches if len(batch)]
        if parts:
            ids, sizes, words = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield pd.DataFrame({"id": kept_in_order(Block(ids, sizes, words), threshold)})

    return prints.select(F.col("id").cast("long").alias("id"), "fp").orderBy("id").limit(rows).coalesce(1).mapInPandas(run, "id long")
