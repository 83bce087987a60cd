"""Removal of long repeated byte strings by sorting suffixes, deep and shallow.

A byte goes if it lies in a string of ``LENGTH`` bytes that starts anywhere else too. The positions
of all documents are the suffixes of a suffix array, of which only the part that can hold
repeats is ever built:

1. Anchors. The hash of the ``GRAM`` bytes at each position is taken. The anchor of a start p
   is the position of the least hash among the grams of the string p .. p + LENGTH (the
   rightmost of equals), so it depends on that string alone: equal strings have their anchors
   at equal places, with equal hashes. Consecutive starts with one anchor form an interval; its
   bytes are all that its strings cover. An interval whose anchor hash occurs once in the corpus
   holds no repeat. Those that occur again byte for byte are repeats as a whole; counts of
   (anchor hash, digest of the bytes and of the place of the anchor in them) settle them.
2. Groups. What remains are intervals that share an anchor hash but not their bytes. Strings are
   compared with those that start equally far from their anchor only. The starts of an interval
   are cut into bins of ``BIN`` neighbouring distances; all strings of a bin share a core, and
   bins that occur with one core only hold no repeat. Bins that share a core form a group, in
   which the core, alike in all, is left out: a string of LENGTH bytes is then as good as the
   ``BIN - 1`` bytes around the core. Within a group the suffixes of each distance are
   ordered by multikey quicksort (ternary partition on keys of eight bytes) to the depth
   ``SHALLOW``; whatever is alone by then is no repeat. What remains has long common prefixes and
   is ordered by blind tries: a trie node keeps only the place where its suffixes part, and a
   suffix is compared in full just once, with the one it is led to. The common prefix with its
   neighbours in the order decides. One that is longer by n settles the next n starts too.
   A task holds the rows of one group, ``GROUP_ROWS`` at most; the bins of a larger group are
   cut into finer ones, with a longer core each, until they fit or have one start, where all
   members are equal.
3. The intervals are joined to their documents by content key and cut out. Texts move twice,
   each time with copies merged before the exchange.

Digests have 128 bits: equal intervals, cores and texts are told by them, nothing else is. Defined cases: a null text is empty; a text
shorter than LENGTH keeps all bytes; copies of a text of LENGTH bytes or more lose everything;
matches never cross documents; repeated rows are documents of their own (and so copies of each
other); null ids are carried; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_key

LENGTH = 400
GRAM = 96
SLOTS = LENGTH - GRAM + 1  # distances that a start can have from its anchor
BIN = 61
FINER = (BIN, 8, 1)
SHALLOW = 24
GROUP_ROWS = 1 << 18
_BATCH_ROWS = 1 << 15
_GEAR = np.array([xxhash.xxh64_intdigest(bytes([b]), 11) | 1 for b in range(256)], np.uint64)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A polynomial hash of the GRAM bytes at each position, well mixed."""
    base = np.uint64(0x9E3779B97F4A7C15)
    h, span = _GEAR[data], 1
    whole: np.ndarray | None = None
    done, power, whole_power = 0, base, np.uint64(1)
    rest = GRAM
    with np.errstate(over="ignore"):
        while rest:
            if rest & 1:  # put the block of ``span`` bytes behind those taken so far
                if whole is None:
                    whole, done = h, span
                else:
                    n = len(data) - done - span + 1
                    whole = whole[:n] * power + h[done : done + n]
                    done += span
            rest >>= 1
            if rest:
                h = h[:-span] * power + h[span:]
                power, span = power * power, span * 2
        assert whole is not None
        whole = (whole ^ (whole >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return whole ^ (whole >> np.uint64(32))


def _window_argmin(h: np.ndarray, width: int) -> np.ndarray:
    """Rightmost position of the least value in each window, by doubling."""
    best, span = np.arange(len(h)), 1
    while span < width:
        step = min(span, width - span)
        a, b = best[:-step], best[step:]
        best = np.where(h[b] <= h[a], b, a)
        span += step
    return best


def intervals(data: bytes) -> list[tuple[int, int, int, int]]:
    """(first start, last start, anchor, anchor hash) that cover all starts of ``data`` in order."""
    if len(data) < LENGTH:
        return []
    h = gram_hashes(np.frombuffer(data, np.uint8))
    at = _window_argmin(h, LENGTH - GRAM + 1)
    change = np.flatnonzero(np.diff(at)) + 1
    lo = np.concatenate([[0], change])
    hi = np.concatenate([change - 1, [len(at) - 1]])
    anchor = at[lo]
    return list(zip(lo.tolist(), hi.tolist(), anchor.tolist(), h[anchor].view(np.int64).tolist(), strict=True))


_FOUND = "key binary, lo int, hi int, anchor int, hash long, span binary"


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, text in zip(batch["key"], batch["text"], strict=True):
            data = text.encode("utf-8", "surrogatepass")
            for lo, hi, anchor, hash_ in intervals(data):
                rows.append((key, lo, hi, anchor, hash_, xxhash.xxh3_128_digest(data[lo : hi + LENGTH], seed=anchor - lo)))
        yield pd.DataFrame(rows, columns=["key", "lo", "hi", "anchor", "hash", "span"])


class BlindTrie:
    """Suffixes of one buffer, inserted one by one; nodes keep depths and branching bytes only.

    A node is [depth, {byte: child}], a leaf the list of the suffixes that are equal there.
    """

    def __init__(self, data: bytes, starts: list[int], ends: list[int]) -> None:
        self.data, self.starts, self.ends = data, starts, ends
        self.root: tuple | list | None = None

    def _byte(self, i: int, depth: int) -> int:
        at = self.starts[i] + depth
        return self.data[at] if at < self.ends[i] else -1

    def _common(self, i: int, j: int) -> int:
        a, b = self.data[self.starts[i] : self.ends[i]], self.data[self.starts[j] : self.ends[j]]
        n = min(len(a), len(b))
        if a[:n] == b[:n]:
            return n
        return next(k for k in range(n) if a[k] != b[k])

    def insert(self, i: int) -> None:
        if self.root is None:
            self.root = [i]
            return
        place = self.root
        while isinstance(place, tuple):  # be led to a leaf, blindly
            branches = place[1]
            place = branches.get(self._byte(i, place[0])) or next(iter(branches.values()))
        leaf = place
        common = self._common(i, leaf[0])
        parent, edge, place = None, 0, self.root
        while isinstance(place, tuple) and place[0] < common:
            parent, edge = place, self._byte(i, place[0])
            place = place[1][edge]
        mine, theirs = self._byte(i, common), self._byte(leaf[0], common)
        if isinstance(place, tuple) and place[0] == common:
            place[1].setdefault(mine, []).append(i)
        elif mine == theirs:  # both end here
            leaf.append(i)
        else:
            split = (common, {theirs: place, mine: [i]})
            if parent is None:
                self.root = split
            else:
                parent[1][edge] = split

    def in_order(self) -> Iterator[tuple[int, int]]:
        """Each suffix with the length of the prefix it shares with the one before, in order."""
        stack: list[tuple] = [(self.root, 0)] if self.root is not None else []
        while stack:
            place, shared = stack.pop()
            if isinstance(place, tuple):
                children = [child for _, child in sorted(place[1].items(), key=lambda c: c[0])]
                stack += [(c, place[0] if n else shared) for n, c in reversed(list(enumerate(children)))]
                continue
            yield place[0], shared
            length = self.ends[place[0]] - self.starts[place[0]]
            for i in place[1:]:
                yield i, length


def multikey_quicksort(words: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """The order of rows by group, then by their words; and where in it all words of a group agree.

    Every round parts each open segment in three by the word of its middle row: those below,
    equal and above. Equal ones go on to the next word; segments of one row are done.
    """
    order = np.argsort(group, kind="stable")
    place = np.arange(len(order))
    segment, depth = group[order].astype(np.int64), np.zeros(len(order), np.int64)
    deep: list[tuple[int, int]] = []
    while True:
        edge = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if len(segment) else np.zeros(0, np.int64)
        size = np.diff(np.append(edge, len(segment)))
        full = (size > 1) & (depth[edge] == words.shape[1])
        deep += zip(place[edge[full]].tolist(), (place[edge[full]] + size[full]).tolist(), strict=True)
        open_ = np.repeat((size > 1) & ~full, size)
        if not open_.any():
            return order, deep
        place, segment, depth = place[open_], segment[open_], depth[open_]
        number = np.cumsum(np.append(False, segment[1:] != segment[:-1]))
        edge = np.flatnonzero(np.append(True, number[1:] != number[:-1]))
        size = np.diff(np.append(edge, len(number)))
        key = words[order[place], depth]
        pivot = key[edge + size // 2][number]
        side = (key >= pivot).astype(np.int64) + (key > pivot)
        segment = number * 3 + side
        moved = np.argsort(segment, kind="stable")
        order[place] = order[place][moved]
        segment, depth = segment[moved], depth[moved] + (side[moved] == 1)


def repeated_starts(contents: list[bytes], firsts: list[int], groups: list[int], length: int) -> list[np.ndarray]:
    """For each row, which of its starts have an equal string of ``length`` bytes in its group.

    A row of n bytes has n - length + 1 starts; the first is at slot ``firsts``, and only strings at
    the same slot are compared.
    """
    if not length:  # all members of a group are equal, and none is alone
        return [np.ones(len(c) + 1, bool) for c in contents]
    raw = b"".join(contents)
    data = np.frombuffer(raw + b"\0" * SHALLOW, np.uint8)
    sizes = np.array([len(c) for c in contents])
    ends = np.cumsum(sizes)
    offset, first, group = ends - sizes, np.array(firsts), np.array(groups)
    count = sizes - length + 1
    known = np.zeros((len(contents), int((first + count).max())), bool)
    shallow = min(SHALLOW, length)
    n_words = -(-shallow // 8)
    for slot in range(int(first.min()), known.shape[1]):
        rows = np.flatnonzero((first <= slot) & (slot < first + count))
        at = offset[rows] + slot - first[rows]
        words = np.zeros((len(rows), n_words), np.uint64)
        for k in range(shallow):
            words[:, k // 8] = (words[:, k // 8] << np.uint64(8)) | data[at + k]
        order, deep = multikey_quicksort(words, group[rows])
        for a, b in deep:
            members = rows[order[a:b]]
            if known[members, slot].all():
                continue
            starts = at[order[a:b]].tolist()
            trie = BlindTrie(raw, starts, ends[members].tolist())
            for i in range(len(starts)):
                trie.insert(i)
            before = -1
            for i, shared in trie.in_order():
                if shared >= length:
                    for j in (members[before], members[i]):
                        known[j, slot : slot + shared - length + 1] = True
                before = i
    return [k[f : f + n] for k, f, n in zip(known, firsts, count.tolist(), strict=True)]


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of marked places."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2], strict=True)]


_PART = "span binary, first int, last int"


def _sort_groups(length: int):  # noqa: ANN202
    """Rows come sorted by core; whole groups are gathered up to ``_BATCH_ROWS`` rows and sorted."""

    def done(held: list[tuple]) -> pd.DataFrame:
        marks = repeated_starts([r[3] for r in held], [r[2] for r in held], [r[4] for r in held], length)
        rows = [(r[0], r[1] + a, r[1] + b) for r, m in zip(held, marks, strict=True) for a, b in _runs(m)]
        return pd.DataFrame(rows, columns=["span", "first", "last"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        number, current = 0, None
        for batch in batches:
            for core, span, at, first, content in zip(batch["core"], batch["span"], batch["at"], batch["first"], batch["content"], strict=True):
                if core != current:
                    if len(held) >= _BATCH_ROWS:
                        yield done(held)
                        held = []
                    current, number = core, number + 1
                held.append((span, at, first, bytes(content), number))
        if held:
            yield done(held)

    return run


def _bins(rows: DataFrame, length: int, width: int) -> DataFrame:
    """``rows(core, span, at, first, content)`` cut into bins of ``width`` slots, the core left out.

    ``at`` is the offset of a row's first start in its interval, ``first`` the slot of that start.
    Strings of ``length`` bytes become strings of ``width - 1`` bytes.
    """
    last = F.col("first") + F.octet_length("content") - length
    low = F.explode(F.sequence(F.floor(F.col("first") / width).cast("int") * width, last.cast("int"), F.lit(width)))
    cut = rows.withColumn("last", last.cast("int")).withColumn("low", low)
    part = lambda a, b: F.substring(F.col("content"), a - F.col("first") + 1, b - a)
    a, b = F.greatest("first", "low"), F.least("last", F.col("low") + width - 1)
    inner, outer = F.col("low") + (width - 1), F.col("low") + length
    named = F.concat(F.col("core"), F.format_string("%d:", "low").cast("binary"), part(inner, outer))
    return cut.select(
        F.unhex(F.md5(named)).alias("core"),
        "span",
        (F.col("at") + a - F.col("first")).alias("at"),
        (a - F.col("low")).alias("first"),
        F.concat(part(a, inner), part(outer, b + length)).alias("content"),
    )


def _sorted_parts(rows: DataFrame, group_rows: int) -> DataFrame:
    """(span, first, last): runs of repeated starts, from the groups that the rows form."""
    length, parts = LENGTH, None
    for width in FINER:
        bins = materialize(_bins(rows, length, width))
        length = width - 1
        sizes = bins.groupBy("core").agg(F.count("*").alias("n"))
        if not length:  # a bin of one start holds equal strings: their number says it all, and none are brought together
            starts = bins.join(sizes.where("n > 1"), "core").select("span", F.col("at").alias("first"), F.col("at").alias("last"))
            return starts if parts is None else parts.unionByName(starts)
        large = sizes.where(F.col("n") > group_rows).select("core")
        more = not large.isEmpty()
        # Large groups are left out before any task gathers rows of a core; the window then keeps those of the others together.
        fitting = bins.join(large, "core", "left_anti") if more else bins
        shared = fitting.withColumn("n", F.count("*").over(Window.partitionBy("core"))).where("n > 1").drop("n")
        done = shared.sortWithinPartitions("core", "span", "at").mapInPandas(_sort_groups(length), _PART)
        parts = done if parts is None else parts.unionByName(done)
        if not more:
            return parts
        rows = bins.join(large, "core")
    raise AssertionError("the last bins have one start")


def _cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, text, cuts in zip(batch["key"], batch["text"], batch["cuts"], strict=True):
            data = text.encode("utf-8", "surrogatepass")
            kept, at, spans, removed = [], 0, 0, 0
            for lo, end in merged([(c["lo"], c["end"]) for c in cuts] if cuts is not None else []):
                kept.append(data[at:lo])
                at, spans, removed = end, spans + 1, removed + end - lo
            kept.append(data[at:])
            rows.append((key, len(data), removed, spans, b"".join(kept)))
        yield pd.DataFrame(rows, columns=["key", "n_bytes", "n_removed", "n_spans", "kept"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Half-open spans, those that touch or overlap made one."""
    out: list[tuple[int, int]] = []
    for lo, end in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((lo, end))
    return out


def _contents(docs: DataFrame) -> DataFrame:
    """Each distinct text once, with its key."""
    named = docs.select(text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    return named.where("key is not null").groupBy("key").agg(F.first("text").alias("text"))


def removed_parts(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(key, lo, end): the byte ranges to remove from each distinct text."""
    named = docs.select(text_key(F.col("text")).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    found = materialize(named.where(F.octet_length("text") >= LENGTH).mapInPandas(_find, _FOUND))
    # A place of a distinct interval: where it stands in one of its texts, and how often it occurs.
    distinct = found.groupBy("hash", "span").agg(F.count("*").alias("n"), F.min(F.struct("key", "lo", "hi", "anchor")).alias("at"))
    groups = distinct.groupBy("hash").agg(
        F.count("*").alias("kinds"), F.sum("n").alias("total"), F.min("n").alias("least")
    ).where("total > 1")
    known = materialize(distinct.join(groups, "hash").select("span", "n", "kinds", "least", "at.*"))
    whole = known.where("n > 1").select("span", F.lit(0).alias("first"), (F.col("hi") - F.col("lo")).alias("last"))

    # Intervals that occur once byte for byte need sorting, against all others of their hash.
    wanted = known.where("kinds > 1 and least = 1")
    content = F.substring(F.col("text").cast("binary"), F.col("lo") + 1, F.col("hi") - F.col("lo") + LENGTH)
    slot = F.lit(SLOTS - 1) - F.col("anchor") + F.col("lo")
    rows = _contents(docs).join(wanted, "key").select(
        F.lit(b"").alias("core"), "span", F.lit(0).alias("at"), slot.alias("first"), content.alias("content")
    )
    parts = materialize(whole.unionByName(_sorted_parts(rows, group_rows)))

    # Back to every place where such an interval stands.
    placed = found.select("span", "key", F.col("lo").alias("base")).distinct().join(parts, "span")
    start = F.col("base") + F.col("first")
    return placed.select("key", start.alias("lo"), (F.col("base") + F.col("last") + LENGTH).alias("end"))


def remove_repeats(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) for each row; kept holds the bytes that stay."""
    cuts = removed_parts(docs, group_rows).groupBy("key").agg(F.collect_set(F.struct("lo", "end")).alias("cuts"))
    joined = _contents(docs).join(cuts, "key", "left").select("key", "text", "cuts")
    done = joined.mapInPandas(_cut_out, "key binary, n_bytes long, n_removed long, n_spans long, kept binary")
    return docs.select("doc_id", text_key(F.col("text")).alias("key")).join(done, "key").drop("key")


def removal_digests(docs: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``remove_repeats`` with the SHA-256 of the kept bytes in their place, taken where they are cut."""

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _cut_out(batches):
            yield batch.assign(kept_sha256=[sha256(k).hexdigest() for k in batch["kept"]]).drop(columns="kept")

    cuts = removed_parts(docs, group_rows).groupBy("key").agg(F.collect_set(F.struct("lo", "end")).alias("cuts"))
    joined = _contents(docs).join(cuts, "key", "left").select("key", "text", "cuts")
    done = joined.mapInPandas(digests, "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return docs.select("doc_id", text_key(F.col("text")).alias("key")).join(done, "key").drop("key")
