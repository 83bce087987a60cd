"""Grouping of spelling variants by full neighbourhood generation.

For each word of the vocabulary every distinct string one deletion, replacement or insertion away, over
the alphabet that the vocabulary holds, is generated; a hash join with the vocabulary finds those that are
words. Two words that meet are one edit apart by construction, so nothing is verified afterwards.

A word of ten letters has about a thousand neighbours, so they are not sent anywhere before a filter has
seen them: the vocabulary's words set ``PROBES`` bits each in a bit map, tasks hold it, and only a neighbour
whose bits are all set becomes a row of the join. The check sum that picks the bits is a polynomial
in the letters, so those of all neighbours of many words come from prefix sums, a few machine
operations for each, before any string is made. The map has ``BITS_PER_WORD`` bits a word (one false row in
many thousand neighbours) up to ``MOST_BITS``, 64 MB, which is all that is broadcast; a vocabulary beyond some
17 million words shares them, so that more rows reach the join, which drops them: the result never depends on the map.

A word's form is its near word of largest n if that is ``LEAD`` times its own; n grows at
least so much along a chain of forms, so five rounds of doubling follow every chain to its end.

Defined cases: a null text has no words, a null ``doc_id`` is the empty string in the check sum; words of any
length take part (their neighbours are generated in pieces); repeated rows count again; equal n are
ordered by code point; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .sharding import CRC_TABLE, crc_sql

LETTERS = r"A-Za-zÀ-ÿ"
SHORTEST, LEAST, LEAD, DROP = 7, 2, 10, 31
DOUBLINGS = 5  # 2 ** 5 steps; a chain has at most 19, as n is below 2 ** 63
BITS_PER_WORD, PROBES, MOST_BITS = 32, 6, 1 << 29
SLICE_BITS = 19  # of the map, built apart
TASK_WORDS = 25_000  # words whose neighbours one task makes
PIECE = 1 << 17  # neighbours whose check sums are held at once
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n): the runs of letters of all texts, some with a letter dropped by check sum, that are long and frequent enough."""
    runs = F.regexp_extract_all(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    dropped = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = rows.withColumn("h", h).select(F.when(F.col("h") % DROP == 0, dropped).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def _seed(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each check sum its first place in a map, before it is cut to the map's size, and the step to the next."""
    h = (sums ^ (sums >> np.uint64(32))) * _MIX
    h ^= h >> np.uint64(32)
    return h, (h >> np.uint64(17)) | np.uint64(1)


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def _powers(n: int) -> np.ndarray:
    powers = np.full(n, _BASE)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def check_sums(codes: np.ndarray) -> np.ndarray:
    """Of each row the sum of letter times base to the power of its place, modulo 2 ** 64."""
    return (codes.astype(np.uint64) * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def _by_length(words: list[str]) -> Iterator[list[str]]:
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    return iter(groups.values())


def _places(size: int):  # noqa: ANN202
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group in _by_length(batch["word"].tolist()):
                place, step = _seed(check_sums(_codes(group)))
                for probe in range(PROBES):
                    bits = np.unique((place + np.uint64(probe) * step) & np.uint64(size - 1))
                    yield pd.DataFrame({"slice": (bits >> np.uint64(SLICE_BITS)).astype(np.int32), "bit": (bits & np.uint64((1 << SLICE_BITS) - 1)).astype(np.int32)})

    return run


def _slice(rows: pd.DataFrame) -> pd.DataFrame:
    flags = np.zeros(1 << SLICE_BITS, bool)
    flags[rows["bit"].to_numpy()] = True
    return pd.DataFrame({"slice": rows["slice"].iloc[:1], "bits": [np.packbits(flags, bitorder="little").tobytes()]})


def bit_map(words: DataFrame, n: int) -> np.ndarray:
    """The map of the words' bits as bytes; at most ``MOST_BITS`` bits, whatever n."""
    size = min(max(1 << (n * BITS_PER_WORD).bit_length(), 1 << SLICE_BITS), MOST_BITS)
    slices = words.mapInPandas(_places(size), "slice int, bit int").groupBy("slice").applyInPandas(_slice, "slice int, bits binary")
    out = np.zeros(size >> 3, np.uint8)
    width = 1 << (SLICE_BITS - 3)
    for row in slices.toLocalIterator():
        out[row["slice"] * width : (row["slice"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return out


def _known(sums: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Indices of the check sums whose bits are all set."""
    last = np.uint64((len(bits) << 3) - 1)
    place, step = _seed(sums)
    left = None
    for _ in range(PROBES):
        at = place & last
        hit = (bits[(at >> np.uint64(3)).view(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1)
        keep = np.flatnonzero(hit)
        left = keep if left is None else left[keep]
        step = step[keep]
        place = place[keep] + step
    return left


def neighbours(words: list[str], alphabet: np.ndarray, bits: np.ndarray) -> Iterator[tuple[int, str]]:
    """(index of the word, neighbour) for the distinct neighbours of words of one length whose bits are set."""
    length, k = len(words[0]), len(alphabet)
    power = _powers(length + 1)
    letters = alphabet.astype(np.uint64)
    span = max(1, min(length + 1, PIECE // k))  # positions in a piece
    step = max(1, PIECE // (k * span))  # words in a piece
    for first in range(0, len(words), step):
        group = words[first : first + step]
        codes = _codes(group).astype(np.uint64)
        before = np.zeros((len(group), length + 1), np.uint64)
        np.cumsum(codes * power[:length], axis=1, out=before[:, 1:])
        whole = before[:, -1:]
        for lo in range(0, length + 1, span):
            for hi, kind in ((min(length, lo + span), "-"), (min(length, lo + span), "="), (min(length + 1, lo + span), "+")):
                if hi <= lo:
                    continue
                here, own = before[:, lo:hi], power[lo:hi]
                if kind == "-":
                    sums = here + (whole - before[:, lo + 1 : hi + 1]) * _INVERSE
                elif kind == "=":
                    sums = (whole - codes[:, lo:hi] * own)[:, :, None] + own[:, None] * letters
                else:
                    sums = (here + (whole - here) * _BASE)[:, :, None] + own[:, None] * letters
                for i in _known(sums.ravel(), bits).tolist():
                    i, letter = divmod(i, 1 if kind == "-" else k)
                    i, at = divmod(i, hi - lo)
                    word, at, new = group[i], lo + at, "" if kind == "-" else chr(alphabet[letter])
                    # What repeats another neighbour or the word itself: of a run of like letters only the first is dropped or put in before.
                    if (new == word[at] if kind == "=" else at > 0 and (new or word[at]) == word[at - 1]):
                        continue
                    yield first + i, word[:at] + new + word[at + (kind != "+") :]


def _candidates(alphabet: np.ndarray, bits):  # noqa: ANN001, ANN202
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = dict(zip(batch["word"], batch["n"], strict=True))
            rows: list[tuple[str, str, int]] = []
            held = 0
            for group in _by_length(batch["word"].tolist()):
                for i, near in neighbours(group, alphabet, bits.value):
                    rows.append((near, group[i], counts[group[i]]))
                    held += len(near)
                    if held >= 1 << 21:
                        yield pd.DataFrame(rows, columns=["near", "word", "n"])
                        rows, held = [], 0
            yield pd.DataFrame(rows, columns=["near", "word", "n"])

    return run


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of words of ``words(word, n)`` that differ by one edit."""
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters.toLocalIterator()), np.uint32)
    n = words.count()
    bits = words.sparkSession.sparkContext.broadcast(bit_map(words, n))
    spread = words.repartition(-(-n // TASK_WORDS) or 1, "word")  # a task makes a thousand strings of each word
    found = spread.mapInPandas(_candidates(alphabet, bits), "near string, word string, n long")
    return found.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms(word, form)``: each link is followed by that of its end, and so on."""
    links = materialize(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    for _ in range(DOUBLINGS):
        ends = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = F.col("further").isNotNull()
        links = materialize(links.drop("moved").join(ends, "root", "left").select("word", F.coalesce("further", "root").alias("root"), moved.alias("moved")))
        if links.where("moved").isEmpty():
            break
    return links.drop("moved")


def spelling_variants(words: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row of ``words(word, n)``, whose words are distinct."""
    words = materialize(words.select("word", "n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    leads = -F.col("best.less") >= LEAD * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(leads, F.col("best.near")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n")
    )
    rows = materialize(rows)
    roots = _roots(rows.where("form is not null"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


# Near words by what is left when a letter is dropped: from one word, or at one place from both.
ORACLE_SQL = f"""
with recursive crc_table as (select {CRC_TABLE} as crc_values), runs as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[{LETTERS}]+')) as run from documents
), summed as (
  select run, {crc_sql("coalesce(doc_id::varchar, '') || ':' || run")} as h from runs, crc_table where length(run) >= {SHORTEST}
), words as (
  select word, count(*) as n from (
    select if(h % {DROP} = 0, run[:h % length(run)] || run[h % length(run) + 2:], run) as word from summed)
  where length(word) >= {SHORTEST} group by word having count(*) >= {LEAST}
), without as (select word, i, word[:i - 1] || word[i + 1:] as rest from (select word, unnest(range(1, length(word) + 1)) as i from words)
), near as (
  select a.word, b.word as near from without a join without b on a.i = b.i and a.rest = b.rest and a.word <> b.word
  union select a.word, b.word from without a join words b on a.rest = b.word
  union select b.word, a.word from without a join words b on a.rest = b.word
), chosen as (
  select near.word, count(*) as n_near, min({{'less': -w.n, 'near': near}}) as best from near join words w on w.word = near.near group by near.word
), formed as (
  select words.word, n, coalesce(n_near, 0) as n_near, if(-best.less >= {LEAD} * n, best.near, null) as form,
    if(-best.less >= {LEAD} * n, -best.less, null) as form_n
  from words left join chosen on chosen.word = words.word
), chain(word, root, steps) as (
  select word, word, 0 from formed
  union all select c.word, f.form, c.steps + 1 from chain c join formed f on f.word = c.root where f.form is not null
), ends as (select word, arg_max(root, steps) as root from chain group by word)
select f.word, form, root, n, n_near, form_n from formed f join ends on ends.word = f.word
"""
