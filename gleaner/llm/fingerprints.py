"""Document fingerprints: shift-resistant sets of content-defined chunks.

A text is cut by normalised gear-hash boundaries (see ``cdc``). Its fingerprint is the sorted set of
its distinct chunks, each as ten hex digits of a digest and two of the chunk's length in
bytes. The containment of one fingerprint in another is the length of its chunks that the other
has too, divided by the length of all its chunks.

``edited_likeness`` compares each document with an edited version of itself and with the document
that follows it by id. Neighbours meet without a global sort: quantiles of the id divide the
table into fine ranges, whose bytes are counted; neighbouring ones are put together to as many
tasks of like size as there are shuffle partitions, and a range that one repeated id (or null)
fills beyond that size is divided among several by the text's MD5. Each row is sent to its task
by number, where the range is sorted and streamed; the first document of a task (of the first,
for the last) is sent to the task before as well, so one exchange of the texts is all.

Defined cases: a null text is empty; the empty text has the empty fingerprint, contained in
the empty one alone; null ids come before all others and repeated ids are ordered by their text's
MD5; a single row follows itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cdc import Sizes, cut_points

SIZES = Sizes(16, 64, 255)
_DIGEST, _ITEM = 10, 12
MAX_RANGES = 8192


def chunk_set(text: str) -> dict[str, int]:
    """Length of each distinct chunk by its item in the fingerprint."""
    data = text.encode("utf-8", "surrogatepass")
    items, start = {}, 0
    for end in cut_points(data, SIZES):
        digest = xxhash.xxh64_hexdigest(data[start:end])[:_DIGEST]
        items[f"{digest}{end - start:02x}"] = end - start
        start = end
    return items


def fingerprint(text: str | None) -> str:
    return "".join(sorted(chunk_set(text or "")))


def _share(a: dict[str, int], b: dict[str, int]) -> float:
    whole = sum(a.values())
    if not whole:
        return 0.0 if b else 1.0
    return sum(n for item, n in a.items() if item in b) / whole


def containment(a: str, b: str) -> float:
    """How much of what fingerprint ``a`` stands for is in what ``b`` stands for, from 0 to 1."""
    parse = lambda f: {f[i : i + _ITEM]: int(f[i + _DIGEST : i + _ITEM], 16) for i in range(0, len(f), _ITEM)}
    return _share(parse(a), parse(b))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) for each row."""
    print_ = F.pandas_udf(lambda s: s.map(fingerprint), "string")
    return docs.select("doc_id", print_(F.coalesce("text", F.lit(""))).alias("fingerprint"))


def edited(text: str, following: str) -> str:
    """The last quarter of the text replaced by as much from the head of the following one."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


def _range_of(doc_id: Column, cuts: list) -> Column:
    """How many of the ascending cuts are not above the id, by binary search; 0 for null."""
    if not cuts:
        return F.lit(0)
    known = F.array(*map(F.lit, cuts))
    steps = F.array(*(F.lit(1 << b) for b in range(len(cuts).bit_length() - 1, -1, -1)))
    further = lambda at, step: F.coalesce(F.get(known, at + step - 1) <= doc_id, F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(further(at, step), at + step).otherwise(at))


def _plan_tasks(ranges: list, tasks: int) -> tuple[list, dict[int, tuple[int, int]], int]:
    """Cuts between tasks, {range: (first task, tasks)}, and the number of tasks, of like bytes."""
    target = max(1, -(-sum(r["bytes"] for r in ranges) // tasks))
    cuts, placed, number, held, alone = [], {}, -1, 0, True
    for r in ranges:
        parts = -(-r["bytes"] // target) if r["least"] == r["most"] else 1
        if alone or parts > 1 or held + r["bytes"] > target:
            if number >= 0:
                cuts.append(r["least"])
            number, held, alone = len(cuts), 0, parts > 1 or r["least"] is None
            placed[number] = parts
        held += r["bytes"]
    first, spread = 0, {}
    for n, parts in placed.items():
        spread[n] = (first, parts)
        first += parts
    return cuts, spread, first


def _in_ranges(docs: DataFrame) -> DataFrame:
    """Rows (range, tail, id, text), sorted in tasks; tail 1 marks the head of the next range."""
    spark, kind = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("order", F.md5(F.col("text").cast("binary")))
    n = min(MAX_RANGES // 2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    fine = min(MAX_RANGES, 32 * n)
    shares = [i / fine for i in range(1, fine)] or [0.5]
    marks = sorted(set(docs.agg(F.percentile_approx("doc_id", shares, 10 * MAX_RANGES)).first()[0] or []))
    sized = rows.select("doc_id", (F.octet_length("text") + 64).alias("bytes")).groupBy(_range_of(F.col("doc_id"), marks).alias("range"), F.col("doc_id").isNotNull().alias("known"))
    sized = sized.agg(F.sum("bytes").alias("bytes"), F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    ranges = sized.orderBy("known", "range").collect()  # at most MAX_RANGES + 1 rows
    # A null id has the range of its own that the first mark would have: one step below all others.
    cuts, spread, tasks = _plan_tasks(ranges, n) if ranges else ([], {0: (0, 1)}, 1)
    nulls = bool(ranges) and not ranges[0]["known"] and len(ranges) > 1
    number = _range_of(F.col("doc_id"), cuts[1:] if nulls else cuts)
    number = F.when(F.col("doc_id").isNull(), 0).otherwise(number + 1) if nulls else number
    firsts = F.array(*(F.lit(spread[i][0]) for i in range(len(spread))))
    task = F.get(firsts, number)
    for i, (_, parts) in spread.items():
        if parts > 1:  # as many as there are tasks in all, at most twice
            share = F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * parts
            task = task + F.when(number == i, F.shiftright(share, 32).cast("int")).otherwise(0)
    placed = rows.withColumn("range", task)
    least = F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "order"))
    heads = placed.groupBy("range").agg(least.alias("h")).orderBy("range").collect()  # a row a task
    before = [(h["h"]["doc_id"], h["h"]["order"], heads[i - 1]["range"]) for i, h in enumerate(heads)]
    tails = F.broadcast(spark.createDataFrame(before, f"head {kind}, head_order string, target int"))
    again = rows.join(tails, F.col("doc_id").eqNullSafe(F.col("head")) & (F.col("order") == F.col("head_order")))
    again = again.groupBy("target").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.first("order").alias("order"))
    both = placed.withColumn("tail", F.lit(0)).unionByName(again.withColumnRenamed("target", "range").withColumn("tail", F.lit(1)))
    return both.select("range", "tail", "doc_id", "order", "text").repartitionById(max(1, tasks), F.col("range")).sortWithinPartitions("range", "tail", "doc_id", "order").drop("order")


_SCHEMA = """doc_id string, n_chars long, edited_sha256 string, fingerprint string,
             edited_fingerprint string, near_edited double, near_next double"""


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stream the sorted rows of one or more ranges; each row is finished by the one after it."""
    pending = None
    for batch in batches:
        rows = []
        for range_, tail, doc_id, text in zip(batch["range"], batch["tail"], batch["doc_id"], batch["text"], strict=True):
            own = None
            if pending is not None and pending[0] == range_:
                _, last_id, last, last_set = pending
                own = chunk_set(text)
                changed = edited(last, text)
                changed_set = chunk_set(changed)
                rows.append(
                    (
                        last_id,
                        len(last),
                        sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                        "".join(sorted(last_set)),
                        "".join(sorted(changed_set)),
                        _share(last_set, changed_set),
                        _share(last_set, own),
                    )
                )
            pending = None if tail else (range_, doc_id, text, chunk_set(text) if own is None else own)
        yield pd.DataFrame(rows, columns=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])


def edited_likeness(docs: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, and likenesses to edited and next."""
    rows = _in_ranges(docs).withColumn("doc_id", F.col("doc_id").cast("string"))  # pandas has no null among integers
    return rows.mapInPandas(_compare, _SCHEMA).withColumn("doc_id", F.col("doc_id").cast(dict(docs.dtypes)["doc_id"]))
