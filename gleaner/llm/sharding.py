"""Sharding by Hilbert-curve order over several metadata dimensions.

Length, source and language are quantised to ``2**BITS`` levels each, by quantiles over the
whole table (strings by the quantiles of their CRC-32, so no level depends on how many values
there are). The cells are numbered along a three-dimensional Hilbert curve, rows are ordered by
that number, and the order is cut into runs of equal row count. Neighbouring cells of the curve
touch, so each shard covers a compact box of the metadata space, and a reader that keeps
minima and maxima of a file can skip most files for a filter on any of the dimensions.

The global order is never sorted in one task. Rows are counted by (cell, bucket), where bucket
comes from the text's CRC and a hash of the id; running sums over cells (at most ``8**BITS`` rows)
and over the buckets of each cell give the rank at which a bucket starts; only the rows of one
bucket are ranked together. The lower part of the bucket, the hash of the id, splits a text that
very many rows share; it has more values the more rows the table has. Copies of one length,
source and language share a cell, and so lie in one run of it, but for cuts between shards.

Law ``rows``: shard counts differ by one at most. Only DataFrame and SQL functions are used.

Defined cases: a null text has size 1 and the CRC of no bytes; null sources and languages form
a level of their own (the lowest); rows that repeat in every column keep one slot each, in any
order among themselves; an empty table gives no rows; columns beside those named are carried by
``assign_shards`` and ignored by the query.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

BITS = 4
SHARDS = 16
TEXT_BUCKETS = 16
ID_BUCKETS, MOST_ID_BUCKETS, BUCKET_ROWS = 16, 4096, 1 << 20
_ACCURACY = 10_000


def _number(name: str, kind: str) -> Column:
    return F.crc32(F.col(name).cast("binary")) if kind == "string" else F.col(name).cast("double")


def quantile_cuts(df: DataFrame, dims: list[str], bits: int = BITS) -> list[list[float]]:
    """``2**bits - 1`` ascending cut points for each dimension, from all rows."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    kinds = dict(df.dtypes)
    row = df.agg(*(F.percentile_approx(_number(d, kinds[d]), shares, _ACCURACY).alias(d) for d in dims)).first()
    return [sorted(set(row[d] or [])) for d in dims]


def _level(number: Column, cuts: list[float]) -> Column:
    """How many cut points lie below the number; 0 for null."""
    above = [F.when(number > F.lit(c), 1).otherwise(0) for c in cuts]
    return reduce(lambda a, b: a + b, above, F.lit(0)).cast("int")


def hilbert_index(levels: list[str], bits: int = BITS) -> Column:
    """Position of a cell along the Hilbert curve through its integer levels.

    Bit planes are folded from the highest down: where an axis has the bit set the low bits
    of the first axis are inverted, else they are exchanged with that axis; a Gray code of
    what results, read across the axes, is the position.
    """
    n = len(levels)
    steps = F.array(*(F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)))

    def turn(axes: Column, step: Column) -> Column:
        own = F.element_at(axes, step["i"] + 1)
        low = step["q"] - F.lit(1)
        is_set = own.bitwiseAND(step["q"]) != 0
        swap = F.element_at(axes, 1).bitwiseXOR(own).bitwiseAND(low)
        flip = F.when(is_set, low).otherwise(swap)
        return F.transform(
            axes,
            lambda axis, j: F.when(j == 0, axis.bitwiseXOR(flip))
            .when((j == step["i"]) & ~is_set, axis.bitwiseXOR(swap))
            .otherwise(axis),
        )

    turned = F.aggregate(steps, F.array(*(F.col(c) for c in levels)), turn)
    gray = F.transform(
        turned, lambda _, j: F.aggregate(F.slice(turned, F.lit(1), j + 1), F.lit(0), lambda a, x: a.bitwiseXOR(x))
    )
    planes = F.array(*(F.lit(1 << b) for b in range(bits - 1, 0, -1)))
    twist = F.aggregate(
        planes,
        F.lit(0),
        lambda t, q: F.when(F.element_at(gray, n).bitwiseAND(q) != 0, t.bitwiseXOR(q - F.lit(1))).otherwise(t),
    )
    bits_down = F.array(
        *(F.struct(F.lit(1 << b).alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n))
    )
    return F.aggregate(
        bits_down,
        F.lit(0),
        lambda h, s: h * 2
        + F.when(F.element_at(gray, s["i"] + 1).bitwiseXOR(twist).bitwiseAND(s["q"]) != 0, 1).otherwise(0),
    )


def assign_shards(df: DataFrame, dims: list[str], shards: int = SHARDS, bits: int = BITS, crc: str = "text_crc32") -> DataFrame:
    """``df(doc_id, *dims, ...)`` with columns shard and slot; ``crc`` names the texts' CRC-32.

    ``dims`` names three dimensions (any number works). The input is read twice: once for the
    quantiles, once for the digests that are then written to the shared folder and ranked.
    """
    kinds = dict(df.dtypes)
    cuts = quantile_cuts(df, dims, bits)
    levels = [f"_level{i}" for i in range(len(dims))]
    id_buckets = ID_BUCKETS
    n = df.count()
    while id_buckets < MOST_ID_BUCKETS and id_buckets * BUCKET_ROWS < n:
        id_buckets *= 2
    digits = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 1, 3), 16, 10).cast("int")
    id_hash = F.floor(digits * id_buckets / MOST_ID_BUCKETS)
    text_hash = F.pmod(F.col(crc), F.lit(TEXT_BUCKETS))
    rows = materialize(
        df.withColumns({c: _level(_number(d, kinds[d]), cut) for c, d, cut in zip(levels, dims, cuts, strict=True)})
        .withColumn("_bucket", (text_hash * id_buckets + id_hash).cast("int"))
    )

    counts = rows.groupBy(*levels, "_bucket").agg(F.count("*").alias("_n"))
    cells = counts.groupBy(*levels).agg(F.sum("_n").alias("_cell_n")).withColumn("_curve", hilbert_index(levels, bits))
    along = Window.orderBy("_curve").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cells = cells.withColumns(
        {"_cell_start": F.coalesce(F.sum("_cell_n").over(along), F.lit(0)), "_total": F.sum("_cell_n").over(whole)}
    )
    inside = Window.partitionBy(*levels).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        counts.withColumn("_bucket_start", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
        .join(F.broadcast(cells), levels)  # at most 8**bits rows
        .select(*levels, "_bucket", "_total", (F.col("_cell_start") + F.col("_bucket_start")).alias("_start"))
    )
    in_bucket = Window.partitionBy(*levels, "_bucket").orderBy(crc, "doc_id")
    ranked = (
        rows.withColumn("_nth", F.row_number().over(in_bucket))
        .join(starts, [*levels, "_bucket"])
        .withColumn("_rank", F.col("_start") + F.col("_nth") - 1)
    )
    # Shard s holds the ranks from ceil(s * total / shards) on, so counts differ by one at most.
    shard = F.expr(f"(_rank * {shards}) div _total")
    first = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return (
        ranked.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("_rank") - first).cast("long"))
        .drop(*levels, "_bucket", "_nth", "_start", "_total", "_rank")
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The digest of each document with the shard and slot that it goes to."""
    text = F.coalesce(F.col("text"), F.lit(""))
    digests = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.length(text).alias("chars"),
        "source",
        "lang",
    )
    return assign_shards(digests, ["chars", "source", "lang"], shards).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents themselves as one directory a shard, each in slot order."""
    text = F.coalesce(F.col("text"), F.lit(""))
    own = docs.drop("shard", "slot").withColumns({"_crc": F.crc32(text.cast("binary")), "_chars": F.length(text)})
    placed = assign_shards(own, ["_chars", "source", "lang"], shards, crc="_crc")
    (
        placed.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .drop("_crc", "_chars")
        .write.partitionBy("shard")
        .parquet(path)
    )


CRC_TABLE = "list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end))"


def crc_sql(value: str) -> str:
    """The CRC-32 of a string, byte by byte."""
    as_bytes = f"list_transform(regexp_extract_all(hex(encode({value})), '..'), lambda h: ('0x' || h)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {as_bytes}), lambda c, b: xor(c >> 8, crc_values[(xor(c, b) & 255) + 1])), 4294967295)"


def _curve_sql() -> str:
    """Common table expressions from levels x0, x1, x2 to the position h, a step each."""
    steps, last = [], "levelled"
    for q in (1 << b for b in range(BITS - 1, 0, -1)):
        for i in range(3):
            swap = f"(xor(x0, x{i}) & {q - 1})"
            new = {0: f"xor(x0, case when x{i} & {q} <> 0 then {q - 1} else {swap} end)"}
            if i:
                new[i] = f"case when x{i} & {q} <> 0 then x{i} else xor(x{i}, {swap}) end"
            listed = ", ".join(f"{e} as x{k}" for k, e in new.items())
            steps.append(f"turn_{q}_{i} as (select * replace ({listed}) from {last})")
            last = f"turn_{q}_{i}"
    twist = "0"
    for q in (1 << b for b in range(BITS - 1, 0, -1)):
        twist = f"xor({twist}, case when g2 & {q} <> 0 then {q - 1} else 0 end)"
    steps.append(f"gray as (select *, x0 as g0, xor(x0, x1) as g1, xor(xor(x0, x1), x2) as g2 from {last})")
    steps.append(f"twisted as (select *, {twist} as t from gray)")
    h = "0"
    for b in range(BITS - 1, -1, -1):
        for i in range(3):
            h = f"({h} * 2 + case when xor(g{i}, t) & {1 << b} <> 0 then 1 else 0 end)"
    steps.append(f"curved as (select *, {h} as h from twisted)")
    return ",\n".join(steps)


def _cuts_sql(column: str) -> str:
    """The quantiles of a column of ``sized``: the value of rank ceil(share * count)."""
    ranks = f"list_transform(range(1, {2**BITS}), lambda i: greatest(1, ceil(i * len(v) / {2**BITS}.0)::int))"
    return f"(select list_distinct(list_transform({ranks}, lambda r: v[r])) from (select list_sort(list({column}) filter ({column} is not null)) as v from sized))"


ORACLE_SQL = f"""
with crc_table as (select {CRC_TABLE} as crc_values), sized as (
  select doc_id, octet_length(encode(coalesce(text, '')))::bigint + 1 as size, {crc_sql("coalesce(text, '')")} as crc,
    length(coalesce(text, '')) as chars, {crc_sql("source")} as source_crc, {crc_sql("lang")} as lang_crc from documents, crc_table
), levelled as (
  select *, {", ".join(f"len(list_filter({_cuts_sql(c)}, lambda k: {c} > k)) as x{i}" for i, c in enumerate(("chars", "source_crc", "lang_crc")))}
  from sized
), {_curve_sql()}, ranked as (
  select *, count(*) over () as total, row_number() over (order by h, crc % {TEXT_BUCKETS},
    ('0x' || substr(md5(doc_id::varchar), 1, 3))::int * {ID_BUCKETS} // {MOST_ID_BUCKETS}, crc, doc_id) - 1 as place from curved
)
select doc_id, size, crc as text_crc32, 'rows' as law, (place * {SHARDS} // total)::int as shard,
  (place - ((place * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS})::bigint as slot, null::int as grown_shard from ranked
"""
