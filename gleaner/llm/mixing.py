"""Mixing sources to target weights by Poisson replication.

With target weights w and n rows of a source among N, every row of that source is repeated a
Poisson-distributed number of times with mean N * w / n, so that each source expects N * w rows.
The count inverts the distribution at a uniform number hashed from seed and id: the same row
gets the same count on every run, however the table is partitioned, and no task needs to know
of another. A mean above ``PART_MEAN`` is a sum of equal Poisson parts, each with a hash of its
own, so the inversion never underflows. The copies are then ordered by a hash over id and
copy number: a global shuffle by one range exchange.

The per-source table is broadcast while it has at most ``BROADCAST_SOURCES`` rows, a size that
is checked; beyond it rows and table are joined on source and a salt, so that a source with a
third of all rows is spread over ``SALTS`` tasks.

Defined cases: a null source is a source of its own; sources missing from ``weights`` have
weight 0 and lose all rows; a null id hashes like the text 'null', repeated rows have equal
counts; an empty table stays empty; a null or empty text is carried like any other, and other
columns are carried along (``copy`` and ``shuffle_key`` are replaced if present).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = 17
PART_MEAN = 16.0
BROADCAST_SOURCES = 10_000
SALTS = 32
_TERMS = 100


def _hash52(*parts: Column) -> Column:
    """52 bits of the MD5 of the parts, joined by colons."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """(_mix_source, _mix_parts, _mix_cdf) for each source; the last is that of one part.

    ``weights`` None gives all sources of the table equal weights.
    """
    counts = docs.groupBy(F.col("source").alias("_mix_source")).agg(F.count("*").alias("n"))
    if weights is None:
        weighted = counts.withColumn("w", F.lit(1.0))
    else:
        given = docs.sparkSession.createDataFrame(list(weights.items()), "s string, w double")
        weighted = counts.join(given, F.col("_mix_source").eqNullSafe(F.col("s")), "left").fillna({"w": 0.0}).drop("s")
    totals = weighted.agg(F.sum("n").alias("rows"), F.sum("w").alias("weight"))
    rated = weighted.join(F.broadcast(totals))  # one row
    rated = rated.withColumn("rate", F.col("rows") * F.try_divide("w", "weight") / F.col("n")).where("rate > 0")
    rated = rated.withColumn("parts", F.ceil(F.col("rate") / PART_MEAN).cast("int"))
    return rated.withColumn("mean", F.col("rate") / F.col("parts")).select(
        "_mix_source",
        F.col("parts").alias("_mix_parts"),
        F.expr(
            f"""array_distinct(aggregate(sequence(1, {_TERMS}),
                  named_struct('p', exp(-mean), 'cdf', array(exp(-mean))),
                  (s, k) -> named_struct('p', s.p * mean / k,
                                         'cdf', concat(s.cdf, array(element_at(s.cdf, -1) + s.p * mean / k))),
                  s -> s.cdf))"""
        ).alias("_mix_cdf"),
    )


def mix(docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = SEED) -> DataFrame:
    """``docs`` replicated to the target weights and shuffled, with columns copy and shuffle_key."""
    rates = source_rates(docs, weights)
    rows = docs.drop("copy", "shuffle_key")
    same = F.col("source").eqNullSafe(F.col("_mix_source"))
    if rates.count() <= BROADCAST_SOURCES:
        joined = rows.join(F.broadcast(rates), same)
    else:
        salted = rates.withColumn("_mix_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")
        joined = rows.join(salted, same & (own == F.col("_mix_salt"))).drop("_mix_salt")
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    counted = joined.withColumn("_doc", doc).withColumn(
        "_u", F.transform(F.sequence(F.lit(1), "_mix_parts"), lambda j: _hash52(F.col("_doc"), j.cast("string"), F.lit(str(seed))) / F.lit(float(1 << 52)))
    )
    times = F.expr("aggregate(_u, 0, (n, u) -> n + size(filter(_mix_cdf, c -> c <= u)))")
    copies = counted.withColumn("_times", times).where("_times > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "_times")))
    keyed = copies.withColumn("shuffle_key", _hash52(F.col("_doc"), F.col("copy").cast("string"), F.lit(f"order {seed}")))
    keyed = keyed.drop("_mix_source", "_mix_parts", "_mix_cdf", "_doc", "_u", "_times")
    return keyed.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key", "doc_id", "copy")


ORACLE_SQL = f"""
with counts as (
  select source as s, count(*) as n from documents group by 1
), rated as (
  select s, sum(n) over () / (count(*) over ()) / n::double as rate from counts
), parted as (
  select s, ceil(rate / {PART_MEAN})::int as parts, rate / ceil(rate / {PART_MEAN}) as mean from rated
), cdf as (
  select s, parts, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) over (partition by s order by k) as c
  from parted, range({_TERMS + 1}) t(k)
), draws as (
  select doc_id, d.source, p.s, ('0x' || substr(md5(doc_id || ':' || j.j || ':{SEED}'), 1, 13))::bigint / {float(1 << 52)} as u
  from documents d join parted p on d.source is not distinct from p.s, lateral (select unnest(range(1, p.parts + 1)) as j) j
), times as (
  select doc_id, (select sum((select count(*) from cdf where cdf.s is not distinct from draws.s and c <= u))
                  from draws where draws.doc_id = documents.doc_id) as n
  from documents
)
select d.*, i.copy::int as copy,
  ('0x' || substr(md5(d.doc_id || ':' || i.copy || ':order {SEED}'), 1, 13))::bigint as shuffle_key
from documents d join times t using (doc_id), lateral (select unnest(range(1, t.n::bigint + 1)) as copy) i
"""
