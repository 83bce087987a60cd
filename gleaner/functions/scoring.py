"""Scores as column arithmetic."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

add = lambda cols: reduce(lambda a, b: a + b, cols)


def clamp01(x: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), x))


def decibels(x: Column) -> Column:
    return 20 * F.log10(F.greatest(x, F.lit(1e-10)))


def weighted_mean(parts: Sequence[tuple[Column, float]]) -> Column:
    """Mean over the values that are not null, weights renormalised to them; 0 if all are null."""
    total = add(F.coalesce(v * w, F.lit(0.0)) for v, w in parts)
    weight = add(F.when(v.isNull(), 0.0).otherwise(w) for v, w in parts)
    return F.round(F.coalesce(total / F.nullif(weight, F.lit(0.0)), F.lit(0.0)), 4)


def first_of(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """The label of the first rule that holds."""
    picked = reduce(lambda acc, r: acc.when(*r), rules[1:], F.when(*rules[0])) if rules else F.when(F.lit(False), "")
    return picked.otherwise(F.lit(default).cast("string"))


def worst_of(excess: Sequence[tuple[Column, str]]) -> Column:
    """The label with the largest value; the first listed wins ties; null values count least."""
    rows = [
        F.struct(F.coalesce(v, F.lit(float("-inf"))).alias("d"), F.lit(-i).alias("o"), F.lit(c).alias("c"))
        for i, (v, c) in enumerate(excess)
    ]
    return F.array_max(F.array(*rows))["c"]


def dot(a: Column, b: Column) -> Column:
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda s, x: s + x)


def hamming_similarity(a: Column, b: Column) -> Column:
    """Share of equal bits of two arrays of 32-bit words over their common prefix; 0 if that is empty."""
    n = F.least(F.size(a), F.size(b))
    mask = F.lit(0xFFFFFFFF)
    bits = F.zip_with(F.slice(a, 1, F.greatest(n, F.lit(0))), F.slice(b, 1, F.greatest(n, F.lit(0))), lambda x, y: F.bit_count(x.bitwiseXOR(y).bitwiseAND(mask)))
    different = F.aggregate(bits, F.lit(0), lambda s, x: s + x)
    return F.when(n > 0, 1 - different / (32 * n)).otherwise(F.lit(0.0))
