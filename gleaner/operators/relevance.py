"""Relevance of a candidate to the concepts of its category, over vectors of any encoder."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.scoring import dot
from ..sources.settings import Settings
from .gates import REJECT, REVIEW, gate_result, relevance_decision

def concepts(given: Column, english_name: Column) -> Column:
    """The reference concepts of a category; one made of its name where it has none."""
    made = F.array(F.concat(F.lit("Tamil folk "), english_name, F.lit(" traditional song")))
    return F.when(F.size(given) > 0, given).otherwise(made)


def best_similarity(vector: Column, references: Column) -> Column:
    """The highest dot product with any reference (cosine for unit vectors); 0 without references, null without a vector."""
    best = F.array_max(F.transform(references, lambda r: dot(vector, r)))
    return F.when(vector.isNotNull(), F.coalesce(best, F.lit(0.0)))


def undecided(similarity: Column, s: Settings = Settings()) -> Column:
    """Whether the similarity lies in the band around the review limit, where a second model is asked."""
    return F.coalesce(F.lit(s.second_model) & (F.abs(similarity - s.relevance_review) <= s.relevance_band), F.lit(False))


def blend(similarity: Column, second: Column, s: Settings = Settings()) -> Column:
    """In the band a mean with the second model's answer; the first alone elsewhere or where the second has none."""
    both = (1 - s.second_weight) * similarity + s.second_weight * second
    return F.when(undecided(similarity, s) & second.isNotNull(), both).otherwise(similarity)


def relevance_result(similarity: Column, s: Settings = Settings()) -> Column:
    """The gate's row; limits meet the unrounded value, the score is rounded."""
    decision = relevance_decision(similarity, s)
    return gate_result("folk_relevance_gate", F.when(decision == REJECT, "NON_FOLK"), decision == REVIEW, F.round(similarity, 4))
