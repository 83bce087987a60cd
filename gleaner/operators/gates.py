"""Gates: ordered rules over columns, each giving (decision, code).

A gate decides REJECT with a code, REVIEW or PASS. Rules are ordered and the first that holds
decides, so every gate is one CASE expression, evaluated in the JVM in one pass.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import clamp01, first_of, weighted_mean, worst_of
from ..functions.text import has_script, has_term
from ..sources.settings import Settings
from .dedupe import _checkpoint

REJECT, REVIEW, PASS, ACCEPT = "REJECT", "REVIEW", "PASS", "ACCEPT"


def gate_result(stage: str, code: Column | None = None, review: Column | None = None, score: Column | None = None) -> Column:
    """A gate's audit row. REJECT stands exactly where there is a code, so neither comes without the other; a rejecting
    gate has no score. A review flag lets the row pass."""
    none = F.lit(None)
    code = (none if code is None else code).cast("string")
    flagged = F.coalesce(F.lit(False) if review is None else review, F.lit(False))
    return F.struct(
        F.lit(stage).alias("stage"),
        F.when(code.isNotNull(), REJECT).when(flagged, REVIEW).otherwise(PASS).alias("decision"),
        code.alias("rejection_code"),
        F.when(code.isNull(), (none if score is None else score).cast("double")).alias("score"),
    )


@dataclass(frozen=True)
class TextRules:
    """Patterns of the text gate; order of ``exclusions`` is the order of their codes.

    A term of an exclusion that holds a character of the target script is looked for as it stands, anywhere; any other is
    trimmed, lower-cased and must stand between characters outside a-z and 0-9.
    """

    foreign_script: str
    foreign_terms: Sequence[str]
    target_script: str
    context_terms: Sequence[str]
    exclusions: Mapping[str, Sequence[str]] = field(default_factory=dict)
    narration_exempt: Sequence[str] = ("SPEECH", "LECTURE", "DISCUSSION")


def text_code(raw: Column, narration: Column, rules: TextRules) -> Column:
    """Code of the first text rule that rejects, else null (before any keyword score)."""
    low = F.lower(raw)
    out = [
        (has_script(raw, rules.foreign_script), "NON_FOLK"),
        (has_term(low, rules.foreign_terms), "NON_FOLK"),
        (~has_script(raw, rules.target_script) & ~has_term(low, rules.context_terms), "NON_FOLK"),
    ]
    for code, terms in rules.exclusions.items():
        native = [t for t in terms if re.search(rules.target_script, t)]
        found = has_term(low, [t.lower().strip() for t in terms if t not in native])
        for term in native:
            found = found | raw.contains(term)
        out.append((found & ~narration if code in rules.narration_exempt else found, code))
    return first_of(out)


def keyword_decision(best: Column, hits: Column, s: Settings = Settings()) -> Column:
    """PASS at the threshold with enough hits, REVIEW within the margin below it, else REJECT."""
    return (
        F.when((best >= s.keyword_threshold) & (hits >= s.keyword_hits), PASS)
        .when(best >= s.keyword_threshold - s.keyword_review_margin, REVIEW)
        .otherwise(REJECT)
    )


def duration_code(seconds: Column, s: Settings = Settings()) -> Column:
    """An unknown duration (null or 0) passes; too long is tried before too short."""
    return F.when(seconds > 0, first_of([(seconds > s.max_duration, "TOO_LONG"), (seconds < s.min_duration, "TOO_SHORT")]))


def integrity_code(exists: Column, size: Column, frames: Column, has_stream: Column, container: Column, pcm: Column) -> Column:
    off = F.abs(container - pcm) > F.greatest(F.lit(1.0), 0.15 * container)
    broken = ~exists | (size == 0) | frames.isNull() | (frames == 0) | ~has_stream | F.coalesce(off, F.lit(False))
    return F.when(broken, F.lit("CORRUPT_AUDIO"))


def quality_rules(m: Mapping[str, Column], limits: Mapping[str, float]) -> list[tuple[Column, str]]:
    """Hard limits in the order they are tried; all are strict."""
    return [
        (m["duration"] < limits["min_duration"], "TOO_SHORT"),
        (m["duration"] > limits["max_duration"], "TOO_LONG"),
        (m["silence"] > limits["silence"], "MOSTLY_SILENT"),
        (m["clipping"] > limits["clipping"], "EXCESSIVE_CLIPPING"),
        (m["dynamic_range"] < limits["dynamic_range"], "SEVERE_DISTORTION"),
        (m["snr"] < limits["snr"], "VERY_LOW_SNR"),
        (m["noise_floor"] > limits["noise_floor"], "EXCESSIVE_NOISE"),
        (m["dropout"] > limits["dropout"], "AUDIO_DROPOUT"),
        ((m["rolloff"] < limits["rolloff"]) | (m["sample_rate"] < limits["sample_rate"]), "LOW_BANDWIDTH"),
    ]


def quality_composite(parts: Mapping[str, tuple[Column, float]]) -> Column:
    """Weighted sum of clamped sub-scores, rounded to four places."""
    total = None
    for score, weight in parts.values():
        term = clamp01(score) * weight
        total = term if total is None else total + term
    return F.round(total, 4)


# Weights of the sub-scores, and the ends of their ranges; the limits are those of the settings.
QUALITY_WEIGHTS = {"silence": 0.18, "clipping": 0.14, "snr": 0.18, "noise": 0.12, "range": 0.12, "dropout": 0.10, "band": 0.10, "loudness": 0.06}
QUALITY_LIMITS = Settings().limits
FULL_SNR, FULL_RANGE, NOISE_SPAN, FULL_BAND = 30.0, 40.0, 30.0, 8000.0
UNKNOWN_LOUDNESS, OFF_LOUDNESS = 0.7, 0.4


def quality_score(m: Mapping[str, Column], limits: Mapping[str, float] = QUALITY_LIMITS) -> Column:
    """Composite of eight sub-scores over ``metrics`` columns and ``lufs``, which may be null."""
    least = lambda x: max(x, 1e-10)
    room = lambda metric: 1 - m[metric] / least(limits[metric])
    in_range = m["lufs"].between(limits["min_lufs"], limits["max_lufs"])
    loudness = F.when(m["lufs"].isNull(), UNKNOWN_LOUDNESS).when(in_range, 1.0).otherwise(OFF_LOUDNESS)
    scores = {
        "silence": room("silence"),
        "clipping": room("clipping"),
        "snr": (m["snr"] - limits["snr"]) / least(FULL_SNR - limits["snr"]),
        "noise": (limits["noise_floor"] - m["noise_floor"]) / NOISE_SPAN,
        "range": (m["dynamic_range"] - limits["dynamic_range"]) / least(FULL_RANGE - limits["dynamic_range"]),
        "dropout": room("dropout"),
        "band": m["rolloff"] / FULL_BAND,
        "loudness": loudness,
    }
    return quality_composite({k: (v, QUALITY_WEIGHTS[k]) for k, v in scores.items()})


def parent_decisions(parts: DataFrame, parent: str) -> DataFrame:
    """A split recording is accepted if any of its parts is, else rejected, without a code."""
    return parts.groupBy(parent).agg(
        F.when(F.bool_or(F.col("decision") == ACCEPT), ACCEPT).otherwise(REJECT).alias("decision"),
        F.lit(None).cast("string").alias("rejection_code"),
    )


def quality_override(m: Mapping[str, Column], limits: Mapping[str, float] = QUALITY_LIMITS) -> Column:
    """Code of a composite that is too low though no limit is broken: of seven metrics the one furthest over its limit.

    The order decides ties. A metric that is not known counts as a good one.
    """
    over = lambda k, good: F.coalesce(m[k], F.lit(good)) - limits[k]
    under = lambda k, good: limits[k] - F.coalesce(m[k], F.lit(good))
    return override_code([
        (over("silence", 0.0), "MOSTLY_SILENT"),
        (over("clipping", 0.0), "EXCESSIVE_CLIPPING"),
        (under("snr", 99.0), "VERY_LOW_SNR"),
        (over("noise_floor", -99.0), "EXCESSIVE_NOISE"),
        (under("dynamic_range", 99.0), "SEVERE_DISTORTION"),
        (over("dropout", 0.0), "AUDIO_DROPOUT"),
        (under("rolloff", 99999.0), "LOW_BANDWIDTH"),
    ])


def override_code(excess: Sequence[tuple[Column, str]]) -> Column:
    """Code of the metric furthest over its limit, in raw units; the first listed wins ties."""
    return F.coalesce(worst_of(excess), F.lit("SEVERE_DISTORTION"))


def sound_label(music: Column, speech: Column, s: Settings = Settings()) -> Column:
    return (
        F.when((music >= s.min_music) & (music >= speech), "SONG")
        .when((speech >= s.max_speech) & (speech > music), "SPEECH")
        .when((music >= s.min_mixed) & (speech >= s.min_mixed), "MIXED")
        .otherwise("UNKNOWN")
    )


def tag_max(names: Sequence[str], tag: Column, prob: Column) -> Column:
    """Aggregate: the highest probability of tags that contain any of the names."""
    return F.max(F.when(tag.rlike("(?i)" + "|".join(names)), prob))


def voiced_ratio(segments: Column, total: Column) -> Column:
    """Share of samples inside (start, end) segments, clamped and rounded."""
    return voiced_share(F.aggregate(segments, F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"])), total)


def voiced_share(inside: Column, total: Column) -> Column:
    """The same of how many samples lie inside, where segments are rows and their lengths were summed."""
    return F.round(clamp01(F.try_divide(inside, total)), 4)


def relevance_decision(similarity: Column, s: Settings = Settings()) -> Column:
    """Compares the unrounded value; an unknown one is for review."""
    return (
        F.when(similarity.isNull(), REVIEW)
        .when(similarity >= s.relevance_pass, PASS)
        .when(similarity >= s.relevance_review, REVIEW)
        .otherwise(REJECT)
    )


def final_score(quality: Column, relevance: Column, music: Column, vocal: Column, s: Settings = Settings()) -> Column:
    w = s.weights
    return weighted_mean([(quality, w["quality"]), (relevance, w["relevance"]), (music, w["music"]), (vocal, w["vocal"])])


def final_code(
    quality: Column, relevance: Column, music: Column, speech: Column, label: Column, narration: Column, score: Column,
    quality_code: Column, s: Settings = Settings(),
) -> Column:
    """Code of the first final rule that rejects, else null."""
    m = F.coalesce(music, F.lit(0.0))
    spoken = (label == "SPEECH") & speech.isNotNull() & (m < s.min_music)
    rules = [
        (spoken & F.when(narration, speech > s.max_narration).otherwise(speech >= s.max_speech), "SPEECH"),
        ((music < s.min_music) & (relevance < s.review), "NON_SONG"),
        ((score < s.review) & (relevance < s.review), "NON_FOLK"),
        (score < s.review, "NON_SONG"),
    ]
    return F.when(quality < s.min_quality, quality_code).otherwise(first_of(rules))


def final_decision(code: Column, score: Column, review: Column, s: Settings = Settings()) -> Column:
    return F.when(code.isNotNull(), REJECT).when((score < s.accept) | review, REVIEW).otherwise(ACCEPT)


def fold_decisions(results: DataFrame, key: str, order: str) -> DataFrame:
    """One decision a key from its gate results: any REJECT, with the first one's code, beats
    any REVIEW, which beats ACCEPT."""
    rejected = F.col("decision") == REJECT
    code = F.min(F.when(rejected, F.struct(F.col(order).alias("o"), F.col("rejection_code").alias("c"))))
    return results.groupBy(key).agg(
        F.when(F.bool_or(rejected), REJECT).when(F.bool_or(F.col("decision") == REVIEW), REVIEW).otherwise(ACCEPT).alias("decision"),
        code["c"].alias("rejection_code"),
    )


def decision_counts(rows: DataFrame, category: str) -> DataFrame:
    """A row a category with its number of each decision."""
    return rows.groupBy(category).agg(*(F.count_if(F.col("decision") == x).alias(x.lower()) for x in (ACCEPT, REVIEW, REJECT)))


def run_chain(candidates: DataFrame, gates: Sequence[tuple[str, Column | Callable[[DataFrame], DataFrame]]]) -> DataFrame:
    """Apply gates in turn to survivors only; adds the ``stage`` that rejected a row (``DONE``: none) and its ``code``.

    Each gate is (stage, code column) or (stage, function of a DataFrame giving it a ``code`` column). Columns are part of
    one plan. Before a function the rows are written, so that it sees survivors alone and nothing before it runs again.
    """
    none = F.lit(None).cast("string")
    rows = candidates.withColumns({"stage": none, "code": none})
    started = False
    for stage, gate in gates:
        if isinstance(gate, Column):
            hit = rows.withColumn("_hit", F.when(F.col("stage").isNull(), gate))
            rows = hit.withColumns(
                {"stage": F.coalesce("stage", F.when(F.col("_hit").isNotNull(), F.lit(stage))), "code": F.coalesce("code", "_hit")}
            ).drop("_hit")
        else:
            rows = _checkpoint(rows) if started else rows
            alive = candidates if not started else rows.where("stage is null").select(*candidates.columns)
            seen = gate(alive).select(*candidates.columns, "code")
            seen = seen.withColumn("stage", F.when(F.col("code").isNotNull(), F.lit(stage)))
            rows = rows.where("stage is not null").unionByName(seen) if started else seen
        started = True
    return rows.withColumn("stage", F.coalesce("stage", F.lit("DONE"))).select(*candidates.columns, "stage", "code")
