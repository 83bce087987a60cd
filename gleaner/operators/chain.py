"""Candidates from their columns to a decision: every gate in order, with one audit row each."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scoring import first_of
from ..functions.text import keyword_scores, media_id
from ..sources.settings import Settings
from . import gates
from .dedupe import _checkpoint, greedy
from .gates import ACCEPT, PASS, REJECT, REVIEW, TextRules, gate_result
from .relevance import relevance_result

METRICS = ("duration", "silence", "clipping", "dynamic_range", "snr", "noise_floor", "dropout", "rolloff", "sample_rate", "lufs")
HEARD = ("music", "speech", "vocal", "similarity")


def address_candidates(addresses: DataFrame, category: str) -> DataFrame:
    """Candidates of a category from a column ``url`` of addresses or bare ids; they have no title or description yet."""
    empty = F.lit("")
    return addresses.select(
        media_id(F.trim("url")).alias("recording_id"), F.lit(category).alias("category_slug"), empty.alias("title"), empty.alias("description"), "url"
    )


def pending(candidates: DataFrame, log: DataFrame, stored: DataFrame) -> DataFrame:
    """Candidates that neither the run log nor the stored outputs hold.

    An outer join in place of an anti-join, which Spark would move below ``screen`` and so onto rows that still have their texts.
    """
    done = log.select("recording_id").unionByName(stored.select("recording_id")).distinct().withColumn("_done", F.lit(True))
    return candidates.join(done, "recording_id", "left").where("_done is null").drop("_done")


PROBE = ("exists", "size", "frames", "has_stream", "container", "pcm")


def _up_to_reject(rows: DataFrame, gates_in_order: list[Column]) -> DataFrame:
    """The rows with ``results``: those of the gates up to the first that rejects. Each is worked out once, as a column of its own."""
    rows = rows.withColumn("_all", F.array(*gates_in_order))
    rows = rows.withColumn("_first", F.array_position(F.transform("_all", lambda r: r["decision"]), REJECT).cast("int"))
    return rows.withColumn("results", F.slice("_all", F.lit(1), F.when(F.col("_first") > 0, F.col("_first")).otherwise(F.size("_all")))).drop("_all", "_first")


def _open() -> Column:
    """Whether the last gate let the row through; a part has none yet."""
    return F.coalesce(F.try_element_at("results", F.lit(-1))["decision"] != REJECT, F.lit(True))


def _with_keyword_score(rows: DataFrame, s: Settings) -> DataFrame:
    """``best`` and ``hits`` of the category's ``keywords``, for rows that the text rules let through; the others' are null."""
    scored = keyword_scores(F.when(F.col("_text").isNull(), F.col("raw")), F.col("keywords"), s.keyword_threshold)
    rows = rows.withColumn("_scored", scored)
    return rows.withColumns({"best": F.col("_scored.best"), "hits": F.col("_scored.hits")}).drop("_scored")


def screen(candidates: DataFrame, rules: TextRules, s: Settings = Settings()) -> DataFrame:
    """Candidates with ``results`` of the gates that need no samples: text, length, fetch and integrity, up to the first that rejects.

    No row moves here. Joins with the log or with prints come after it, on rows without ``raw``, else they move every text.
    """
    c = F.col
    rows = candidates.withColumn("_text", gates.text_code(c("raw"), c("narration"), rules))
    if "keywords" in rows.columns:
        rows = _with_keyword_score(rows, s)
    rows = rows.withColumn("_keyword", gates.keyword_decision(c("best"), c("hits"), s))
    rows = rows.withColumns(
        {
            "_text": F.coalesce("_text", F.when(c("_keyword") == REJECT, "NON_FOLK")),
            "_length": gates.duration_code(c("duration"), s),
            "_fetch": F.when(~c("fetched"), "DOWNLOAD_FAILED") if "fetched" in rows.columns else F.lit(None).cast("string"),
            "_integrity": gates.integrity_code(*(c("probe")[k] for k in PROBE)),
        }
    )
    found = [
        gate_result("metadata_gate", c("_text"), c("_keyword") == REVIEW, F.round(c("best") / 100, 4)),
        gate_result("metadata_gate", c("_length")),
        *([gate_result("download", c("_fetch"))] if "fetched" in rows.columns else []),
        gate_result("integrity_gate", c("_integrity")),
    ]
    return _up_to_reject(rows, found).drop("_text", "_keyword", "_length", "_fetch", "_integrity")


def _parts(screened: DataFrame, pieces: DataFrame, s: Settings) -> DataFrame:
    """Rows of the parts of recordings that are still open, and of all others as they are.

    Parts start afresh: what the recording was flagged for before is not held against them.
    """
    whole = screened.withColumn("parent_id", F.lit(None).cast(screened.schema["recording_id"].dataType))
    cut = pieces.where(F.col("piece") < s.max_parts)
    names = [f.name for f in screened.schema if f.name in pieces.columns and f.name != "recording_id"]
    named = screened.where(_open()).join(cut.select(F.col("recording_id").alias("_id"), "piece", *(F.col(n).alias(f"_{n}") for n in names)), F.col("recording_id") == F.col("_id"))
    at = F.col("ord") * (s.max_parts + 1)
    own = {n: F.col(f"_{n}") for n in names} | {
        "parent_id": F.col("recording_id"),
        "recording_id": F.format_string("%s_p%02d", F.col("recording_id").cast("string"), F.col("piece") + 1),
        "at": at + F.col("piece") + 1,
        "results": F.slice("results", F.lit(1), F.lit(0)),
    }
    parts = named.withColumns(own).drop("_id", "piece", *(f"_{n}" for n in names))
    split = cut.select("recording_id").distinct()
    return parts.unionByName(whole.withColumn("at", at).join(split, "recording_id", "left_anti")).unionByName(
        whole.withColumn("at", at).where(~_open()).join(split, "recording_id", "left_semi")
    )


def decide(
    candidates: DataFrame, rules: TextRules, signals: Callable[[DataFrame], DataFrame] | None = None, stored: DataFrame | None = None,
    s: Settings = Settings(), limits: Mapping[str, float] | None = None, pieces: DataFrame | None = None,
) -> DataFrame:
    """(recording_id, category_slug, ord, fp, stage, decision, rejection_code, final_score, results), and parent_id with ``pieces``.

    Candidates have ``recording_id category_slug ord raw narration duration``, either ``keywords`` or their score as ``best hits``,
    a struct ``probe`` of PROBE, a struct ``metrics`` of METRICS, a print ``fp``, and HEARD; with a column ``fetched`` rows where it is false
    are rejected as DOWNLOAD_FAILED. Where models make HEARD, ``signals`` adds them to rows that are still in the chain and of
    enough quality; it is applied to each such row once. ``results`` holds the row of each gate that was reached. Prints meet those
    of candidates that came before by ``ord`` and passed the duplicate gate, and those of ``stored`` (ord, fp), whose orders lie below.
    Only rows of these columns are written or shuffled, never ``raw``. Rows that have ``results`` are taken as screened, by the same settings.

    ``pieces(recording_id, piece, ...)`` are the parts, from 0, of recordings that were split, with the columns that a part has of its own (metrics,
    fp, HEARD). A recording that is open after the integrity gate then stands as its parts, ``max_parts`` of them at most, as the feature asks,
    and has a row that is an ACCEPT if any part's is, else a REJECT, without a code; ids must be strings.
    """
    c = F.col
    limits = limits or s.limits
    m = {k: c("metrics")[k] for k in METRICS}
    rows = candidates if "results" in candidates.columns else screen(candidates, rules, s)
    ids, at = ["recording_id", "category_slug", "ord"], "ord"
    if pieces is not None:
        rows, at = _checkpoint(rows.drop("raw", "keywords")), "at"
        screened, rows = rows, _parts(rows, pieces, s)
        ids += ["parent_id", "at"]
        stored = None if stored is None else stored.withColumn("ord", c("ord") * (s.max_parts + 1))
    rows = rows.withColumn("before", c("results"))
    rows = rows.withColumns({"quality": gates.quality_score(m, limits), "_quality": first_of(gates.quality_rules(m, limits))})
    measured = gate_result("quality_gate", c("_quality"), c("quality") < s.min_quality, c("quality"))
    rows = rows.withColumn("results", F.when(_open(), F.concat("before", F.array(measured))).otherwise(c("before"))).drop("before", "_quality")
    own = [*ids, "fp", "narration", "metrics", "quality", "results"]
    rows = rows.withColumn("heard", _open() & ~F.coalesce(c("quality") < s.min_quality, F.lit(False)))
    if signals:
        rows = _checkpoint(rows.drop("raw", "keywords"))
        given = signals(rows.where("heard")).select(*own, F.lit(True).alias("heard"), *HEARD)
        rows = given.unionByName(rows.where("not heard").select(*own, "heard"), allowMissingColumns=True)
    else:
        rows = rows.select(*own, "heard", *(F.when(c("heard"), c(k)).alias(k) for k in HEARD))
    models = F.array(
        gate_result("classifier", score=c("music")), gate_result("vad", score=c("vocal")), relevance_result(c("similarity"), s)
    )
    rows = rows.withColumn("results", F.when(c("heard"), F.concat("results", models)).otherwise(c("results")))
    rows = _checkpoint(rows.withColumn("heard", c("heard") & _open()))

    prints = rows.where("heard").select(c(at).alias("ord"), "fp")
    copies = greedy(prints, s.duplicate_similarity, stored).where("duplicate_of is not null")
    rows = rows.join(copies.select(c("ord").alias(at), F.lit("DUPLICATE_RECORDING").alias("copy")), at, "left")
    rows = rows.withColumn("results", F.when(c("heard"), F.concat("results", F.array(gate_result("duplicate_gate", c("copy"))))).otherwise(c("results")))
    rows = rows.withColumn("open", _open())

    relevance = F.round("similarity", 4)
    score = gates.final_score(c("quality"), relevance, c("music"), c("vocal"), s)
    label = gates.sound_label(c("music"), c("speech"), s)
    rows = rows.withColumns({"final_score": F.when(c("open"), score), "label": label, "override": gates.quality_override(m, limits)})
    code = gates.final_code(c("quality"), relevance, c("music"), c("speech"), c("label"), c("narration"), c("final_score"), c("override"), s)
    rows = rows.withColumn("code", code)
    final = gate_result("final_scoring", c("code"), c("final_score") < s.accept, c("final_score"))
    rows = rows.withColumn("results", F.when(c("open"), F.concat("results", F.array(final))).otherwise(c("results")))
    rows = rows.withColumn("last", F.element_at("results", -1))
    review = F.exists("results", lambda r: r["decision"] == REVIEW)
    decision = F.when(c("last.decision") == REJECT, REJECT).when(review, REVIEW).otherwise(ACCEPT)
    decided = rows.select(
        *(i for i in ids if i != "at"), "fp", c("last.stage").alias("stage"), decision.alias("decision"), c("last.rejection_code").alias("rejection_code"), "final_score", "results"
    )
    if pieces is None:
        return decided
    parents = gates.parent_decisions(decided.where("parent_id is not null"), "parent_id").withColumnRenamed("parent_id", "_id")
    empty = F.lit(None)
    whole = screened.join(parents, c("recording_id") == c("_id")).select(
        *ids[:3], empty.cast(dict(screened.dtypes)["recording_id"]).alias("parent_id"), empty.cast(dict(decided.dtypes)["fp"]).alias("fp"), F.lit("chunking").alias("stage"), "decision", "rejection_code",
        empty.cast("double").alias("final_score"), "results",
    )
    return decided.unionByName(whole)


def new_prints(decided: DataFrame) -> DataFrame:
    """(recording_id, fp) of candidates that passed the duplicate gate, whatever came after; these are stored."""
    passed = F.exists("results", lambda r: (r["stage"] == "duplicate_gate") & (r["decision"] == PASS))
    return decided.where(passed & (F.size("fp") > 0)).select("recording_id", "fp")
