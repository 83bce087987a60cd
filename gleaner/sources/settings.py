"""Thresholds of the gates with their checks, and the category table."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CATEGORY_SCHEMA = """id int, folder_slug string, native_name string, english_name string, family string,
    search_queries map<string, array<string>>, reference_concepts array<string>, allow_spoken_narration boolean"""


# The sections that a settings file must have, and where each setting stands in it.
SECTIONS = (
    "state_name", "device", "storage", "run_log", "workers", "retry", "search", "download", "audio", "metadata_gate", "quality_gate", "classifier",
    "vad", "folk_relevance", "duplicate", "scoring", "transcription", "logging",
)
FILE_KEYS = {
    "min_duration": ("audio", "minimum_duration_sec"),
    "max_duration": ("audio", "maximum_duration_sec"),
    "keyword_threshold": ("metadata_gate", "fuzzy_match_threshold"),
    "keyword_hits": ("metadata_gate", "min_keyword_hits"),
    "keyword_review_margin": ("metadata_gate", "review_margin"),
    "min_quality": ("quality_gate", "minimum_quality_score"),
    "max_silence": ("quality_gate", "maximum_silence_ratio"),
    "silence_level": ("quality_gate", "near_silence_dbfs"),
    "max_clipping": ("quality_gate", "maximum_clipping_ratio"),
    "clipping_level": ("quality_gate", "clipping_sample_threshold"),
    "min_snr": ("quality_gate", "minimum_snr_db"),
    "max_noise_floor": ("quality_gate", "maximum_noise_floor_dbfs"),
    "min_dynamic_range": ("quality_gate", "minimum_dynamic_range_db"),
    "min_lufs": ("quality_gate", "loudness", "min_lufs"),
    "max_lufs": ("quality_gate", "loudness", "max_lufs"),
    "max_dropout": ("quality_gate", "dropout", "max_dropout_ratio"),
    "min_rolloff": ("quality_gate", "bandwidth", "min_rolloff_hz"),
    "min_sample_rate": ("quality_gate", "min_sample_rate"),
    "min_music": ("classifier", "music_min_prob"),
    "max_speech": ("classifier", "speech_reject_prob"),
    "min_mixed": ("classifier", "mixed_low"),
    "accept": ("scoring", "accept_threshold"),
    "review": ("scoring", "review_threshold"),
    "weights": ("scoring", "weights"),
    "relevance_pass": ("folk_relevance", "accept_similarity"),
    "relevance_review": ("folk_relevance", "review_similarity"),
    "relevance_band": ("folk_relevance", "uncertain_band"),
    "second_weight": ("folk_relevance", "clap", "blend_weight"),
    "second_model": ("folk_relevance", "clap", "enabled"),
    "duplicate_similarity": ("duplicate", "fingerprint_similarity"),
    "print_seconds": ("duplicate", "fpcalc_length_sec"),
    "split": ("chunking", "enabled"),
    "split_above": ("chunking", "chunk_threshold_sec"),
    "part_target": ("chunking", "target_chunk_duration_sec"),
    "part_min": ("chunking", "min_chunk_duration_sec"),
    "part_max": ("chunking", "max_chunk_duration_sec"),
    "max_parts": ("chunking", "max_chunks_per_video"),
}
# Keys of the sections above that set nothing here. Terms are read by ``exclusions_from_file``; the others name
# models and programs, or decide nothing.
OTHER_KEYS = (
    ("metadata_gate", "exclude_terms"), ("quality_gate", "dropout", "gap_min_ms"), ("classifier", "default_max_speech_ratio"),
    ("folk_relevance", "embedding_model"), ("folk_relevance", "clap", "model_name"), ("duplicate", "fpcalc_path"),
    ("chunking", "silence_thresh_db"), ("chunking", "min_silence_len_sec"),
)
WEIGHT_NAMES = {"folk_relevance": "relevance", "music_speech": "music", "vad": "vocal"}


class SettingsError(ValueError):
    """A setting is missing or contradicts another."""


@dataclass(frozen=True)
class Settings:
    """Limits whose defaults results depend on."""

    min_duration: float = 10.0
    max_duration: float = 300.0
    keyword_threshold: float = 70.0
    keyword_review_margin: float = 8.0
    min_quality: float = 0.55
    accept: float = 0.50
    review: float = 0.40
    weights: Mapping[str, float] = field(default_factory=lambda: {"quality": 0.40, "relevance": 0.30, "music": 0.20, "vocal": 0.10})
    relevance_pass: float = 0.35
    relevance_review: float = 0.25
    relevance_band: float = 0.06
    duplicate_similarity: float = 0.90
    keyword_hits: int = 1
    max_silence: float = 0.45
    silence_level: float = -55.0
    max_clipping: float = 0.05
    clipping_level: float = 0.99
    min_snr: float = 5.0
    max_noise_floor: float = -25.0
    min_dynamic_range: float = 4.0
    min_lufs: float = -45.0
    max_lufs: float = -4.0
    max_dropout: float = 0.10
    min_rolloff: float = 3000.0
    min_sample_rate: float = 16000.0
    min_music: float = 0.25
    max_speech: float = 0.85
    min_mixed: float = 0.25
    max_narration: float = 0.92  # in no file
    second_weight: float = 0.5
    second_model: bool = True
    print_seconds: float = 120.0
    split: bool = True
    split_above: float = 300.0
    part_target: float = 120.0
    part_min: float = 30.0
    part_max: float = 180.0
    max_parts: int = 5

    @property
    def limits(self) -> dict[str, float]:
        """The limits of the quality gate by metric."""
        return {
            "min_duration": self.min_duration, "max_duration": self.max_duration, "silence": self.max_silence, "clipping": self.max_clipping,
            "dynamic_range": self.min_dynamic_range, "snr": self.min_snr, "noise_floor": self.max_noise_floor, "dropout": self.max_dropout,
            "rolloff": self.min_rolloff, "sample_rate": self.min_sample_rate, "min_lufs": self.min_lufs, "max_lufs": self.max_lufs,
        }

    def __post_init__(self) -> None:
        if not 0 < self.min_quality <= 1:
            raise SettingsError("min_quality must lie in (0, 1]")
        if self.accept <= self.review:
            raise SettingsError("accept must exceed review")
        if abs(sum(self.weights.values()) - 1) > 1e-6:
            raise SettingsError("weights must sum to 1")
        if self.min_duration > self.max_duration:
            raise SettingsError("min_duration must not exceed max_duration")

    @classmethod
    def from_mapping(cls, given: Mapping[str, Any]) -> Settings:
        unknown = set(given) - set(cls.__dataclass_fields__)
        if unknown:
            raise SettingsError(f"unknown settings: {sorted(unknown)}")
        return cls(**given)

    @classmethod
    def from_file(cls, path: str) -> Settings:
        """Settings of a YAML file by sections.

        Every section of SECTIONS must be there; what a section leaves out keeps its default. A key in a
        section of the gates that sets nothing is an error, so that no limit is silently left at its default.
        """
        given = _sections(path)
        missing = [name for name in SECTIONS if name not in given]
        if missing:
            raise SettingsError(f"missing sections: {missing}")
        known = {*FILE_KEYS.values(), *OTHER_KEYS}
        idle = [path for path in _leaves(given, {k[:i] for k in known for i in range(1, len(k))}) if path[0] in _GATES and path not in known]
        if idle:
            raise SettingsError(f"keys without effect: {['.'.join(map(str, p)) for p in idle]}")
        found: dict[str, Any] = {}
        for name, path in FILE_KEYS.items():
            value: Any = given
            for key in path:
                value = (value or {}).get(key)
            if value is None:
                continue
            if name == "weights":
                found[name] = {WEIGHT_NAMES.get(k, k): float(w) for k, w in value.items()}
            else:
                found[name] = type(getattr(cls, name))(value)
        return cls(**found)


_GATES = {path[0] for path in FILE_KEYS.values()}


def _sections(path: str) -> dict[str, Any]:
    import yaml

    with open(path, encoding="utf-8") as f:
        given = yaml.safe_load(f)
    if not isinstance(given, dict):
        raise SettingsError("the file holds no sections")
    return given


def _leaves(given: Mapping[Any, Any], inner: set[tuple], at: tuple = ()) -> Iterable[tuple]:
    """Paths of the keys, down to those that aren't among the inner ones."""
    for key, value in given.items():
        path = (*at, key)
        if path in inner and isinstance(value, Mapping):
            yield from _leaves(value, inner, path)
        elif path not in inner:
            yield path


def exclusions_from_file(path: str) -> dict[str, tuple[str, ...]]:
    """The terms of the text gate by code, in the file's order; a code that isn't among CODES is left out with a warning."""
    given = ((_sections(path).get("metadata_gate") or {}).get("exclude_terms")) or {}
    for code in given.keys() - CODES:
        warnings.warn(f"unknown code {code} is left out", stacklevel=2)
    return {code: tuple(terms or ()) for code, terms in given.items() if code in CODES}


# All rejection codes.
CODES = frozenset(
    """TOO_SHORT TOO_LONG CORRUPT_AUDIO MOSTLY_SILENT EXCESSIVE_CLIPPING SEVERE_DISTORTION VERY_LOW_SNR EXCESSIVE_NOISE AUDIO_DROPOUT LOW_BANDWIDTH
    INTERVIEW SPEECH PODCAST NEWS LECTURE DISCUSSION SERMON STORY_ONLY NON_SONG NON_FOLK DUPLICATE_RECORDING DOWNLOAD_FAILED""".split()
)


def categories(spark: SparkSession, rows: Iterable[Mapping[str, Any]]) -> DataFrame:
    """The category dimension; slugs are unique and the named fields required."""
    fields = StructType.fromDDL(CATEGORY_SCHEMA).names
    rows = [dict(r) for r in rows]
    for r in rows:
        missing = [f for f in ("id", "folder_slug", "native_name", "english_name") if r.get(f) in (None, "")]
        if missing:
            raise SettingsError(f"category without {missing}")
    slugs = [r["folder_slug"] for r in rows]
    if len(set(slugs)) != len(slugs):
        raise SettingsError("folder_slug must be unique")
    return spark.createDataFrame([tuple(map(r.get, fields)) for r in rows], CATEGORY_SCHEMA)


VARIANTS = ("tamil", "english", "tanglish", "qualified")  # fixed values: query variants in their order


def all_queries(search_queries: Column) -> Column:
    """The queries of all variants in order, as one array."""
    return F.concat(*(F.coalesce(F.try_element_at(search_queries, F.lit(v)), F.array().cast("array<string>")) for v in VARIANTS))


def keywords(native: Column, english: Column, native_queries: Column) -> Column:
    """Names, parts of the English name between ``/`` and ``,``, and native queries; each once, in any case."""
    given = F.concat(F.array(native, english), F.split(english, "[/,]"), F.coalesce(native_queries, F.array().cast("array<string>")))
    terms = F.filter(F.transform(given, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))
    # An array of one: a lambda works out what it refers to outside once a term, but its own variable once a row.
    lowered = F.array(F.transform(terms, lambda x: F.lower(x)))
    return F.flatten(F.transform(lowered, lambda low: F.filter(terms, lambda x, i: F.array_position(low, F.lower(x)) == i + 1)))


def unknown_slugs(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates whose category is not in the dimension."""
    return candidates.join(known, candidates["category_slug"] == known["folder_slug"], "left_anti")
