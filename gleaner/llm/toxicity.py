"""Toxicity scores by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; documents of the learning folds, whatever their
label, are the unlabelled set. With class prior p, the risk of a scorer g under logistic loss is
``p * E_pos[loss(g)] + max(0, E_unl[loss(-g)] - p * E_pos[loss(-g)])``: the second term is the
risk on negatives, estimated without any, and is kept from going below zero (where it does,
its gradient is reversed, as an overfitting scorer would drive it down without end). The
prior is the toxic share of the labelled rows of the learning folds.

Features are whole words and word prefixes of 4 to 6 letters, counted over the whole text and
divided by the number of words plus ``SMOOTHING``. The scorer is linear in them, so a text is
scored by adding up one cached number a word. ``ENSEMBLE`` numpy classifiers, each with
its own share of the unlabelled sample, are averaged.

The learning sample is bounded: at most ``MAX_POSITIVE`` positives and ``MAX_UNLABELLED``
unlabelled documents, those smallest by a hash of the id, one row an id, whatever their length: a
text is counted whole into at most ``2**HASH_BITS`` features. Features are screened in Spark; what
reaches the driver is the sample's columns of at most ``MAX_FEATURES`` features, some 12 MB.
All texts are scored whole.

Defined cases: a null or empty text, or one without words, scores by the intercept alone; rows
with a null id are never learned from and count as held out; a document labelled twice is
toxic if any of its labels is; of rows that share an id the one whose text has the least MD5 is learned
from; without a single positive every score is 0; repeated rows
are scored alike; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from .common import materialize

FOLDS, HELD_OUT_FOLD = 3, 1
THRESHOLD = 0.7
MAX_POSITIVE, MAX_UNLABELLED = 3000, 6000
HASH_BITS = 20
PREFIXES = (4, 5, 6)
SMOOTHING = 20
MAX_FEATURES = 300
MIN_SHARE, MIN_Z = 0.03, 3.0
ENSEMBLE = 3
_UNIT = 1 << 40
_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    """Weights by hashed feature, intercept; empty weights with intercept None score 0."""

    weights: dict[int, float]
    intercept: float | None


def _features(word: str) -> list[int]:
    mask = (1 << HASH_BITS) - 1
    parts = ["=" + word, *(word[:n] for n in PREFIXES if len(word) >= n)]
    return [crc32(p.encode("utf-8", "surrogatepass")) & mask for p in parts]


def feature_counts(text: str | None) -> tuple[Counter[int], int]:
    """Counts of hashed features, and the number of words."""
    words = Counter(_WORD.findall((text or "").lower()))
    counts: Counter[int] = Counter()
    for word, n in words.items():
        for f in set(_features(word)):
            counts[f] += n
    return counts, sum(words.values())


def held_out(doc_id: Column) -> Column:
    fold = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(fold == HELD_OUT_FOLD, F.lit(True))


def _sampled_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, positive, text in zip(batch["doc_id"], batch["positive"], batch["text"], strict=True):
            counts, n = feature_counts(text)
            ids = np.fromiter(counts.keys(), np.int32, len(counts))
            values = np.fromiter(counts.values(), np.float32, len(counts)) / np.float32(n + SMOOTHING)
            rows.append((doc_id, positive, ids.tobytes(), values.tobytes()))
        yield pd.DataFrame(rows, columns=["doc_id", "positive", "ids", "values"])


def _feature_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents, values and squares summed by feature and class, in units that add up alike in any order."""
    for batch in batches:
        for positive, rows in batch.groupby("positive"):
            flat = np.concatenate([np.frombuffer(b, np.int32) for b in rows["ids"]])
            val = np.concatenate([np.frombuffer(b, np.float32) for b in rows["values"]]).astype(np.float64)
            names, place = np.unique(flat, return_inverse=True)
            total, square = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
            np.add.at(total, place, np.rint(val * _UNIT).astype(np.int64))
            np.add.at(square, place, np.rint(val**2 * _UNIT).astype(np.int64))
            yield pd.DataFrame({"feature": names, "positive": positive, "docs": np.bincount(place, minlength=len(names)), "total": total, "square": square})


def _screened(sample: DataFrame, n_pos: int, n_unl: int) -> np.ndarray:
    """The features that part positives from the rest best; at most ``MAX_FEATURES`` reach the driver."""
    parts = sample.mapInPandas(_feature_sums, "feature int, positive boolean, docs long, total long, square long")
    of = lambda c, mark: F.coalesce(F.sum(F.when(F.col("positive") == mark, F.col(c))), F.lit(0))
    sums = parts.groupBy("feature").agg(*(of(c, m).alias(f"{c}_{m}") for c in ("docs", "total", "square") for m in (True, False)))
    mean = {m: F.col(f"total_{m}") / (_UNIT * n) for m, n in ((True, n_pos), (False, n_unl))}
    noise = [(F.col(f"square_{m}") / (_UNIT * n) - mean[m] * mean[m]) / n for m, n in ((True, n_pos), (False, n_unl))]
    z = (mean[True] - mean[False]) / F.sqrt(noise[0] + noise[1] + 1e-12)
    common = F.col("docs_True") >= max(2, MIN_SHARE * n_pos)
    best = sums.where(common).select("feature", z.alias("z")).where(F.col("z") > MIN_Z).orderBy(F.desc("z"), "feature")
    return np.array([r["feature"] for r in best.limit(MAX_FEATURES).collect()], np.int64)


def _columns(sample: DataFrame, keep: np.ndarray) -> pd.DataFrame:
    """(doc_id, positive, row): the kept features of each document of the sample."""

    def dense(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        column = np.full(1 << HASH_BITS, -1)
        column[keep] = np.arange(len(keep))
        for batch in batches:
            rows = []
            for ids, values in zip(batch["ids"], batch["values"], strict=True):
                row, at = np.zeros(len(keep), np.float32), column[np.frombuffer(ids, np.int32)]
                row[at[at >= 0]] = np.frombuffer(values, np.float32)[at >= 0]
                rows.append(row.tobytes())
            yield pd.DataFrame({"doc_id": batch["doc_id"], "positive": batch["positive"], "row": rows})

    return sample.mapInPandas(dense, "doc_id long, positive boolean, row binary").toPandas()


def risk(w: np.ndarray, pos: np.ndarray, unl: np.ndarray, prior: float) -> tuple[float, float]:
    """Both parts of the estimated risk: that of positives, and that of negatives, which may fall below zero."""
    gp, gu = pos @ w[:-1] + w[-1], unl @ w[:-1] + w[-1]
    return prior * np.logaddexp(0, -gp).mean(), np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()


def risk_gradient(w: np.ndarray, pos: np.ndarray, unl: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of the whole risk, or, where the risk of negatives is below zero, of its opposite."""
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -60, 60)))
    gp, gu = pos @ w[:-1] + w[-1], unl @ w[:-1] + w[-1]
    d_pos, d_unl = -prior * sigmoid(gp) / len(gp), sigmoid(gu) / len(gu)
    if risk(w, pos, unl, prior)[1] >= 0:
        d_pos = d_pos + prior * (sigmoid(gp) - 1) / len(gp)
    else:
        d_pos, d_unl = -d_pos, -d_unl
    return np.append(d_pos @ pos + d_unl @ unl, d_pos.sum() + d_unl.sum())


def _nnpu(pos: np.ndarray, unl: np.ndarray, prior: float, steps: int = 300, rate: float = 0.03, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the non-negative risk, by Adam on whole sets."""
    w, m, v = (np.zeros(pos.shape[1] + 1) for _ in range(3))
    w[-1] = np.log(prior / (1 - prior))
    for t in range(1, steps + 1):
        grad = risk_gradient(w, pos, unl, prior)
        grad[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def fit(keep: np.ndarray, dense: np.ndarray, positive: np.ndarray, prior: float) -> Model:
    """The average of ``ENSEMBLE`` classifiers over the screened features."""
    scale = np.sqrt((dense.astype(np.float64) ** 2).mean(axis=0)) + 1e-6
    dense = (dense / scale).astype(np.float32)
    pos, unl = dense[positive], dense[~positive]
    parts = [unl[i::ENSEMBLE] for i in range(ENSEMBLE)] if len(unl) >= 10 * ENSEMBLE else [unl]
    fits = [_nnpu(pos, part, prior) for part in parts]
    w = np.mean([f[0] for f in fits], axis=0) / scale
    return Model(dict(zip(keep.tolist(), w.tolist(), strict=True)), float(np.mean([f[1] for f in fits])))


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``, held-out fold left out."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0]
    learned = docs.where(~held_out(F.col("doc_id"))).where("text is not null")
    by_hash = F.xxhash64("doc_id", F.lit("toxicity"))
    ids = learned.select("doc_id").distinct()
    positive = (
        ids.join(known.where("toxic = 1"), "doc_id", "left_semi").orderBy(by_hash).limit(MAX_POSITIVE)
    ).withColumn("positive", F.lit(True))
    unlabelled = ids.orderBy(by_hash).limit(MAX_UNLABELLED).withColumn("positive", F.lit(False))
    chosen = positive.unionByName(unlabelled)  # at most MAX_POSITIVE + MAX_UNLABELLED ids
    # Of rows that share an id, the one whose text has the least MD5.
    sample = learned.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "positive")
    sample = sample.agg(F.min_by("text", F.md5(F.col("text").cast("binary"))).alias("text"))
    kind = "doc_id long, positive boolean, ids binary, values binary"
    sample = materialize(sample.mapInPandas(_sampled_features, kind))
    n = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    if not prior or not n.get(True):
        return Model({}, None)
    keep = _screened(sample, n[True], max(1, n.get(False, 0)))
    got = _columns(sample, keep).sort_values(["positive", "doc_id"], kind="stable")
    dense = np.frombuffer(b"".join(got["row"]), np.float32).reshape(len(got), len(keep))
    return fit(keep, dense, got["positive"].to_numpy(bool), min(0.95, prior))


class _WordScores(dict):
    """Score of a word, computed once in a worker; emptied before it grows without bound."""

    LIMIT = 400_000

    def __init__(self, weights: dict[int, float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value = sum(self.weights.get(f, 0.0) for f in set(_features(word)))
        return value


def score_column(text: str, model: Model) -> Column:
    """Probability of toxicity of the whole text in the named column."""
    weights, intercept = model.weights, model.intercept

    @pandas_udf(DoubleType())
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = _WordScores(weights)
        value = words.__getitem__
        for texts in batches:
            out = []
            for t in texts:
                if intercept is None:
                    out.append(0.0)
                    continue
                found = _WORD.findall((t or "").lower())
                z = intercept + sum(map(value, found)) / (len(found) + SMOOTHING)
                out.append(float(1 / (1 + np.exp(-np.clip(z, -60, 60)))))
            yield pd.Series(out, dtype="float64")

    return scored(F.col(text))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    model = train(docs, labels)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column("text", model).alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold."""
    model = train(docs, labels)
    return docs.where(score_column("text", model) < THRESHOLD)
