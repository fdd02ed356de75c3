"""Quality classifier: Bradley-Terry ranking from preference pairs.

A document's score is linear in features of its text alone. Training pairs a
text labelled 1 with one labelled 0 and prefers the first: the logistic loss on
the difference of their features (Bradley-Terry) gives the weights. The cut is a
quantile of the scores of all training rows: the share of label-0 rows among the
labelled ones. Scores are mapped to (0, 1) so that the cut lies at ``CUT``.

Features are built-in expressions, computed once for all documents and written.
The fit uses at most ``MAX_FIT_ROWS`` labelled rows of each label (those with the
smallest hash; a documented bound) on the driver; scoring is one linear
expression over all rows, and the cut is found exactly by counting the scores of all
training rows in bins; the driver sees the bins alone. Rows whose crc32(id) mod 5 is 0 never train.

Defined cases: null and empty texts have zero features and get a score like any
other; rows with a null id are scored and never train; labels other than 0 and
1 are ignored, repeated labels count as often as they occur; without labels of
both kinds every score is 0.5; an empty table gives an empty result; language,
source, id and labels are no inputs of a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .quality_rules import with_metrics

CUT = 0.3
MAX_FIT_ROWS = 5000
PAIRS_PER_ROW = 20
RIDGE = 1e-3
SEED = 11
BINS = 1024


def feature_columns(text: Column, m: Column) -> dict[str, Column]:
    n = F.greatest(m["n_words"], F.lit(1)).cast("double")
    bangs = (F.length(text) - F.length(F.translate(text, "!", ""))).cast("double")
    return {
        "log_words": F.log1p(m["n_words"].cast("double")),
        "symbols": F.least(m["n_symbols"] / n, F.lit(3.0)),
        "bangs": F.least(bangs / n, F.lit(3.0)),
        "dup_lines": m["dup_lines"] / 1000.0,
        "repeats": m["repeats"] / 1000.0,
        "stutter": m["stutter"] / 1000.0,
        "capitals": m["capitals"] / 1000.0,
        "word_length": F.least(m["word_chars"] / n, F.lit(20.0)),
    }


FEATURES = ("log_words", "symbols", "bangs", "dup_lines", "repeats", "stutter", "capitals", "word_length")


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out and the features of every document; written once."""
    src = docs.select(F.col(id_col).alias("id"), held_out(id_col).alias("held_out"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    m = with_metrics(src, "text", "m")
    return written(m.select("id", "held_out", *[c.cast("double").alias(k) for k, c in feature_columns(F.col("text"), F.col("m")).items()]), "text-features")


@dataclass(frozen=True)
class Ranker:
    """Linear scores: ``weights`` on the raw features, cut at ``cut``."""
    weights: tuple[float, ...]
    cut: float

    def raw(self) -> Column:
        total = F.lit(0.0)
        for k, w in zip(FEATURES, self.weights):
            total = total + F.col(k) * w
        return total

    def score(self) -> Column:
        if not any(self.weights):
            return F.lit(0.5)
        shifted = self.raw() - self.cut + math.log(CUT / (1 - CUT))
        return 1 / (1 + F.exp(-F.greatest(F.least(shifted, F.lit(700.0)), F.lit(-700.0))))


def pairs_of(good: np.ndarray, bad: np.ndarray, seed: int = SEED) -> np.ndarray:
    """Feature differences (preferred minus other), every row in some pairs."""
    rng = np.random.default_rng(seed)
    i = np.concatenate([np.repeat(np.arange(len(good)), PAIRS_PER_ROW), rng.integers(0, len(good), PAIRS_PER_ROW * len(bad))])
    j = np.concatenate([rng.integers(0, len(bad), PAIRS_PER_ROW * len(good)), np.repeat(np.arange(len(bad)), PAIRS_PER_ROW)])
    return good[i] - bad[j]


def bradley_terry(difference: np.ndarray, ridge: float = RIDGE, steps: int = 50) -> np.ndarray:
    """Weights that minimise the mean logistic loss of the pairs (Newton's method)."""
    w = np.zeros(difference.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(difference @ w, -500, 500)))  # chance of the wrong order
        gradient = -difference.T @ p / len(difference) + ridge * w
        curve = (difference * (p * (1 - p))[:, None]).T @ difference / len(difference) + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def quantile_cut(scores: np.ndarray, weight: np.ndarray, share: float) -> float:
    """A value with a weighted share of ``share`` of the scores below it, in the
    middle of the gap between two scores."""
    order = np.argsort(scores, kind="stable")
    s, below = scores[order], np.cumsum(weight[order]) / weight.sum()
    k = int(np.searchsorted(below, share - 1e-12))
    return float((s[k] + s[min(k + 1, len(s) - 1)]) / 2)


def score_cut(scored: DataFrame, below: int) -> float:
    """``quantile_cut`` of all rows' ``score`` with ``below`` of them below it. The bin
    that holds the ``below``-th score is split again until its scores are equal."""
    score = F.col("score")
    lo, hi = scored.agg(F.min("score"), F.max("score")).first()
    rank = below - 1
    while lo < hi:
        place = F.floor((score - lo) / (hi - lo) * BINS)
        bins = scored.where(score.between(lo, hi)).groupBy(place.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi")).orderBy("bin")
        for r in bins.collect():  # BINS + 1 at most
            lo, hi = r["lo"], r["hi"]
            if rank < r["n"]:
                break
            rank -= r["n"]
    upto, beyond = scored.agg(F.count_if(score <= lo), F.min(F.when(score > lo, score))).first()
    return float(lo if upto > below or beyond is None else (lo + beyond) / 2)


def fit(featured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", max_rows: int = MAX_FIT_ROWS) -> Ranker:
    known = labels.select(F.col(id_col).alias("l_id"), F.col(label_col).cast("int").alias("label")).where("label IN (0, 1)")
    train = written(featured.where("NOT held_out").join(known, featured["id"] == known["l_id"]).select("label", "id", *FEATURES), "training-rows")
    count = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if len(count) < 2:
        return Ranker((0.0,) * len(FEATURES), 0.0)
    side = {}
    for label in (0, 1):
        place = F.xxhash64(F.lit(SEED), "id")
        # The first rows by hash lie below this hash: what is sorted stays small.
        below = min((1 << 63) - 1, int(2 * max_rows / count[label] * (1 << 64)) - (1 << 63))
        own = train.where(F.col("label") == label)
        for rows in (own.where(place <= below), own):
            side[label] = rows.orderBy(place, *FEATURES).limit(max_rows).select(*FEATURES).toPandas().to_numpy(np.float64)
            if len(side[label]) == min(max_rows, count[label]):
                break  # else many rows share few ids, and with them few hashes
    rows = np.concatenate([side[0], side[1]])
    scale = np.maximum(rows.std(axis=0), 1e-9)
    w = bradley_terry(pairs_of(side[1] / scale, side[0] / scale)) / scale
    weights = tuple(float(x) for x in w)
    scored = written(train.select(Ranker(weights, 0.0).raw().alias("score")), "training-scores")
    return Ranker(weights, score_cut(scored, count[0]))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """id, held_out, score and predicted (1 from ``CUT`` on) of every document."""
    featured = features(docs, id_col, text_col)
    ranker = fit(featured, labels, id_col, label_col)
    return featured.select(F.col("id").alias(id_col), "held_out", ranker.score().alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))
