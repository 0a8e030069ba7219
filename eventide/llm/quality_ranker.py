"""Document quality by Bradley-Terry pairwise ranking.

Every text becomes a short vector of surface features, computed by Spark's own
functions.  From labelled rows, pairs (better, worse) are drawn; the weights
minimise the logistic loss of the feature difference, as Bradley and Terry's
model of paired comparisons has it.  A cut at a quantile of the training scores
turns scores into decisions.

Null and empty texts have all-zero counts and are scored like any other text.
Rows are scored one by one, so repeated rows, ties and extra columns pass
through; an empty table gives no rows.  Without both labels in the training
rows nothing can be compared: every score is then 1 (nothing is rejected).
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FUNCTION_WORDS, let, lines_with_words, sample_label_ids, whole, words

#: Training bounds: labelled ids, and preference pairs drawn from them.
MAX_LABELS = 20_000
MAX_PAIRS = 200_000

#: Predicted 1 from this score on.
DECISION = 0.3

_BULK = "[a-zà-öø-ÿ ,.\\n]+"
_FUNCTION = sorted({w for ws in FUNCTION_WORDS.values() for w in ws})


def _share(part: Column, total: Column) -> Column:
    return F.when(total > 0, part.cast("double") / total).otherwise(F.lit(0.0))


def features(text: Column) -> Column:
    """Feature vector of a text."""
    t = whole(text)
    per_word = let(words(text), lambda w: F.struct(
        F.size(w).alias("n"),
        F.size(F.array_distinct(w)).alias("distinct"),
        F.size(F.filter(F.zip_with(w, F.slice(w, 2, F.greatest(F.size(w), F.lit(1))),
                                   lambda a, b: a == b), lambda x: x)).alias("again"),
        F.size(F.filter(w, lambda x: x.isin(_FUNCTION))).alias("function")))
    per_line = let(lines_with_words(text), lambda x: F.struct(
        F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))

    def left(rest: Column, pattern: str) -> Column:
        return F.length(F.regexp_replace(rest, pattern, ""))

    # One pass drops the bulk (small letters, spaces, stops); the rest is short.
    marks = let(F.regexp_replace(t, _BULK, ""), lambda r: F.struct(
        left(r, "[^\\p{Lu}]+").alias("upper"), left(r, "[^#*$%&|<>]+").alias("symbols"),
        left(r, "[^!]+").alias("shouts"), left(r, "[^|]+").alias("bars"),
        left(r, "[^0-9]+").alias("digits")))
    parts = F.struct(F.length(t).alias("n"), per_word.alias("w"), per_line.alias("l"),
                     marks.alias("m"))

    def vector(p: Column) -> Column:
        n, w, line, m = p["n"], p["w"], p["l"], p["m"]
        nw = w["n"]
        upper_share, symbol_share = _share(m["upper"], n), _share(m["symbols"], n)
        again, function = _share(w["again"], nw), _share(w["function"], nw)
        rare, log_words = _share(w["distinct"], nw), F.log1p(nw.cast("double"))
        return F.array(
            log_words, _share(n, nw), upper_share, F.sqrt(upper_share), symbol_share,
            F.sqrt(symbol_share), F.sqrt(_share(m["shouts"], n)), F.sqrt(_share(m["bars"], n)),
            F.sqrt(_share(m["digits"], n)), again, F.sqrt(again), rare, rare * log_words,
            function, F.sqrt(1 - _share(line["distinct"], line["n"])),
            F.log1p(_share(nw, line["n"])), (nw < 50).cast("double"), (nw < 10).cast("double"),
            (symbol_share > 0.02).cast("double"), (upper_share > 0.3).cast("double"),
            (again > 0.1).cast("double"), (function < 0.1).cast("double"))

    return let(parts, vector)


@dataclass
class Ranker:
    """Weights of the ranking, the mean and scale of each feature, and the cut."""

    weights: list[float] = field(default_factory=list)
    mean: list[float] = field(default_factory=list)
    scale: list[float] = field(default_factory=list)
    cut: float = 0.0

    def raw(self, vector: Column) -> Column:
        """Bradley-Terry strength of a feature vector, as a Spark expression."""
        total = F.lit(0.0)
        for i, (w, m, s) in enumerate(zip(self.weights, self.mean, self.scale)):
            total = total + (vector[i] - m) * (w / s)
        return total

    def score(self, vector: Column) -> Column:
        """Strength mapped to 0 ... 1 so that the quantile cut lies at ``DECISION``."""
        if not self.weights:
            return F.lit(1.0)
        shift = math.log(DECISION / (1 - DECISION)) - self.cut
        return 1 / (1 + F.exp(-(self.raw(vector) + shift)))


def fit_pairs(x: np.ndarray, y: np.ndarray, *, max_pairs: int = MAX_PAIRS, l2: float = 1e-4,
              quantile: float | None = None, seed: int = 7, rounds: int = 30) -> Ranker:
    """Newton's method on pairs (label 1 preferred to label 0).  ``quantile`` is
    the share of training rows to reject (default: the share labelled 0)."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranker()
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = (x - mean) / scale
    rng = np.random.default_rng(seed)
    n = min(max_pairs, len(good) * len(bad))
    diff = z[rng.choice(good, n)] - z[rng.choice(bad, n)]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(diff @ w, -30, 30)))  # probability of the wrong order
        grad = -(diff * p[:, None]).mean(0) + l2 * w
        hess = (diff * (p * (1 - p))[:, None]).T @ diff / n + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    share = float((y == 0).mean()) if quantile is None else quantile
    order = np.sort(s)
    k = min(max(round(share * len(s)), 1), len(s) - 1)
    return Ranker(w.tolist(), mean.tolist(), scale.tolist(), float((order[k - 1] + order[k]) / 2))


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality",
        max_labels: int = MAX_LABELS, **options) -> Ranker:
    """Fit on at most ``max_labels`` labelled rows outside the held-out fifth.  The
    sampled ids are bounded, so they are broadcast; their vectors are collected."""
    ids = sample_label_ids(labels, label, max_labels)
    rows = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .select("label", features(F.col("text")).alias("features"), F.xxhash64("doc_id", "text").alias("o"))
            .orderBy("o").limit(max_labels).collect())
    if not rows:
        return Ranker()
    x = np.array([r["features"] for r in rows], dtype=float)
    return fit_pairs(x, np.array([r["label"] for r in rows]), **options)


def rank(docs: DataFrame, model: Ranker, *, score: str = "score") -> DataFrame:
    """``docs`` with the quality score (one map over the rows, no shuffle)."""
    return docs.withColumn(score, let(features(F.col("text")), model.score))
