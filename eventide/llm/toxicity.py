"""Counterfactually regularised toxicity classifier.

A text is the set of its lower-case words; each word has hashed features (itself
and its first 4, 5 and 6 letters, so that inflections share weight).  A logistic
model is fitted to labelled texts with a penalty on score changes under
counterfactuals: in every labelled text, each identity term it names is swapped
for the other terms of its group, and the squared change of the log-odds is
penalised.  Mentioning a group thus neither raises nor lowers a score by itself.

Texts are scored whole, in one map pass.  Null and empty texts have no words and
get the model's base rate.  Rows are scored one by one, so repeated rows and ties
get equal scores and extra columns pass through; an empty table gives no rows.
Without both labels among the training rows there is nothing to learn: the score
is then the label's share (0 without labels).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, sample_label_ids, ships_by_value, whole
from .records import _slices

#: Labelled ids used to fit, features kept, and bits of a feature's hash.
MAX_LABELS = 16_000
MAX_FEATURES = 4_096
BITS = 20
PREFIXES = (4, 5, 6)
PENALTY = 10.0
#: Weight of a row labelled 1 in the loss (label 1 is the rare one).
RARE_WEIGHT = 2.0
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#%&$-_=+/\\`~^@…–—“”‘’«»¿¡"

#: Terms that may stand for each other in a counterfactual (fixed values).
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("american", "mexican", "chinese", "indian", "german", "french", "spanish", "polish", "turkish"),
    ("immigrant", "refugee", "citizen", "foreigner"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("old", "young"), ("disabled", "blind", "deaf"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
)


def _hash(words: pa.Array) -> np.ndarray:
    values = words.to_numpy(zero_copy_only=False).astype(object)
    if not len(values):
        return np.zeros(0, np.int64)
    return (pd.util.hash_array(values, categorize=False) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def word_features(words: pa.Array) -> np.ndarray:
    """Feature places of each (lower-case) word, -1 where a word is too short."""
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    columns = [_hash(words)]
    for n in PREFIXES:
        start = pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, n), "*", "")
        columns.append(np.where(size >= n, _hash(start), -1))
    return np.stack(columns, axis=1)


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lower-case words, and for every word of the texts its text and place."""
    split = pc.ascii_split_whitespace(texts)
    coded = split.flatten().dictionary_encode()
    lower = pc.utf8_lower(pc.utf8_trim(coded.dictionary, characters=PUNCTUATION)).dictionary_encode()
    use = lower.indices.to_numpy(zero_copy_only=False)[coded.indices.to_numpy(zero_copy_only=False)]
    text = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    return lower.dictionary, text, use.astype(np.int64)


def _features_of(words) -> np.ndarray:
    f = word_features(pa.array(sorted(words), pa.string())) if words else np.zeros((0, 1), np.int64)
    return np.unique(f[f >= 0])


def swaps(words: set[str], groups=IDENTITY_GROUPS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per counterfactual: the features that the swap removes, and those it adds."""
    out, own = [], None
    for group in groups:
        for term in group:
            if term in words:
                own = _features_of(words) if own is None else own
                for other in group:
                    if other != term:
                        new = _features_of((words - {term}) | {other})
                        out.append((np.setdiff1d(own, new), np.setdiff1d(new, own)))
    return out


@dataclass
class Model:
    """Weight per feature place, and the intercept; ``base`` without weights."""

    weights: np.ndarray
    intercept: float

    def word_weights(self, words: pa.Array) -> np.ndarray:
        f = word_features(words)
        return np.where(f >= 0, self.weights[np.maximum(f, 0)], 0.0).sum(axis=1)

    def log_odds(self, texts: pa.Array) -> np.ndarray:
        """A text's features are those of its distinct words, each counted once."""
        names, text, use = _words(texts)
        places = word_features(names)
        useful = (self.weights[np.maximum(places, 0)] * (places >= 0) != 0).any(axis=1)
        mine = useful[use] if len(use) else np.zeros(0, bool)
        pair = np.unique(text[mine] * max(len(names), 1) + use[mine])
        owner, f = pair // max(len(names), 1), places[pair % max(len(names), 1)] if len(pair) else places[:0]
        both = np.unique((owner[:, None] * (1 << BITS) + f)[f >= 0])
        return self.intercept + np.bincount(both >> BITS, self.weights[both & ((1 << BITS) - 1)],
                                            minlength=len(texts))


def _examples(docs: DataFrame, ids: DataFrame, groups) -> DataFrame:
    """``label``, feature places, and the counterfactuals of each labelled text."""
    def extract(batches):
        for batch in batches:
            names, text, use = _words(batch.column("text"))
            listed, places = names.to_pylist(), word_features(names)
            bounds = np.searchsorted(text, np.arange(batch.num_rows + 1))
            rows = []
            for i, label in enumerate(batch.column("label").to_pylist()):
                own = np.unique(use[bounds[i]:bounds[i + 1]])
                f = places[own]
                changed = swaps({listed[k] for k in own}, groups)
                rows.append((label, np.unique(f[f >= 0]).astype("<i4").tobytes(),
                             [a.astype("<i4").tobytes() for a, _ in changed],
                             [b.astype("<i4").tobytes() for _, b in changed]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.binary(), pa.list_(pa.binary()),
                                                             pa.list_(pa.binary())))],
                names=["label", "features", "gone", "added"])

    rows = (docs.select("doc_id", whole(F.col("text")).alias("text")).join(F.broadcast(ids), "doc_id")
            .select("label", "text", F.xxhash64("doc_id", "text").alias("o")))
    return rows.select("o", "label", "text").mapInArrow(
        _with_order(extract), "o bigint, label int, features binary, gone array<binary>, added array<binary>")


def _with_order(extract):
    def run(batches):
        for batch in batches:
            for piece in _slices(batch, "text"):
                for out in extract([piece]):
                    yield pa.RecordBatch.from_arrays([piece.column("o"), *out.columns],
                                                     names=["o", *out.schema.names])
    return run


def _sparse(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and places of the entries."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    return owner, np.concatenate(rows).astype(np.int64) if rows else np.zeros(0, np.int64)


def fit_features(x: list[np.ndarray], y: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]], *,
                 penalty: float = PENALTY, l2: float = 2e-4, max_features: int = MAX_FEATURES,
                 steps: int = 400, rate: float = 0.3) -> Model:
    """Minimise weighted mean log loss + ``penalty`` x mean squared counterfactual change + l2
    by adaptive full-batch gradient steps.  The features kept are those whose
    frequency differs most between the labels, and all that a counterfactual changes."""
    none = np.zeros(1 << BITS)
    if len(y) == 0:
        return Model(none, -math.inf)
    share = float(y.mean())
    if share in (0.0, 1.0):
        return Model(none, math.inf if share else -math.inf)
    owner, place = _sparse(x)
    size = 1 << BITS
    n1 = np.bincount(place, y[owner], minlength=size)
    n = np.bincount(place, minlength=size)
    spread = np.sqrt(n * share * (1 - share) * np.maximum(1 - n / len(y), 1e-9)) + 1e-9
    z = np.where(n >= 4, np.abs(n1 - n * share) / spread, 0.0)
    best = np.argsort(-z, kind="stable")[:max_features]
    kept = np.zeros(size, bool)
    kept[best[z[best] >= 5]] = True
    for a, b in pairs:
        kept[a] = kept[b] = True
    number = np.cumsum(kept) - 1
    used = kept[place]
    owner, col = owner[used], number[place[used]]
    d = int(kept.sum())
    cf_owner = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    cf_col = number[np.concatenate([np.concatenate(p) for p in pairs])] if pairs else np.zeros(0, np.int64)
    cf_sign = (np.concatenate([np.concatenate((np.ones(len(a)), -np.ones(len(b)))) for a, b in pairs])
               if pairs else np.zeros(0))
    w, b = np.zeros(d), math.log(share / (1 - share))
    seen_w, seen_b = np.full(d, 1e-8), 1e-8
    for step in range(steps):
        odds = b + np.bincount(owner, w[col], minlength=len(y))
        wrong = (1 / (1 + np.exp(-np.clip(odds, -30, 30))) - y) * np.where(y > 0, RARE_WEIGHT, 1.0) / len(y)
        grad = np.bincount(col, wrong[owner], minlength=d) + l2 * w
        if pairs:
            change = np.bincount(cf_owner, cf_sign * w[cf_col], minlength=len(pairs))
            grad += 2 * penalty / len(pairs) * np.bincount(cf_col, cf_sign * change[cf_owner], minlength=d)
        gb = wrong.sum()
        # decaying averages, so that late steps are not stuck with early gradients
        seen_w = 0.95 * seen_w + 0.05 * grad * grad
        seen_b = 0.95 * seen_b + 0.05 * gb * gb
        pace = rate / (1 + step / 20)
        w -= pace * grad / (np.sqrt(seen_w) + 1e-6)
        b -= pace * gb / (math.sqrt(seen_b) + 1e-6)
    weights = none
    weights[np.flatnonzero(kept)] = w
    return Model(weights, float(b))


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", max_labels: int = MAX_LABELS,
        groups=IDENTITY_GROUPS, **options) -> Model:
    """Fit on at most ``max_labels`` labelled rows outside the held-out fifth."""
    ids = sample_label_ids(labels, label, max_labels)
    rows = _examples(docs, ids, groups).orderBy("o").limit(max_labels).toPandas()
    x = [np.frombuffer(f, "<i4") for f in rows["features"]]
    pairs = [(np.frombuffer(a, "<i4"), np.frombuffer(b, "<i4"))
             for gone, added in zip(rows["gone"], rows["added"]) for a, b in zip(gone, added)]
    return fit_features(x, (rows["label"].to_numpy() > 0).astype(float), pairs, **options)


def score(docs: DataFrame, model: Model, *, column: str = "score") -> DataFrame:
    """``docs`` with the toxicity score, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (np.flatnonzero(model.weights), model.weights[model.weights != 0], model.intercept))
    plain, back = aside(docs, "doc_id", "text", made=(column,))
    names = plain.columns

    def run(batches):
        places, values, intercept = shared.value
        weights = np.zeros(1 << BITS)
        weights[places] = values
        local = Model(weights, intercept)
        for batch in batches:
            for piece in _slices(batch, "_text"):
                with np.errstate(over="ignore"):
                    chance = 1 / (1 + np.exp(-local.log_odds(piece.column("_text"))))
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), pa.array(chance)],
                                                 names=[*names, column])

    schema = T.StructType([*plain.schema.fields, T.StructField(column, T.DoubleType())])
    return back(plain.withColumn("_text", whole(F.col("text"))).mapInArrow(run, schema))


ships_by_value(__name__)
