"""Toxicity: logistic regression with a counterfactual penalty.

Identity terms in labelled sentences are swapped for others of their group, and the fit penalises
the squared change of the score, so that the mere mention of a group says nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import common

#: Groups of terms that may stand for each other.
IDENTITY_GROUPS = (
    ("man", "woman", "men", "women", "male", "female"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrant", "refugee", "native", "foreigner"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("disabled", "blind", "deaf", "autistic"),
    ("old", "young", "elderly"),
)
IDENTITY = frozenset(t.encode() for g in IDENTITY_GROUPS for t in g)
#: Identity terms have features of their own, all other terms share 2 ** HASH_BITS by their hashes.
IDENTITY_AT = {t: i for i, t in enumerate(sorted(IDENTITY))}
HASH_BITS = 20
FEATURES = len(IDENTITY_AT) + (1 << HASH_BITS)

#: A-Z become a-z; ASCII marks become blanks, so that words lose them.
_PLAIN = bytes(
    b + 32 if 65 <= b <= 90 else 32 if b < 128 and not chr(b).isalnum() else b for b in range(256)
)


def terms(text: bytes) -> set[bytes]:
    return set(text.translate(_PLAIN).split())


def places(found: set[bytes]) -> np.ndarray:
    """The features of a set of terms, each once, in order."""
    first, mask, digest = len(IDENTITY_AT), (1 << HASH_BITS) - 1, xxhash.xxh64_intdigest
    return np.unique(np.fromiter(
        (IDENTITY_AT[t] if t in IDENTITY_AT else first + (digest(t) & mask) for t in found),
        np.int32, len(found),
    ))


def sentences(text: bytes) -> list[bytes]:
    for mark in b"!?\n":
        text = text.replace(bytes([mark]), b".")
    return text.split(b".")


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES, np.float32))
    bias: float = 0.0

    def score(self, text: bytes) -> float:
        z = self.bias + float(self.weights[places(terms(text))].sum(dtype=np.float64))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per labelled text: the features of its terms, and of identity terms by sentence."""
    for batch in batches:
        features, mentions = [], []
        for text in common.text_bytes(batch):
            own = terms(text)
            features.append(places(own))
            mentions.append(
                [IDENTITY_AT[t] for s in sentences(text) for t in terms(s) & IDENTITY]
                if own & IDENTITY else []
            )
        yield pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(features, pa.list_(pa.int32())),
             pa.array(mentions, pa.list_(pa.int32()))],
            names=["label", "places", "mentions"],
        )


def squared_deviations(features: np.ndarray, rows: np.ndarray, labels: np.ndarray, k: int) -> np.ndarray:
    """z ** 2 of the difference between a feature's document frequencies in the two classes."""
    n, n1 = len(labels), labels.sum()
    c1 = np.bincount(features, weights=labels[rows], minlength=k)
    c = np.bincount(features, minlength=k)
    share = c / n
    spread = share * (1 - share) * (1 / n1 + 1 / (n - n1))
    return (c1 / n1 - (c - c1) / (n - n1)) ** 2 / np.maximum(spread, 1e-300)


def counterfactual_penalty(vocabulary: dict[bytes, int], mentions: np.ndarray) -> np.ndarray:
    """The matrix S with w'Sw = mean squared score change over all swaps of the mentions."""
    k = len(vocabulary)
    s = np.zeros((k, k))
    swaps = 0
    for group in IDENTITY_GROUPS:
        at = [vocabulary[t.encode()] for t in group]
        for i in at:
            for j in at:
                if i != j and mentions[i]:
                    s[i, i] += mentions[i]
                    s[j, j] += mentions[i]
                    s[i, j] -= mentions[i]
                    s[j, i] -= mentions[i]
                    swaps += mentions[i]
    return s / max(swaps, 1)


def solve(rows: list, labels: np.ndarray, penalty: np.ndarray, ridge, weight: float):
    """Newton's method on the mean logistic loss + ridge w^2 / 2 + weight w'Sw; bias free.

    `rows` has the features of each row, `ridge` a number or one for each feature, and `penalty` is
    S for the first features. Steps are found by conjugate gradients, so no matrix of all is made.
    """
    n, m = len(rows), len(penalty)
    k = max(m, np.size(ridge))
    lengths = [len(r) for r in rows]
    at = np.concatenate([np.asarray(r, np.int32) for r in rows])
    row = np.repeat(np.arange(n, dtype=np.int32), lengths)
    ridge = np.append(np.broadcast_to(ridge, k), 0.0)

    def by_row(v):
        return np.bincount(row, weights=v[at], minlength=n) + v[k]

    def by_feature(u):
        return np.append(np.bincount(at, weights=u[row], minlength=k), u.sum()) / n

    def fixed(v):
        out = ridge * v
        out[:m] += 2 * weight * (penalty @ v[:m])
        return out

    w = np.zeros(k + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(by_row(w), -700, 700)))
        curve = p * (1 - p) + 1e-9
        scale = by_feature(curve) + ridge + 1e-9
        scale[:m] += 2 * weight * np.diag(penalty)
        step, left = np.zeros(k + 1), by_feature(p - labels) + fixed(w)
        way = left / scale
        size = first = left @ way
        for _ in range(200):
            if size <= 1e-6 * first:
                break
            bent = by_feature(curve * by_row(way)) + fixed(way) + 1e-9 * way
            far = size / (way @ bent)
            step += far * way
            left = left - far * bent
            now = left @ (left / scale)
            way = left / scale + now / size * way
            size = now
        # A bounded step keeps separable classes from overshooting.
        w -= step * min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-5:
            break
    return w[:k], float(w[k])


def fit(
    docs: DataFrame, labels: DataFrame, label_column: str = "toxic", folds: int = 3,
    held_out: int = 1, max_rows: int = 20_000, ridge: float = 1e-4, counterfactual: float = 1.0,
) -> Model:
    """Fit on at most `max_rows` labelled rows, those with the smallest hashes of doc_id.

    That sample bounds the rows fitted on the driver. All their terms count: `ridge`, the penalty of
    a weight, is divided by z ** 4 / 100, z being the deviations by which the term's shares of the
    classes differ, so that the weights of terms that tell little stay small. Equal texts with equal
    labels count once, so that many copies of a text don't make its words telling. Labels of the
    held-out fold are not read; values other than 0 and 1 are ignored. Without rows of both classes
    the score is constant.
    """
    common.prepare(docs.sparkSession)
    known = labels.select(
        F.col("doc_id").alias("id"), F.col(label_column).cast("int").alias("label")
    ).where("label in (0, 1) and id is not null").where(common.fold("id", folds) != held_out)
    chosen = known.distinct().orderBy(F.xxhash64("id"), "id", "label").limit(max_rows)
    # max_rows bounds the broadcast side.
    sample = stage(
        common.id_and_text(docs, "doc_id", "text").join(F.broadcast(chosen), "id")
        .select("label", "text").distinct(), "labelled",
    )
    got = sample.mapInArrow(
        _rows_of, "label int, places array<int>, mentions array<int>"
    ).toArrow().combine_chunks()
    if not got.num_rows:
        return Model()
    y = got["label"].to_numpy().astype(float)
    if y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1)
        return Model(bias=math.log(share / (1 - share)))
    m = len(IDENTITY_AT)
    lists = got["places"]
    lengths = pa.compute.list_value_length(lists).to_numpy()
    given = pa.compute.list_flatten(lists).to_numpy()
    mentions = np.bincount(pa.compute.list_flatten(got["mentions"]).to_numpy(), minlength=m).astype(float)
    known = np.union1d(np.arange(m), given)
    at = np.searchsorted(known, given).astype(np.int32)
    rows = np.repeat(np.arange(len(y)), lengths)
    told = squared_deviations(at, rows, y, len(known)) ** 2 / 100
    penalties = ridge / (told + 1e-3)
    # What identity terms may say is for the counterfactual penalty to decide.
    penalties[:m] = ridge
    w, bias = solve(
        np.split(at, np.cumsum(lengths)[:-1]), y, counterfactual_penalty(IDENTITY_AT, mentions),
        penalties, counterfactual,
    )
    weights = np.zeros(FEATURES, np.float32)
    weights[known] = w
    return Model(weights, bias)


def score(docs: DataFrame, model: Model, column: str = "toxicity") -> DataFrame:
    """All rows and columns of `docs` with one more, `column`: the score of the whole text.

    A NULL text counts as empty; an empty text gets the score of the bias alone. Rows are neither
    merged nor lost. A column of that name is replaced.
    """
    common.prepare(docs.sparkSession)
    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield texts.map(lambda t: model.score((t or "").encode()))

    scored = scored.asNondeterministic()  # so that no filter above it runs it twice
    return docs.withColumn(column, scored(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **fitting) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of `docs`; see fit() and score()."""
    folds, held_out = fitting.get("folds", 3), fitting.get("held_out", 1)
    given = docs.select("doc_id", "text")
    return score(given, fit(given, labels, **fitting)).select(
        "doc_id", (common.fold("doc_id", folds) == held_out).alias("held_out"),
        F.col("toxicity").alias("score"), (F.col("toxicity") >= threshold).cast("int").alias("predicted"),
    )
