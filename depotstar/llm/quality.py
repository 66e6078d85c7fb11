"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class gets a mean and a shrunken covariance; a text's score compares its Mahalanobis
log-densities under the two, computed from the cached inverse Cholesky factors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import common

FEATURES = (
    "log_chars", "log_words", "word_chars", "upper", "digits", "blanks", "lines",
    "sentence_marks", "exclamations", "symbols", "bars", "distinct_words", "repeated_words",
    "long_run",
)


def _mask(chars: bytes) -> np.ndarray:
    mask = np.zeros(256)
    mask[list(chars)] = 1
    return mask


_CLASSES = np.stack([
    _mask(bytes(range(65, 91))),
    _mask(b"0123456789"),
    _mask(b" \t"),
    _mask(b"\n\r"),
    _mask(b".,;:?'\"()-"),
    _mask(b"!"),
    _mask(b"#$%&*@^~<>{}[]\\/_+=`"),
    _mask(b"|"),
    _mask(bytes(b for b in range(256) if b & 0xC0 != 0x80)),
])


def statistics(text: bytes) -> list[float]:
    """Statistics of one whole text; shares are taken as log-odds so that they are near normal."""
    counts = _CLASSES @ np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, digits, blanks, lines, marks, exclamations, symbols, bars, chars = counts
    words = text.split()
    n = len(words)
    run = longest = same = 0
    before = None
    for w in words:
        run = run + 1 if w == before else 0
        same += run > 0
        longest = max(longest, run)
        before = w

    def odds(part: float, whole: float) -> float:
        return math.log((part + 0.5) / (max(whole - part, 0) + 0.5))

    return [
        math.log1p(chars),
        math.log1p(n),
        math.log((chars + 1) / (n + 1)),
        odds(upper, chars),
        odds(digits, chars),
        odds(blanks, chars),
        odds(lines, chars),
        odds(marks, chars),
        odds(exclamations, chars),
        odds(symbols, chars),
        odds(bars, chars),
        math.log((len(set(words)) + 1) / (n + 1)),
        odds(same, n),
        math.log1p(longest),
    ]


def _statistics_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t) for t in common.text_bytes(batch)]
        columns = np.array(rows, np.float64).reshape(len(rows), len(FEATURES)).T
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *map(pa.array, columns)], names=["id", *FEATURES]
        )


def document_statistics(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """id and the statistics of each row; rows are neither merged nor lost."""
    common.prepare(docs.sparkSession)
    given = common.id_and_text(docs, id_column, text_column)
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(
        _statistics_of, f"id {kind}, " + ", ".join(f"{f} double" for f in FEATURES)
    )


@dataclass
class Discriminant:
    """Per class: mean, inverse Cholesky factor of the covariance, and the rest of the density."""

    means: np.ndarray
    factors: np.ndarray
    offsets: np.ndarray
    prior: float | None = None

    def score(self):
        """The posterior of class 1 as a column over FEATURES."""
        if self.prior is not None:
            return F.lit(self.prior)
        logs = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            squares = [
                "pow(" + " + ".join(
                    f"({float(factor[r, j])!r}D) * ({FEATURES[j]} - ({float(mean[j])!r}D))"
                    for j in range(r + 1)
                ) + ", 2)"
                for r in range(len(FEATURES))
            ]
            logs.append(f"({float(offset)!r}D) - 0.5D * ({' + '.join(squares)})")
        gap = f"greatest(-700D, least(700D, ({logs[1]}) - ({logs[0]})))"
        return F.expr(f"1D / (1D + exp(-({gap})))")


def fit(labelled: DataFrame, shrinkage: float = 0.1) -> Discriminant:
    """Fit on `label` (0 or 1) and FEATURES, from one aggregation over all rows given.

    The covariance of a class is mixed with the pooled one and its diagonal. If a class has no
    rows, every score is the share of label 1 (0.5 without any label).
    """
    k = len(FEATURES)
    sums = [F.sum(f).alias(f"s{i}") for i, f in enumerate(FEATURES)]
    products = [
        F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}_{j}")
        for i in range(k) for j in range(i + 1)
    ]
    found = {
        r["label"]: r
        for r in labelled.where("label in (0, 1)").groupBy("label")
        .agg(F.count("*").alias("n"), *sums, *products).collect()
    }
    if len(found) < 2:
        return Discriminant(*[np.zeros(0)] * 3, prior=float(next(iter(found), 0.5)))
    counts, means, scatters = [], [], []
    for label in (0, 1):
        r = found[label]
        mean = np.array([r[f"s{i}"] for i in range(k)]) / r["n"]
        second = np.zeros((k, k))
        for i in range(k):
            for j in range(i + 1):
                second[i, j] = second[j, i] = r[f"p{i}_{j}"] / r["n"]
        counts.append(r["n"])
        means.append(mean)
        scatters.append(second - np.outer(mean, mean))
    total = sum(counts)
    pooled = sum(n * s for n, s in zip(counts, scatters)) / total
    target = 0.5 * pooled + 0.5 * np.diag(np.diag(pooled)) + 1e-3 * np.eye(k)
    factors, offsets = [], []
    for n, scatter in zip(counts, scatters):
        # Few rows lean more on the target.
        a = max(shrinkage, k / (n + k))
        lower = np.linalg.cholesky((1 - a) * scatter + a * target)
        factors.append(np.linalg.inv(lower))
        offsets.append(math.log(n / total) - np.log(np.diag(lower)).sum())
    return Discriminant(np.array(means), np.array(factors), np.array(offsets))


def classify(
    docs: DataFrame, labels: DataFrame, label_column: str = "quality", folds: int = 3,
    held_out: int = 1, threshold: float = 0.5, shrinkage: float = 0.1,
) -> DataFrame:
    """doc_id, held_out, score and predicted for each row of `docs` (doc_id, text).

    Labels of the held-out fold are not read. NULL texts count as empty, and empty texts are
    scored like others; a NULL doc_id has no label; a repeated label counts once, and labels that
    contradict each other count once each; label values other than 0 and 1 are ignored. Further
    columns of either table are not read. Empty tables give an empty result or constant scores.
    """
    stats = stage(document_statistics(docs), "statistics")
    known = labels.select(
        F.col("doc_id").alias("id"), F.col(label_column).cast("int").alias("label")
    ).where("label in (0, 1)").distinct()
    learn = stats.where(common.fold("id", folds) != held_out).join(known, "id")
    return stats.select(
        F.col("id").alias("doc_id"),
        (common.fold("id", folds) == held_out).alias("held_out"),
        fit(learn, shrinkage).score().alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
