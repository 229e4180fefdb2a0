"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Every text becomes a vector of statistics (sizes, character classes, repetition, compressibility),
each transformed towards a normal shape. Learning (bounded sample of labelled rows, ``max_rows``):
class means and covariances; each covariance is shrunk towards the pooled one and towards its own
diagonal, and its Cholesky factor kept. Scoring: the squared Mahalanobis distances by triangular
solves with the cached factors, the difference of log densities and log priors, and its logistic.

Defined results: null and empty texts have the statistics of an empty text and score like it. Rows
are scored alone, so repeated rows score alike; null ids and extra columns change nothing. An empty
table gives an empty result; with one class only, every score is 1 or 0 by that class, without any
label 0.5.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import labelled_sample

FEATURES = ("chars", "words", "word_length", "long_words", "short_words", "letters", "upper", "digits", "symbols",
            "pipes", "marks", "non_ascii", "line_length", "distinct_words", "adjacent", "frequent", "lines_repeated",
            "compressed", "symbol_runs", "clean_words")


def _classes() -> np.ndarray:
    """One row per byte: letter, upper, digit, symbol, pipe, sentence mark, non-ASCII, white space."""
    table = np.zeros((256, 8))
    for b in range(256):
        c = chr(b)
        if b < 128:
            table[b] = [c.isalpha(), c.isupper(), c.isdigit(), not c.isalnum() and not c.isspace() and c not in ".,;:!?'\"()-|",
                        c == "|", c in ".!?", 0, c.isspace()]
        else:
            table[b, 6] = 1
    return table


BYTE_CLASSES = _classes()


def statistics(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8")
    n = len(raw)
    words = (text or "").split()
    m = len(words)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ BYTE_CLASSES if n else np.zeros(8)
    letters, upper, digits, symbols, pipes, marks, other, _ = counts.tolist()
    lines = [x for x in (text or "").split("\n") if x.strip()]
    lengths = list(map(len, words))
    frequency: dict[str, int] = {}
    for w in words:
        frequency[w] = frequency.get(w, 0) + 1
    adjacent = sum(map(operator.eq, words, words[1:]))
    packed = len(zlib.compress(raw, 1)) if n else 0
    runs = (text or "").count("!!") + (text or "").count("##") + (text or "").count("$$") + (text or "").count("%%") \
        + (text or "").count("&&") + (text or "").count("**")
    clean = sum(map(str.isalpha, words))
    each, of_words = 1.0 / (n + 1), 1.0 / (m + 1)
    return [
        np.log1p(n), np.log1p(m), np.log1p(sum(lengths) * of_words), np.sqrt(sum(x > 14 for x in lengths) * of_words),
        np.sqrt(sum(x < 4 for x in lengths) * of_words), letters * each, np.sqrt(upper * each), np.sqrt(digits * each),
        np.sqrt(symbols * each), np.sqrt(pipes * each), np.sqrt(marks * each), other * each,
        np.log1p(n / (len(lines) + 1)), len(frequency) * of_words, np.sqrt(adjacent * of_words),
        np.sqrt(max(frequency.values(), default=0) * of_words), np.sqrt((len(lines) - len(set(lines))) / (len(lines) + 1)),
        np.log1p(packed) - np.log1p(n), np.sqrt(runs * of_words), np.sqrt(clean * of_words),
    ]


def matrix(texts: Iterable) -> np.ndarray:
    return np.asarray([statistics(t) for t in texts], dtype=float).reshape(-1, len(FEATURES))


@dataclass
class Discriminant:
    """Class means, inverse Cholesky factors, log determinants and log priors; classes 0 and 1."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_dets: list[float]
    log_priors: list[float]
    centre: np.ndarray
    scale: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        if len(self.means) < 2:
            return np.full(len(x), self.log_priors[0])
        z = (x - self.centre) / self.scale
        logs = []
        for mean, factor, log_det, prior in zip(self.means, self.factors, self.log_dets, self.log_priors, strict=True):
            d = (z - mean) @ factor.T
            logs.append(prior - 0.5 * (log_det + (d * d).sum(axis=1)))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, towards_pooled: float = 0.15, towards_diagonal: float = 0.1, floor: float = 0.02) -> Discriminant:
    """``floor``: least variance in units of the pooled variance, so that a statistic that is
    constant within a class doesn't decide alone."""
    if not len(y) or len(set(y.tolist())) < 2:
        constant = 0.5 if not len(y) else float(y[0])
        return Discriminant([], [], [], [constant], np.zeros(len(FEATURES)), np.ones(len(FEATURES)))
    centre, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = (x - centre) / scale
    pooled = sum(np.cov(z[y == c].T, bias=True) * (y == c).mean() for c in (0, 1))
    means, factors, dets, priors = [], [], [], []
    for c in (0, 1):
        own = z[y == c]
        cov = np.cov(own.T, bias=True) if len(own) > 1 else pooled
        blend = towards_pooled + (1 - towards_pooled) * len(FEATURES) / (len(FEATURES) + len(own))
        cov = (1 - blend) * cov + blend * pooled
        cov = (1 - towards_diagonal) * cov + towards_diagonal * np.diag(np.diag(cov)) + floor * np.eye(len(cov))
        root = np.linalg.cholesky(cov)
        means.append(own.mean(axis=0))
        factors.append(np.linalg.inv(root))
        dets.append(2 * float(np.log(np.diag(root)).sum()))
        priors.append(float(np.log((y == c).mean())))
    return Discriminant(means, factors, dets, priors, centre, scale)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = 20_000) -> Discriminant:
    """Fitted on at most ``max_rows`` labelled rows (the caller's training rows)."""
    sample = labelled_sample(docs, labels, label, max_rows).select("text", "label")
    names = [f"f{i}" for i in range(len(FEATURES))]

    def measure(batches: Iterable) -> Iterator:
        for batch in batches:
            out = pd.DataFrame(matrix(batch["text"]), columns=names)
            out["label"] = batch["label"].to_numpy()
            yield out

    rows = sample.mapInPandas(measure, ", ".join(f"{n} double" for n in names) + ", label int").toPandas()
    rows = rows.sort_values(["label", *names])  # the fit doesn't depend on the order of partitions
    return fit(rows[names].to_numpy(dtype=float), rows["label"].to_numpy())


def with_score(docs: DataFrame, model: Discriminant, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column ``score`` (0 to 1). One pass over the texts, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = shared.value
        for texts in batches:
            yield pd.Series(own.scores(matrix(texts)), dtype="float64")

    return docs.withColumn(score, score_of(F.col(text).cast("string")))
