"""Language identification with string kernels.

The kernel of two texts is the blended-spectrum presence kernel: the number of character n-grams
(n = 1..3 over lower-cased letters of all Unicode planes, other characters as one blank) that both hold, normalised by
both texts' own numbers; n-grams are hashed to ``BUCKETS`` presence bits. A bounded, documented
sample of labelled rows (``per_language`` each) is drawn, ``landmarks`` of its texts span the
Nyström approximation, and one-versus-rest kernel ridge regression is solved in that space.
Scoring is batched matrix products: presence bits times landmark bits, then times the weights.

Defined results: ``und`` with score 0 for null texts and texts without a letter, and for all texts
if no row teaches a language. Rows are scored alone, so repeated rows are predicted alike; null ids
and extra columns change nothing. An empty table gives an empty result. Equal scores go to the
language that comes first by name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
ORDERS = 3
BATCH = 128
#: Languages that can be learned, the commonest first.
MAX_LANGUAGES = 1000
UNDETERMINED = "und"


def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


class Presence:
    """Presence bits of hashed n-grams."""

    def __init__(self):
        self.letter = _letters()

    def __call__(self, text: str | None) -> np.ndarray | None:
        """Boolean vector, or None for a text without a letter."""
        if not text:
            return None
        code = np.frombuffer(text.lower().encode("utf-32-le"), dtype=np.uint32)
        letter = self.letter[code]
        if not letter.any():
            return None
        code = np.where(letter, code, np.uint32(32)).astype(np.uint32)
        bits = np.zeros(BUCKETS, dtype=bool)
        gram = np.zeros(len(code) + 1, dtype=np.uint32)
        with np.errstate(over="ignore"):
            for n in range(1, ORDERS + 1):
                if len(code) < n:
                    break
                gram = gram[: len(code) - n + 1] * np.uint32(0x01000193) + code[n - 1:]
                bits[((gram + np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(17)] = True
        return bits


@dataclass
class KernelModel:
    """Landmark bits, their norms, and the folded weights: scores = kernel @ weights."""

    languages: list[str]
    landmarks: np.ndarray
    norms: np.ndarray
    weights: np.ndarray

    def predict(self, texts: Iterable) -> tuple[list[str], list[float]]:
        texts = list(texts)
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        presence = _presence()
        rows, where = [], []

        def flush():
            if not rows:
                return
            x = np.asarray(rows, dtype=np.float32)
            out = normalised(x, self.landmarks, self.norms) @ self.weights
            out = np.exp(4 * (out - out.max(axis=1, keepdims=True)))
            out /= out.sum(axis=1, keepdims=True)
            for i, best, score in zip(where, out.argmax(axis=1).tolist(), out.max(axis=1).tolist()):
                names[i], scores[i] = self.languages[best], float(min(1.0, score))
            rows.clear()
            where.clear()

        for i, text in enumerate(texts):
            bits = presence(text)
            if bits is not None:
                rows.append(bits)
                where.append(i)
                if len(rows) == BATCH:
                    flush()
        flush()
        return names, scores


_PRESENCE: list[Presence] = []


def _presence() -> Presence:
    if not _PRESENCE:
        _PRESENCE.append(Presence())
    return _PRESENCE[0]


def normalised(x: np.ndarray, landmarks: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return (x @ landmarks.T) / (np.sqrt(x.sum(axis=1))[:, None] * norms[None, :])


def fit(bits: np.ndarray, languages: list[str], landmarks: int = 128, ridge: float = 0.1) -> KernelModel:
    names = sorted(set(languages))
    if not names:
        return KernelModel([], np.zeros((0, BUCKETS), np.float32), np.zeros(0), np.zeros((0, 0)))
    x = bits.astype(np.float32)
    # Landmarks in turn from each language, in the sample's (hashed) order.
    by_language = [[i for i, y in enumerate(languages) if y == n] for n in names]
    turns = [own[k] for k in range(max(map(len, by_language))) for own in by_language if k < len(own)]
    chosen = x[sorted(turns[:max(landmarks, len(names))])]
    norms = np.sqrt(chosen.sum(axis=1))
    inside = normalised(chosen, chosen, norms).astype(float)
    values, vectors = np.linalg.eigh(inside)
    keep = values > 1e-4 * values.max()
    to_space = vectors[:, keep] / np.sqrt(values[keep])
    space = np.c_[normalised(x, chosen, norms).astype(float) @ to_space]
    target = np.asarray([[1.0 if y == n else -1.0 for n in names] for y in languages])
    weight = np.asarray([1.0 / languages.count(y) for y in languages])
    weight *= len(languages) / weight.sum()
    gram = (space * weight[:, None]).T @ space + ridge * np.eye(space.shape[1])
    solved = np.linalg.solve(gram, (space * weight[:, None]).T @ target)
    return KernelModel(names, chosen, norms.astype(np.float32), (to_space @ solved).astype(np.float32))


def train(docs: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", per_language: int = 300,
          landmarks: int = 128) -> KernelModel:
    """Fitted on about ``per_language`` rows of each language (rows with null lang teach nothing).

    The rows are drawn by a hash of the id under a rate per language, so a hot language costs no
    more than a rare one; one row per language is collected, then the sample's presence bits
    (4 kB a row)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"),
                       F.col(text).cast("string").alias("text")).filter("lang is not null")
    # The MAX_LANGUAGES commonest values: a bounded table, so texts are not shuffled for it.
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES)
    rates = F.broadcast(counts.select("lang", (F.lit(1.5 * per_language) / F.col("count")).alias("rate")))
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(rates, "lang").filter(draw < F.col("rate")).select("lang", "text", draw.alias("draw"))

    def measure(batches: Iterable) -> Iterator:
        presence = _presence()
        for batch in batches:
            bits = [presence(t) for t in batch["text"]]
            kept = [i for i, b in enumerate(bits) if b is not None]
            yield pd.DataFrame({"lang": batch["lang"].iloc[kept].to_numpy(), "draw": batch["draw"].iloc[kept].to_numpy(),
                                "bits": [np.packbits(bits[i]).tobytes() for i in kept]})

    found = sample.mapInPandas(measure, "lang string, draw double, bits binary").toPandas().sort_values(["lang", "draw", "bits"])
    found = found.groupby("lang").head(per_language).sort_values(["draw", "lang", "bits"])
    bits = (np.unpackbits(np.frombuffer(b"".join(found["bits"]), np.uint8).reshape(len(found), -1), axis=1)
            if len(found) else np.zeros((0, BUCKETS), np.uint8))
    return fit(bits, found["lang"].tolist(), landmarks)


def predict(docs: DataFrame, model: KernelModel, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``language`` (lang_pred, score). One pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def language(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = shared.value.predict(texts)
            yield pd.DataFrame({"lang_pred": names, "score": scores})

    return docs.withColumn("language", language(F.col(text).cast("string")))
