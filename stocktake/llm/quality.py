"""Text quality by ordinal cumulative-link regression on graded ratings.

P(grade <= j) = sigmoid(threshold_j - w.x): one set of hashed-text weights is shared by all
grades, and ordered thresholds part them. The model gives the expected grade and the
probability of each grade or more, by which texts are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.llm.features import Words, grams, hashes
from stocktake.llm.shared import named
from stocktake.llm.toxicity import held_out, sample

BITS = 18
SAMPLE = 6_000  # rated documents that the model is fitted on at most
EPOCHS = 6
RATE, L1 = 0.3, 1.0
GRADES = 3
KEEP_AT = 1  # selected: texts that have this grade or more with
KEEP = 0.5  # at least this probability
GRAMS = 1 << 18
_STEPS = 10  # a share is a feature by tenths


def _shape(text: str) -> list[str]:
    """Shares of odd words, repeated lines and repeated words, and the length, in steps."""
    words = text.split()
    lines = text.split("\n")
    n = max(len(words), 1)
    odd = sum(w[-1] in "$#%&*|" for w in words)
    long_lines = sum(len(x) > 1000 for x in lines)
    shares = {
        "odd": odd / n,
        "lines": len(set(lines)) / len(lines),
        "words": len(set(words)) / n,
        "long": long_lines / len(lines),
        "letters": sum(map(str.isalpha, words)) / n,
    }
    return [f"{k}:{round(v * _STEPS)}" for k, v in shares.items()] + [f"size:{len(words).bit_length()}"]


def features(
    text: str, words: Words, bits: int = BITS, weights: np.ndarray | None = None
) -> np.ndarray:
    """Buckets of words, pairs, skip-grams and shape, each once; given weights, those of words
    without weight are left out before the buckets are sorted."""
    found = hashes(text, words)
    parts = []
    for at in range(0, max(len(found), 1), GRAMS):
        own = grams(found[at : at + GRAMS + 2], bits)
        parts.append(np.unique(own if weights is None else own[weights[own] != 0]))
    shape = [xxhash.xxh64_intdigest(s, 7) >> (64 - bits) for s in _shape(text)]
    return np.unique(np.concatenate([*parts, np.array(shape, np.int64)]))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than there are grades
    bits: int = BITS

    def tails(self, text: str, words: Words) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ..."""
        active = features(text, words, self.bits, self.weights)
        margin = float(self.weights[active].sum(dtype=np.float64))
        return 1 / (1 + np.exp(np.clip(self.thresholds - margin, -35, 35)))


def fit(texts: list[str], grades: list[int], n_grades: int = GRADES, bits: int = BITS, epochs: int = EPOCHS) -> Model:
    """Adaptive rates per coordinate and L1 by dual averaging, one document at a time."""
    words = Words()
    rows = [features(t, words, bits) for t in texts]
    size = 1 << bits
    z, n = np.zeros(size), np.zeros(size)
    cuts, cut_n = np.arange(n_grades - 1) - (n_grades - 2) / 2.0, np.zeros(n_grades - 1)

    def weights(own_z: np.ndarray, own_n: np.ndarray) -> np.ndarray:
        shrunk = np.sign(own_z) * np.maximum(np.abs(own_z) - L1, 0.0)
        return -shrunk * RATE / (1.0 + np.sqrt(own_n))

    for _ in range(epochs):
        for row, grade in zip(rows, grades):
            w = weights(z[row], n[row])
            below = 1 / (1 + np.exp(-np.clip(cuts - w.sum(), -35, 35)))  # P(grade <= j)
            upper = below[grade] if grade < n_grades - 1 else 1.0
            lower = below[grade - 1] if grade else 0.0
            p = max(upper - lower, 1e-9)
            g = 1.0 - upper - lower  # of the loss, by the margin
            step = (np.sqrt(n[row] + g * g) - np.sqrt(n[row])) / RATE
            z[row] += g - step * w
            n[row] += g * g
            slope = np.zeros(n_grades - 1)
            if grade < n_grades - 1:
                slope[grade] -= upper * (1 - upper) / p
            if grade:
                slope[grade - 1] += lower * (1 - lower) / p
            slope = np.clip(slope, -5, 5)
            cut_n += slope * slope
            cuts = np.maximum.accumulate(cuts - RATE * slope / (1.0 + np.sqrt(cut_n)))
    return Model(weights(z, n).astype(np.float32), cuts, bits)


def grades_of(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Ratings from the two marks: 0 for bad text, 1 for good but toxic text, 2 for good."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    return labels.where("quality IS NOT NULL AND toxic IS NOT NULL").select(
        named(key).alias(key), grade.alias("grade")
    )


def tails(text: Column, model: Broadcast) -> Column:
    """An array of the tail probabilities. Null is scored as an empty text."""

    @F.pandas_udf("array<double>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words, own = Words(), model.value
        for batch in batches:
            yield pd.Series([own.tails(t or "", words) for t in batch], dtype=object)

    return scored(text)


def rated(
    documents: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", n_grades: int = GRADES
) -> DataFrame:
    """Per row of ``documents``: key, held_out, expected_grade, p_at_least_1, ... and selected.

    ``ratings`` has key and grade; rows held out are not learned from. Null and empty texts
    are scored like any other; equal texts get equal scores; null keys are not held out and
    never learned from; repeated rows give a row each; other columns are left out. Without
    ratings the scores are those of the starting thresholds.
    """
    learn = ratings.where(~held_out(named(key)))
    texts, grades = sample(documents, learn, "grade", rows=SAMPLE, key=key, text=text)
    model = documents.sparkSession.sparkContext.broadcast(fit(texts, grades, n_grades))
    scored = documents.select(named(key).alias(key), tails(named(text), model).alias("tails"))
    at_least = [F.get("tails", F.lit(j)).alias(f"p_at_least_{j + 1}") for j in range(n_grades - 1)]
    return scored.select(
        named(key),
        F.coalesce(held_out(named(key)), F.lit(False)).alias("held_out"),
        F.aggregate("tails", F.lit(0.0), lambda a, x: a + x).alias("expected_grade"),
        *at_least,
        (F.get("tails", F.lit(KEEP_AT - 1)) >= KEEP).cast("int").alias("selected"),
    )
