"""Toxicity by FTRL-proximal logistic regression over hashed words, word pairs and skip-grams.

Each coordinate has its own learning rate, and L1 keeps the weights of all but telling
buckets at zero, so the model that is broadcast is a short list of buckets and weights.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stocktake.llm.features import Words, grams, hashes
from stocktake.llm.shared import held, named, whole
from stocktake.session import stage

BITS = 20
SAMPLE = 6_000  # labelled documents that the model is fitted on at most
SAMPLE_CHARS = 64_000_000  # and characters of them in all
EPOCHS = 6
ALPHA, BETA, L1, L2 = 3.0, 1.0, 10.0, 0.1
POSITIVE = 3.0  # weight of a toxic example
CUT = 0.7
GRAMS = 1 << 18  # words scored at once


@dataclass(frozen=True)
class Model:
    """Non-zero weights by bucket, ascending, and the bias."""

    buckets: np.ndarray
    weights: np.ndarray
    bias: float
    bits: int = BITS

    def score(self, text: str, words: Words) -> float:
        """Every bucket that occurs counts once, however long the text."""
        found = hashes(text, words)
        table = _table(self)
        hit: list[np.ndarray] = []
        for at in range(0, max(len(found), 1), GRAMS):
            own = grams(found[at : at + GRAMS + 2], self.bits)
            hit.append(np.unique(own[table[own] != 0]))
        active = np.unique(np.concatenate(hit))
        margin = self.bias + float(table[active].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


def _spread(buckets: bytes, weights: bytes, bits: int) -> np.ndarray:
    def spread() -> np.ndarray:
        table = np.zeros(1 << bits, np.float32)
        table[np.frombuffer(buckets, np.int64)] = np.frombuffer(weights, np.float32)
        return table

    return held(("weights", buckets, weights, bits), spread)


def _table(model: Model) -> np.ndarray:
    table = model.__dict__.get("_table")
    if table is None:
        table = _spread(model.buckets.tobytes(), model.weights.tobytes(), model.bits)
        model.__dict__["_table"] = table
    return table


def fit(
    texts: list[str], labels: list[int], bits: int = BITS, epochs: int = EPOCHS, positive: float = POSITIVE
) -> Model:
    """FTRL-proximal, one document at a time; the order is the order given."""
    words = Words()
    rows = [np.unique(grams(hashes(t, words), bits)) for t in texts]
    size = 1 << bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last place is the bias

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        free = np.where(at == size, 0.0, L1)
        shrunk = np.sign(own) * np.maximum(np.abs(own) - free, 0.0)
        return -shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + np.where(at == size, 0.0, L2))

    for _ in range(epochs):
        for row, label in zip(rows, labels):
            at = np.append(row, size)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = (p - label) * (positive if label else 1.0)
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    final = weights(np.arange(size + 1))
    kept = np.flatnonzero(final[:size])
    return Model(kept, final[kept].astype(np.float32), float(final[size]), bits)


def sample(
    documents: DataFrame, labels: DataFrame, target: str, rows: int = SAMPLE, chars: int = SAMPLE_CHARS,
    key: str = "doc_id", text: str = "text",
) -> tuple[list[str], list[int]]:
    """At most ``rows`` labelled texts, and ``chars`` characters of them, by a hash of the id.

    The bound does not depend on the size of the tables: it is what the driver holds. Rows
    without a label are left out; a document with several labels is one example for each, and
    rows that repeat id, label and text are one example. A text that the characters left do
    not hold is passed over, and the next ones are tried. What is chosen is known from ids,
    lengths and digests; only chosen texts leave the tasks.
    """
    order = F.xxhash64(F.col("key"))
    chosen = (
        labels.select(named(key).alias("key"), named(target).cast("int").alias("label"))
        .where("key IS NOT NULL AND label IS NOT NULL")
        .orderBy(order, "key", "label")
        .limit(rows)
    )
    texts = documents.select(named(key).alias("key"), whole(text).alias("text"))
    labelled = texts.join(F.broadcast(chosen), "key")  # bounded rows
    found = stage(labelled.select("key", "label", "text", F.sha2("text", 256).alias("digest")), "labelled")
    sizes = found.groupBy("key", "label", "digest").agg(F.first(F.length("text")).alias("n"))
    left, kept = chars, []
    for r in sizes.orderBy(order, "key", "label", "digest").limit(rows).collect():  # bounded rows
        if r.n <= left:
            left -= r.n
            kept.append((r.key, r.label, r.digest))
    if not kept:
        return [], []
    fields = [f for f in found.schema if f.name in ("key", "label", "digest")]
    wanted = F.broadcast(documents.sparkSession.createDataFrame(kept, StructType(fields)))  # bounded rows
    got = found.join(wanted, ["key", "label", "digest"]).groupBy("key", "label", "digest").agg(F.first("text").alias("text"))
    got = got.orderBy(order, "key", "label", "digest").collect()
    return [r.text for r in got], [r.label for r in got]


def held_out(key: Column) -> Column:
    """Rows that are never learned from."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Broadcast:
    """A model of ``labels.toxic``, fitted without the rows held out."""
    learn = labels.where(~held_out(named(key)))
    texts, toxic = sample(documents, learn, "toxic", key=key, text=text)
    return documents.sparkSession.sparkContext.broadcast(fit(texts, toxic))


def scores(text: Column, model: Broadcast) -> Column:
    """From 0 to 1, higher where the label 1 is likelier. Null is scored as an empty text."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words, own = Words(), model.value
        for batch in batches:
            yield pd.Series([own.score(t or "", words) for t in batch], dtype="float64")

    return scored(text)


def judged(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", cut: float = CUT
) -> DataFrame:
    """Per row of ``documents``: key, held_out, score and predicted (1 from ``cut`` on).

    Null and empty texts get the score of the bias. Equal texts get equal scores, whatever
    else is in the row; a null key is not held out and never learned from. Repeated rows give
    a row each. Without any label every score is 0.5. Other columns are left out.
    """
    model = train(documents, labels, key, text)
    scored = documents.select(named(key).alias(key), scores(named(text), model).alias("score"))
    return scored.select(
        named(key),
        F.coalesce(held_out(named(key)), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= cut).cast("int").alias("predicted"),
    )


def clean(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of ``documents`` that are not judged toxic, unchanged."""
    model = train(documents, labels, key, text)
    return documents.where(scores(named(text), model) < cut)
