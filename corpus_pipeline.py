"""A training corpus from raw documents: toxicity, near-duplicates, repeated lines, mixture,
token ids.

Each stage is a function of (spark, docs, sf_dir); ``run`` writes what a stage returns as
Parquet in the shared folder and reads it again as the documents of the next. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.llm import bpe, mixing, simhash, substring, toxicity
from stocktake.llm.shared import prepare, table
from stocktake.session import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not judged toxic, unchanged; null and empty texts stay, and so do repeated
    rows. An empty table stays empty."""
    prepare(spark)
    labels = table(spark, sf_dir, "labels")
    return toxicity.clean(docs, labels)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group, unchanged. All empty
    and null texts are one group."""
    prepare(spark)
    return simhash.representatives(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that an earlier document or place has; ``n_chars``
    follows the text. A null text stays null."""
    prepare(spark)
    columns = docs.columns
    kept = substring.dedup(docs)
    changed = F.col("units_removed") > 0
    values = {c: F.col("doc")[c] for c in columns}
    if "n_chars" in values:
        kind = docs.schema["n_chars"].dataType
        values["n_chars"] = F.when(changed, F.length("text").cast(kind)).otherwise(values["n_chars"])
    values["text"] = F.col("text")
    return kept.select(*[values[c].alias(c) for c in columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows of the mix, each as often as it is taken."""
    prepare(spark)
    return mixing.emitted(mixing.mix(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, the ids, and the digests of the ids and of the decoded bytes; one row
    per row of the mix. A null text has no ids."""
    coded = bpe.round_trip(docs, bpe.Bpe(prepare(spark)))
    return coded.select(
        "doc_id", "n_tokens", "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("repeated_lines", drop_repeated_lines),
    ("mix", mix_sources),
    ("token_ids", encode),
]

# Trained models, hashes and a tokenizer are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


__all__ = ["ORACLE_SQL", "STAGES", "run"]
