"""What the operators of this folder share: tables, batch size, free column names."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Hashable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktake.session import tune

# Rows in one Arrow batch. Texts vary from a few bytes to megabytes, and a batch is held
# twice by a Python worker, so batches are kept far below Spark's 10,000 rows.
BATCH_ROWS = "1000"

# And its bytes: a thousand very long texts would be gigabytes.
BATCH_BYTES = str(8 << 20)

# The characters that separate words in the contracts of the queries.
WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def named(column: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


def fresh(prefix: str = "c") -> str:
    """A column name that no input has."""
    return f"_{prefix}_{uuid.uuid4().hex[:12]}"


def whole(column: str = "text") -> Column:
    return F.coalesce(named(column), F.lit(""))


T = TypeVar("T")
_held: dict[Hashable, object] = {}


def held(key: Hashable, make: Callable[[], T]) -> T:
    """What ``make`` gives for ``key``, kept from one task to the next of a Python worker.

    Workers are reused by all stages of an application, so a worker keeps one such thing: what
    another operator left is dropped when this one comes.
    """
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def forget() -> None:
    """Drop what a task before left in this worker; for tasks that keep nothing themselves."""
    _held.clear()
