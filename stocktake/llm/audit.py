"""How filters act on each other: what every filter removes at every place in every order.

A row fails some of n filters, so it lies in one of 2^n cells. The counts of a part of the
corpus are a tensor of n axes with two places each (0: passes, 1: fails). Every figure of the
report is a contraction of it: along each axis a vector selects pass, fail or all. The
report's size depends on the number of parts only, never on the number of rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stocktake.llm.shared import named, whole
from stocktake.session import stage

FILTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # per cent of the words
MOST_CAPITALS = 5  # per cent of the code points
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = b"#$%&*|"
LATER_BYTES = bytes(range(0x80, 0xC0))  # of a code point of several bytes
BLANK = re.compile(rb"[\x20\x09-\x0D]")
PIECE = 1 << 20  # bytes of a text whose words are held at a time
PARTS = 100  # parts in one tensor

_MARKED = pa.schema(
    [("key", pa.int64()), ("part", pa.string()), ("digest", pa.binary()), ("fails", pa.int32())]
)


def _counted(text: bytes) -> tuple[int, int]:
    """Words and distinct words. A long text is split piece by piece, cut at blanks, so that
    only its distinct words are held."""
    words, seen, start = 0, set(), 0
    while start < len(text):
        cut = BLANK.search(text, start + PIECE) if len(text) - start > PIECE else None
        stop = cut.start() if cut else len(text)
        found = text[start:stop].split()
        words += len(found)
        seen.update(found)
        start = stop
    return words, len(seen)


def failures(text: bytes) -> int:
    """The filters A to D that a text fails, as bits; A is the highest of the four."""
    words, distinct = _counted(text)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    points = len(text.translate(None, LATER_BYTES))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    fails = (
        words < LEAST_WORDS,
        100 * distinct < LEAST_DISTINCT * words,
        100 * capitals > MOST_CAPITALS * points,
        symbols > 0,
    )
    return sum(bool(x) << (3 - i) for i, x in enumerate(fails))


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, fails = [], []
        for value in batch.column("text"):
            text = value.as_py()
            digests.append(hashlib.blake2b(text, digest_size=16).digest())
            fails.append(failures(text))
        columns = [batch.column("key"), batch.column("part"), pa.array(digests, pa.binary())]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(fails, pa.int32())], schema=_MARKED)


def cells(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source"
) -> DataFrame:
    """Counts of every part (a null one is the empty string) and cell that occurs: part, cell,
    docs, good, toxic. The cell's bits are the filters failed, A the highest.

    E fails where a smaller id has the same text. Whole texts are compared by digests of 128
    bits. Rows of one text, part and label are counted before they are shuffled by digest, and
    equal texts share A to D, so a text that is on a third of all rows is a few rows by then.

    A null text is empty. A row without id has no smaller id and is no other row's smaller
    one; rows of the same id and text are not repeats of each other. Labels are good or toxic
    if any of an id's rows says so; a row without label is neither. Repeated rows count as
    rows. An empty table has no parts. Other columns are not read.
    """
    narrow = docs.select(
        named(key).cast("long").alias("key"),
        F.coalesce(named(part).cast("string"), F.lit("")).alias("part"),
        whole(text).cast("binary").alias("text"),
    )
    kind = "key long, part string, digest binary, fails int"
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("key")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).cast("long").alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("long").alias("toxic"),
    )
    none = F.lit(0).cast("long")
    labelled = (
        narrow.mapInArrow(_marks, kind)
        .join(marks, "key", "left")
        .withColumns({c: F.coalesce(c, none) for c in ("good", "toxic")})
    )
    same = ["digest", "fails", "part", "good", "toxic"]
    texts = (
        labelled.groupBy("key", *same)
        .agg(F.count("*").alias("n"))
        .groupBy(*same)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("key").isNull(), F.col("n")).otherwise(0)).alias("without"),
            F.min("key").alias("least"),
            F.min_by("n", "key").alias("at_least"),
        )
    )
    texts = stage(texts, "audit-texts")
    first = texts.groupBy("digest").agg(F.min("least").alias("first"))
    of_first = F.when(F.col("least") == F.col("first"), F.col("at_least")).otherwise(0)
    split = texts.join(first, "digest").withColumn("passed", F.col("without") + of_first)
    counts = {"docs": F.lit(1), "good": F.col("good"), "toxic": F.col("toxic")}
    sums = split.groupBy("part", "fails").agg(
        *[F.sum(F.col("passed") * by).alias(f"{c}_0") for c, by in counts.items()],
        *[F.sum((F.col("n") - F.col("passed")) * by).alias(f"{c}_1") for c, by in counts.items()],
    )
    return sums.select(
        "part",
        F.explode(
            F.array(
                *[
                    F.struct(
                        (F.col("fails") * 2 + e).cast("int").alias("cell"),
                        *[F.col(f"{c}_{e}").alias(c) for c in counts],
                    )
                    for e in (0, 1)
                ]
            )
        ).alias("c"),
    ).select("part", "c.*")


_PASS, _FAIL, _ALL = np.array([1, 0]), np.array([0, 1]), np.array([1, 1])


class Tensor:
    """Counts of several parts: a tensor (part, kind of count, one axis of two per filter)."""

    def __init__(self, counts: np.ndarray, filters: str = FILTERS):
        self.counts, self.filters = counts.reshape(*counts.shape[:2], *[2] * len(filters)), filters
        self.select = cache(self._select)

    def _select(self, passed: frozenset[str], failed: frozenset[str]) -> np.ndarray:
        """Counts of rows that pass the first filters and fail the second, by part and kind."""
        axes = range(2, 2 + len(self.filters))
        vectors = [_PASS if f in passed else _FAIL if f in failed else _ALL for f in self.filters]
        operands = [x for axis, v in zip(axes, vectors) for x in (v, [axis])]
        return np.einsum(self.counts, [0, 1, *axes], *operands, [0, 1])

    def report(self) -> Iterator[tuple[str, int, dict[str, np.ndarray]]]:
        """Figures of every part for each step of each order."""
        none, steps = frozenset(), {}
        for order in map("".join, permutations(self.filters)):
            for step, name in enumerate(order):
                before, own = frozenset(order[:step]), frozenset(name)
                steps[order, step] = self.select(before, own)
        shapley = {f: sum(x[:, 0] for (o, s), x in steps.items() if o[s] == f) for f in self.filters}
        for (order, step), removed in steps.items():
            name, before = order[step], frozenset(order[:step])
            own, others = frozenset(name), frozenset(self.filters) - {name}
            yield order, step + 1, {
                "kept": self.select(before | own, none)[:, 0],
                "removed": removed[:, 0],
                "redundant": self.select(none, own)[:, 0] - removed[:, 0],
                "unique_fails": self.select(others, own)[:, 0],
                "good_lost": removed[:, 1],
                "toxic_lost": removed[:, 2],
                "shapley": shapley[name],
            }


_REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def _reports(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        for at in range(0, len(frame), PARTS):
            parts = frame.iloc[at : at + PARTS]
            counts = np.zeros((len(parts), 3, 2 ** len(FILTERS)), "int64")
            for row, found in enumerate(parts["cells"]):
                for c in found:
                    counts[row, :, c["cell"]] += (c["docs"], c["good"], c["toxic"])
            names = parts["part"].to_numpy()
            pieces = [
                pd.DataFrame({"part": names, "filter_order": order, "step": step, **figures})
                for order, step, figures in Tensor(counts).report()
            ]
            yield pd.concat(pieces, ignore_index=True)


def interactions(counted: DataFrame) -> DataFrame:
    """The report from ``cells``: a row for every part, order of the filters and step. At most
    32 cells of a part are gathered in a row."""
    found = F.collect_list(F.struct("cell", "docs", "good", "toxic")).alias("cells")
    return counted.groupBy("part").agg(found).mapInPandas(_reports, _REPORT)
