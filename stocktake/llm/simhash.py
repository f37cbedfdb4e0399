"""SimHash near-dedup: fingerprints of word shingles, linked within a bit distance.

Distinct fingerprints are put into tiles by the population counts of three parts of their
64 bits. Two fingerprints differ in at least as many bits as the counts of their parts
differ in sum, so tile pairs beyond the radius are skipped; the others are compared exactly
with numpy exclusive-or and bit counts. Within a tile pair only a forest of the links goes
on, so groups of copies never become all their pairs, and the groups are the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.llm.graph import components
from stocktake.llm.shared import forget, fresh, named, whole
from stocktake.session import stage

SHINGLE = 4
RADIUS = 4
SEED = 42
TILE = 4096  # fingerprints in a tile at most, or a little more
ROWS = 256  # rows of a tile compared at once
SHINGLES = 1 << 16  # shingles counted at once

# The parts of a fingerprint whose bits are counted: from bit, width.
PARTS = ((0, 21), (21, 21), (42, 22))


def fingerprint(data: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """A bit is 1 if it is set in over half of the hashes of all shingles."""
    words = data.lower().split()  # for bytes: A-Z, and the white space of ASCII
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    starts = np.concatenate([[0], ends[: len(words) - width] + 1])
    ends = ends[width - 1 :]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), SHINGLES):
        spans = map(slice, starts[at : at + SHINGLES].tolist(), ends[at : at + SHINGLES].tolist())
        hashes = np.fromiter(
            map(xxhash.xxh64_intdigest, map(line.__getitem__, spans), repeat(seed)), np.uint64
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(votes * 2 > len(starts), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprints as longs of the same bits."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forget()
        for batch in batches:
            found = [fingerprint((t or "").encode(), shingle) for t in batch]
            yield pd.Series(np.array(found, np.uint64).view(np.int64))

    return hashed(text)


def _counts(bits: Column) -> list[Column]:
    masks = [((1 << width) - 1) << low for low, width in PARTS]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    return [F.bit_count(bits.bitwiseAND(F.lit(m).cast("long"))) for m in signed]


def _forest(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (lowest of a group, member) that connect what the pairs within the radius do."""
    both = np.concatenate([a, b])
    label = np.arange(len(both))
    for at in range(0, len(a), ROWS):
        near = np.bitwise_count(a[at : at + ROWS, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        if not len(i):
            continue
        i, j = i + at, j + len(a)
        while True:
            low = np.minimum(label[i], label[j])
            before = label.copy()
            np.minimum.at(label, label[i], low)
            np.minimum.at(label, label[j], low)
            while True:
                jumped = label[label]
                if np.array_equal(jumped, label):
                    break
                label = jumped
            if np.array_equal(before, label):
                break
    member = np.flatnonzero(label != np.arange(len(both)))
    return both[label[member]], both[member]


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links that connect distinct fingerprints (column ``fp``) within ``radius`` bits."""
    keyed = classes.select("fp", F.array(*_counts(F.col("fp"))).alias("tile"))
    sizes = keyed.groupBy("tile").agg(F.count("*").alias("n"))  # bounded: 22 * 22 * 23 tiles
    packed = stage(
        keyed.join(F.broadcast(sizes), "tile")
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.ceil(F.col("n") / TILE)))
        .groupBy("tile", "part")
        .agg(F.collect_list("fp").alias("fps")),
        "simhash-tiles",
    )
    # Every pair of tiles once: from the lower tile to the higher, and within a tile.
    steps = [
        s for s in product(range(-radius, radius + 1), repeat=len(PARTS))
        if sum(map(abs, s)) <= radius and s >= (0,) * len(PARTS)
    ]
    towards = F.explode(F.array(*[F.array(*[F.lit(x) for x in s]) for s in steps]))
    left = (
        packed.select(F.col("tile").alias("from"), F.col("part").alias("a_part"), F.col("fps").alias("a"), towards.alias("step"))
        .withColumn("tile", F.zip_with("from", "step", lambda x, y: x + y))
        .where(F.forall("tile", lambda x: x >= 0))
        .drop("step")
    )
    pairs = left.join(packed.select("tile", F.col("part").alias("b_part"), F.col("fps").alias("b")), "tile")
    pairs = pairs.where((F.col("from") != F.col("tile")) | (F.col("a_part") <= F.col("b_part")))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for a, b in zip(batch.column(0), batch.column(1)):
                one, two = (x.values.to_numpy().view(np.uint64) for x in (a, b))
                root, member = _forest(one, two, radius)
                different = root != member
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[different].view(np.int64)) for x in (root, member)], names=["u", "v"]
                )

    return pairs.select("a", "b").mapInArrow(compared, "u long, v long")


def near_groups(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """Per row of ``df``: key, fp (its fingerprint), root (a fingerprint that names the group)
    and component_id (smallest key of the group).

    Documents with equal fingerprints form a class; only classes are compared and linked.
    Null and empty texts have fingerprint zero, linked like any other, and texts under the
    shingle length are one shingle. Null keys are no candidates for the smallest, and a group
    without a key has a null component. Repeated rows give a row each; other columns are left
    out. A text is hashed whole, in blocks of shingles.
    """
    hashed = stage(
        df.select(named(key).alias("key"), fingerprints(named(text), shingle).alias("fp")), "simhash"
    )
    classes = stage(hashed.groupBy("fp").agg(F.min("key").alias("lowest")), "simhash-classes")
    labels = components(links(classes, radius)).withColumnRenamed("node", "fp")
    rooted = classes.join(labels, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    # A group's smallest key. Groups of one class, most of them, need no second join.
    lowest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    groups = stage(rooted.drop("lowest").join(lowest, "root"), "simhash-groups")
    return hashed.join(groups, "fp").select(F.col("key").alias(key), "fp", "root", "component_id")


def representatives(df: DataFrame, key: str = "doc_id", text: str = "text", **how: int) -> DataFrame:
    """One row of each group: the one with the smallest key. Columns are those of ``df``.

    Rows of one key can have different texts, and so lie in different groups. Such keys, and
    rows without a key, are matched by their fingerprint, which is computed once more for them
    only. Of several rows with the smallest key one stays, of the smallest fingerprint; a group
    in which no row has a key keeps one row. Null and empty texts are one group; an empty table
    stays empty.
    """
    found = stage(near_groups(df, key, text, **how), "simhash-rows")
    fp, root, same = fresh("fp"), fresh("root"), fresh("key")
    shingle = how.get("shingle", SHINGLE)
    picked = found.where(named(key) == F.col("component_id")).groupBy(F.col("root").alias(root)).agg(
        F.min("fp").alias(fp), F.min("component_id").alias(same)
    )
    picked = stage(picked, "simhash-picked")
    several = found.groupBy(named(key).alias(same)).agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    several = stage(several.where(F.col(same).isNotNull() & (F.col("least") < F.col("most"))).select(same), "simhash-keys")
    plain = picked.join(several, same, "left_anti").select(same)
    with_key = df.join(plain, named(key) == F.col(same), "left_semi").dropDuplicates([key])
    keyless = found.where("component_id IS NULL").select(F.col("fp").alias(fp), F.col("root").alias(root)).distinct()
    unclear = df.join(several, named(key) == F.col(same), "left_semi").withColumn(fp, fingerprints(named(text), shingle))
    chosen = picked.join(several, same).withColumnRenamed(fp, f"{fp}_")
    by_print = unclear.join(chosen, (named(key) == F.col(same)) & (F.col(fp) == F.col(f"{fp}_")))
    unkeyed = df.where(named(key).isNull()).withColumn(fp, fingerprints(named(text), shingle)).join(keyless, fp)
    parts = [by_print.drop(same, f"{fp}_"), unkeyed.select(*by_print.drop(same, f"{fp}_").columns)]
    rest = parts[0].unionByName(parts[1]).dropDuplicates([root]).drop(fp, root)
    return with_key.unionByName(rest)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


__all__ = ["as_hex", "fingerprint", "fingerprints", "links", "near_groups", "representatives"]
