"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected in the mix ``target / source_size`` times. Documents
are laid out by size within their source; the expected copies are summed along that order
from one random offset, and a document is emitted once per whole number that the sum passes.
Since neighbours have nearly equal sizes, the words taken from a source differ from its
target by no more than its largest document; no document is taken more than ``ceil`` of its
expected copies, so never more often than the largest repetition allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from stocktake.llm.shared import WORD, fresh, named, whole
from stocktake.session import stage

REPEATS = 3  # a source gives at most so many times its size
WEIGHTS = (1, 2, 3)
SEED = "mix"


def words(column: str = "text") -> Column:
    """Words between the white space of the contract; none for null."""
    return F.regexp_count(whole(column), F.lit(WORD)).cast("long")


def shares(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Targets of the sources, given one row per source: source, source_size, rows.

    Weights are dealt in the order of the names' code points, null last, and repeat. The
    targets share the sum of all sizes; a target above ``repeats`` times its source's size
    stops there, and the excess is shared among the others by weight until none is above.
    In the order of ``repeats * source_size / weight`` the sources that stop are the first
    ones: those whose bound is under what the rest would get for their weight.
    """
    by_name = W.Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    full = (F.col("source_size") * repeats).cast("double")
    order = W.Window.orderBy((F.col("bound") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    ahead = order.rowsBetween(W.Window.unboundedPreceding, -1)
    onward = order.rowsBetween(W.Window.currentRow, W.Window.unboundedFollowing)
    everything = W.Window.partitionBy()
    total = F.sum("source_size").over(everything)
    sized = sizes.withColumn("weight", weight).withColumn("bound", full)
    # What one unit of weight gets if all sources before this one stop.
    rate = (total - F.coalesce(F.sum("bound").over(ahead), F.lit(0.0))) / F.sum("weight").over(onward)
    rated = sized.withColumn("rate", rate)
    level = F.min(F.when(F.col("bound") >= F.col("rate") * F.col("weight"), F.col("place"))).over(everything)
    placed = rated.withColumn("place", F.row_number().over(order)).withColumn("level", level)
    common = F.max(F.when(F.col("place") == F.col("level"), F.col("rate"))).over(everything)
    target = F.when(F.col("place") >= F.col("level"), F.col("common") * F.col("weight"))
    return placed.withColumn("common", common).select(
        "source", "source_size", F.coalesce(target, F.col("bound")).alias("target")
    )


def offset(source: Column, seed: str = SEED) -> Column:
    """A number from 0 to 1 that a seed gives a source: 52 bits of a digest."""
    text = F.concat_ws(":", F.lit(seed), F.coalesce(source, F.lit("\u0000")))
    digits = F.substring(F.md5(text), 1, 13)
    return F.conv(digits, 16, 10).cast("long") / F.lit(float(1 << 52))


def mix(
    df: DataFrame,
    source: str = "source",
    key: str = "doc_id",
    size: Column | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    seed: str = SEED,
) -> DataFrame:
    """``df`` as one column ``doc`` (a struct of all columns, so that no name can clash), with
    size, source_size, target and copies (0 for a row that the mix leaves out).

    The rank of a row within its source comes from a range partition of all rows by source,
    size and key, so a source that holds most rows lies in many partitions. The laid-out rows
    are staged; counts per partition and source then place each row by its position.

    A null source is a source of its own, last in order. A null text has size 0 and can be
    taken, adding no words; a source without words has target 0 and gives nothing. Rows with
    equal source, size and key are interchangeable in the result; repeated rows count as
    rows. An empty table gives none.
    """
    laid = (
        df.select(
            F.struct(*[named(c).alias(c) for c in df.columns]).alias("doc"),
            named(source).cast("string").alias("source"),
            named(key).alias("key"),
            (words() if size is None else size).alias("size"),
        )
        .repartitionByRange("source", "size", "key")
        .sortWithinPartitions("source", "size", "key")
        .withColumn("at", F.monotonically_increasing_id())
    )
    laid = stage(laid, "mix")
    # Positions within a partition are the low 33 bits of ``at``.
    part = F.shiftright("at", 33).alias("part")
    runs = (
        laid.groupBy(part, "source")
        .agg(F.min("at").alias("first"), F.count("*").alias("n"), F.sum("size").alias("words"))
    )
    before = (
        W.Window.partitionBy("source").orderBy("part").rowsBetween(W.Window.unboundedPreceding, -1)
    )
    runs = stage(runs, "mix-runs")  # a row per partition and source in it
    targets = shares(runs.groupBy("source").agg(F.sum("words").alias("source_size")), weights, repeats)
    places = runs.select(
        "source", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")
    ).alias("r")
    same = F.col("r.source").eqNullSafe(F.col("t.source"))
    places = places.join(targets.alias("t"), same).select(
        F.col("r.source").alias("run_source"), F.col("part").alias("run_part"),
        "first", "ahead", "source_size", "target",
    )
    # Staged, its size is known, so that Spark's own limit decides whether it is broadcast.
    places = stage(places, "mix-places")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rank = F.col("at") - F.col("first") + F.col("ahead")
    begin = offset(F.col("source"), seed)
    copies = F.floor((rank + 1) * rate + begin) - F.floor(rank * rate + begin)
    return (
        laid.join(
            places,
            (part == F.col("run_part")) & F.col("source").eqNullSafe(F.col("run_source")),
        )
        .select("doc", "size", "source_size", "target", copies.cast("int").alias("copies"))
    )


def emitted(mixed: DataFrame) -> DataFrame:
    """The rows of the mix themselves, each as often as it is taken."""
    again = fresh("again")
    taken = mixed.where("copies > 0").withColumn(again, F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return taken.select("doc.*")
