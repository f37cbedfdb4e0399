"""Ordered (window) computations that stay parallel when one group is huge.

A plain ``Window.partitionBy(key)`` puts a whole group into one task. Here groups
with more rows than a limit, and windows without any key, are range-partitioned by
(keys, order) into slices and staged once. Each slice is computed on its own; what
must cross a slice border is carried over by tables whose size is bounded by the
number of slices and hot keys, never by the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stocktake.session import stage

SLICE = "_slice"

# A group above this many rows is cut into slices.
HOT_ROWS = 4_000_000


def sort_keys(order: list[str]) -> list[Column]:
    """``"a"`` sorts ascending, ``"-a"`` descending; nulls come last either way."""
    return [
        F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last()
        for c in order
    ]


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Equi-join on ``on`` where NULL equals NULL; keeps the left key columns."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = reduce(
        lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on]
    )
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_r_{c}" for c in on])


class OrderedGroups:
    """Rows grouped by ``keys`` and ordered by ``order``, hot groups in slices."""

    def __init__(
        self, keys: list[str], order: list[str], cold: DataFrame | None, hot: DataFrame | None
    ):
        self.keys, self.order, self.cold, self.hot = keys, order, cold, hot

    def each(self, step: Callable[[DataFrame], DataFrame]) -> OrderedGroups:
        """Apply a row-wise step (filter, derived columns) to both parts."""
        return OrderedGroups(
            self.keys,
            self.order,
            None if self.cold is None else step(self.cold),
            None if self.hot is None else step(self.hot),
        )

    def rows(self) -> DataFrame:
        parts = [self.cold, None if self.hot is None else self.hot.drop(SLICE)]
        return reduce(lambda a, b: a.unionByName(b), [p for p in parts if p is not None])

    def framed(
        self,
        build: Callable[[WindowSpec], dict[str, Column]],
        preceding: int = 0,
        following: int = 0,
    ) -> OrderedGroups:
        """Window columns that look at most ``preceding`` rows back and ``following``
        rows ahead (lag, lead, moving averages).

        Slices are widened by copies of the neighbouring border rows, which are
        dropped again after the window has run.
        """
        sorting = sort_keys(self.order)
        cold = self.cold
        if cold is not None:
            cold = cold.withColumns(build(Window.partitionBy(*self.keys).orderBy(*sorting)))
        hot = self.hot
        if hot is not None:
            parts = [hot.withColumn("_copy", F.lit(False))]
            if preceding:
                parts.append(self._border(preceding, back=True))
            if following:
                parts.append(self._border(following, back=False))
            widened = reduce(lambda a, b: a.unionByName(b), parts)
            w = Window.partitionBy(*self.keys, SLICE).orderBy(*sorting)
            hot = widened.withColumns(build(w)).where(~F.col("_copy")).drop("_copy")
        return OrderedGroups(self.keys, self.order, cold, hot)

    def _border(self, reach: int, back: bool) -> DataFrame:
        """Copies of the ``reach`` rows before (or after) every slice of a group.

        Built from the last (first) rows of each slice only: at most ``reach`` rows
        per slice and group.
        """
        forward = sort_keys(self.order)
        flipped = sort_keys([c[1:] if c.startswith("-") else f"-{c}" for c in self.order])
        edge = Window.partitionBy(*self.keys, SLICE).orderBy(*(flipped if back else forward))
        rows = (
            self.hot.withColumn("_edge", F.row_number().over(edge))
            .where(F.col("_edge") <= reach)
            .drop("_edge")
            .withColumn(
                "_at",
                F.row_number().over(Window.partitionBy(*self.keys).orderBy(SLICE, *forward)),
            )
        )
        touch = F.min("_at") if back else F.max("_at")
        slices = rows.groupBy(*self.keys, SLICE).agg(touch.alias("_target"))
        low, high = (F.col("_at") + 1, F.col("_at") + reach) if back else (
            F.col("_at") - reach, F.col("_at") - 1)
        copies = rows.drop(SLICE).withColumn("_target", F.explode(F.sequence(low, high)))
        return (
            null_safe_join(copies, slices, [*self.keys, "_target"], "inner")
            .drop("_at", "_target")
            .withColumn("_copy", F.lit(True))
        )

    def running(
        self, sums: dict[str, Column] | None = None, lasts: dict[str, Column] | None = None
    ) -> OrderedGroups:
        """Columns over all rows up to the current one: running sums, and the last
        non-null value seen (``lasts``)."""
        sums, lasts = sums or {}, lasts or {}
        sorting = sort_keys(self.order)
        reach = (Window.unboundedPreceding, Window.currentRow)

        def over(w: WindowSpec) -> dict[str, Column]:
            w = w.rowsBetween(*reach)
            return {n: F.sum(c).over(w) for n, c in sums.items()} | {
                n: F.last(c, ignorenulls=True).over(w) for n, c in lasts.items()
            }

        cold = self.cold
        if cold is not None:
            cold = cold.withColumns(over(Window.partitionBy(*self.keys).orderBy(*sorting)))
        hot = self.hot
        if hot is not None:
            at = [*self.keys, SLICE]
            place = F.struct(*[F.col(c.lstrip("-")) for c in self.order])
            totals = hot.groupBy(*at).agg(
                *[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()],
                *[
                    F.max_by(c, F.when(c.isNotNull(), place)).alias(f"_t_{n}")
                    for n, c in lasts.items()
                ],
            )
            before = self._before_each_slice(totals, list(sums), list(lasts))
            local = hot.withColumns(
                over(Window.partitionBy(*at).orderBy(*sorting))
            )
            types = local.schema
            hot = null_safe_join(local, F.broadcast(before), at, "left").withColumns(
                {
                    n: F.coalesce(F.col(n) + F.col(f"_b_{n}"), n, f"_b_{n}").cast(
                        types[n].dataType
                    )
                    for n in sums
                }
                | {n: F.coalesce(n, f"_b_{n}") for n in lasts}
            ).drop(*[f"_b_{n}" for n in [*sums, *lasts]])
        return OrderedGroups(self.keys, self.order, cold, hot)

    def _before_each_slice(
        self, totals: DataFrame, sums: list[str], lasts: list[str]
    ) -> DataFrame:
        """What the earlier slices of the same group add up to. One row per slice and
        hot group, so at most (slices + hot groups) rows."""
        w = Window.partitionBy(*self.keys).orderBy(SLICE)
        w = w.rowsBetween(Window.unboundedPreceding, -1)
        return totals.select(
            *self.keys,
            SLICE,
            *[F.sum(f"_t_{n}").over(w).alias(f"_b_{n}") for n in sums],
            *[F.last(f"_t_{n}", ignorenulls=True).over(w).alias(f"_b_{n}") for n in lasts],
        )


def _into_slices(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    ranged = df.repartitionByRange(*[F.col(k).asc_nulls_last() for k in keys], *sort_keys(order))
    return stage(ranged.withColumn(SLICE, F.spark_partition_id()), "slices")


def ordered_groups(
    df: DataFrame, keys: list[str], order: list[str], hot_rows: int | None = None,
    sized_by: DataFrame | None = None,
) -> OrderedGroups:
    """Group ``df``; ``order`` must be unique within a group.

    One counting pass finds the groups above ``hot_rows`` (at most rows / hot_rows of
    them). Without hot groups the result is the plain window plan. ``sized_by`` names
    something cheaper to count that has at least as many rows per key.
    """
    limit = HOT_ROWS if hot_rows is None else hot_rows
    counted = (sized_by or df).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot_keys = counted.where(F.col("_n") > limit).drop("_n")
    if hot_keys.isEmpty():
        return OrderedGroups(keys, order, df, None)
    hot_keys = F.broadcast(stage(hot_keys, "hot-keys"))
    cold = null_safe_join(df, hot_keys, keys, "left_anti")
    hot = null_safe_join(df, hot_keys, keys, "left_semi")
    return OrderedGroups(keys, order, cold, _into_slices(hot, keys, order))


def sliced_groups(df: DataFrame, keys: list[str], order: list[str]) -> OrderedGroups:
    """All groups in slices: for few groups that each hold many rows."""
    return OrderedGroups(keys, order, None, _into_slices(df, keys, order))


def number_rows(df: DataFrame, order: list[str], name: str, total: str | None = None) -> DataFrame:
    """Global 1-based row number (and row count) without a single-partition window.

    ``order`` must be unique. Rows are range-partitioned and sorted once; the number
    is the place in the partition plus the sizes of the partitions before it. Those
    sizes are one row per partition, so they are added up on the driver.
    """
    sorting = sort_keys(order)
    ranged = df.repartitionByRange(*sorting).sortWithinPartitions(*sorting)
    staged = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    staged = staged.withColumn(SLICE, F.shiftright("_at", 33))
    sizes = sorted(tuple(r) for r in staged.groupBy(SLICE).count().collect())
    before, offsets = 0, []
    for piece, size in sizes:
        offsets.append((piece, before))
        before += size
    spark = df.sparkSession
    table = spark.createDataFrame(offsets, f"{SLICE} long, _before long")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = (
        staged.join(F.broadcast(table), SLICE)
        .withColumn(name, F.col("_before") + place + 1)
        .drop("_at", "_before", SLICE)
    )
    return numbered.withColumn(total, F.lit(before).cast("long")) if total else numbered


def ntile_of(position: Column, total: Column, buckets: int) -> Column:
    """``ntile(buckets)`` computed from a row number and the row count."""
    small = F.floor(total / F.lit(buckets)).cast("long")
    extra = total % F.lit(buckets)
    wide = extra * (small + 1)
    return F.when(
        position <= wide, F.floor((position - 1) / (small + 1)) + 1
    ).otherwise(extra + F.floor((position - 1 - wide) / F.nullif(small, F.lit(0))) + 1).cast("int")


def dense_rank_by(df: DataFrame, column: str, name: str, descending: bool = True) -> DataFrame:
    """Global ``dense_rank`` on one column: distinct values are numbered, then joined
    back, so ties of any size need no common task. ``df`` is read twice and staged."""
    df = stage(df, "ranked")
    values = df.select(column).distinct()
    ranked = number_rows(values, [f"-{column}" if descending else column], name)
    return null_safe_join(df, ranked, [column], "left")


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order. The row limit is applied before the
    shuffle too, so at most one row per key and input task is moved."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
