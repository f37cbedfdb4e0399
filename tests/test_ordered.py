"""Sliced windows must equal plain windows, whatever the skew."""

import random

import pytest
from conftest import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from stocktake.operators.ordered import (
    dense_rank_by,
    keep_one,
    ntile_of,
    number_rows,
    ordered_groups,
    sliced_groups,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share key 0; a NULL key; NULL values; many ties on t."""
    rng = random.Random(7)
    data = []
    for i in range(900):
        key = 0 if i % 3 == 0 else rng.choice([None, *range(1, 20)])
        value = None if rng.random() < 0.2 else rng.randrange(1000)
        data.append((key, rng.randrange(40), i, value))
    return spark.createDataFrame(data, "k int, t int, id int, v long").repartition(5)


ORDER = ["t", "id"]


def by_key():
    return Window.partitionBy("k").orderBy(*ORDER)


def same(left, right):
    assert sorted(rows(left), key=repr) == sorted(rows(right), key=repr)


@pytest.mark.parametrize("hot_rows", [10_000, 100, 30, 0])
def test_bounded_frames(skewed, hot_rows):
    def build(w):
        return {
            "back2": F.lag("v", 2).over(w),
            "ahead1": F.lead("id", 1).over(w),
            "mean3": F.avg("v").over(w.rowsBetween(-2, 0)),
        }

    got = ordered_groups(skewed, ["k"], ORDER, hot_rows).framed(build, 2, 1).rows()
    same(got, skewed.withColumns(build(by_key())))


@pytest.mark.parametrize("hot_rows", [10_000, 100, 0])
def test_running(skewed, hot_rows):
    w = by_key().rowsBetween(Window.unboundedPreceding, 0)
    got = ordered_groups(skewed, ["k"], ORDER, hot_rows).running(
        {"total": F.col("v"), "n": F.lit(1)}, {"seen": F.col("v")}
    )
    want = skewed.withColumn("total", F.sum("v").over(w)).withColumn("n", F.sum(F.lit(1)).over(w))
    same(got.rows(), want.withColumn("seen", F.last("v", ignorenulls=True).over(w)))


def test_steps_chain(skewed):
    """Filtering between windows: gaps between kept rows, across slices."""
    got = (
        ordered_groups(skewed, ["k"], ORDER, 50)
        .framed(lambda w: {"before": F.lag("t").over(w)}, preceding=1)
        .each(lambda df: df.where("before IS NULL OR before <> t"))
        .framed(lambda w: {"next_t": F.lead("t").over(w)}, following=1)
        .rows()
    )
    want = skewed.withColumn("before", F.lag("t").over(by_key())).where("before IS NULL OR before <> t")
    same(got, want.withColumn("next_t", F.lead("t").over(by_key())))


def test_no_keys(skewed):
    w = Window.orderBy("t", "id")
    got = sliced_groups(skewed, [], ORDER).running({"total": F.col("v")}).rows()
    want = skewed.withColumn("total", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    same(got, want)


def test_global_numbers_and_tiles(skewed):
    w = Window.orderBy(F.col("v").desc_nulls_last(), "id")
    got = number_rows(skewed, ["-v", "id"], "rn", "n")
    for k in (1, 4, 7, 100, 1000):
        got = got.withColumn(f"tile{k}", ntile_of(F.col("rn"), F.col("n"), k))
    want = skewed.withColumn("rn", F.row_number().over(w).cast("long")).withColumn(
        "n", F.lit(900).cast("long")
    )
    for k in (1, 4, 7, 100, 1000):
        want = want.withColumn(f"tile{k}", F.ntile(k).over(w))
    same(got, want)
    assert "SinglePartition" not in plan(got)


def test_numbering_no_rows(skewed):
    assert rows(number_rows(skewed.where("id < 0"), ["id"], "rn", "n")) == []


def test_dense_rank_and_keep_one(skewed):
    want = skewed.withColumn(
        "r", F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_last())).cast("long")
    )
    same(dense_rank_by(skewed, "v", "r"), want)
    first = keep_one(skewed, ["k"], [F.col("t"), F.col("id")])
    assert "WindowGroupLimit" in plan(first)
    same(first, skewed.withColumn("rn", F.row_number().over(by_key())).where("rn = 1").drop("rn"))


def test_hot_group_is_cut(skewed):
    """The hot key's rows end up in several slices, the others in none."""
    groups = ordered_groups(skewed, ["k"], ORDER, 100)
    assert groups.hot.select("k").distinct().count() == 1
    assert groups.hot.select("_slice").distinct().count() > 1
    assert groups.cold.count() + groups.hot.count() == 900
