"""Stored tables in versions: appended batches, summaries by differences, dimensions in buckets."""

import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.operators.warehouse import scd2_history
from stocktake.sources import versions as V
from stocktake.streaming import streams as X

FEED = "id long, city string, tier string, day date, seq long"


def changes(draw, days, ids, n):
    start = dt.date(2024, 1, 1)
    found = [
        (draw.choice(ids), draw.choice("ABC"), draw.choice("xy"), start + dt.timedelta(days=draw.choice(days)))
        for _ in range(n)
    ]
    return sorted(found, key=lambda r: r[3])


@pytest.mark.parametrize("seed", range(2))
def test_dimension_in_buckets_equals_a_rebuild(spark, tmp_path, monkeypatch, seed):
    """Batches cut within days, so that versions are replaced and ended ones go on again; two
    tracked columns; few folders before ended versions are merged."""
    monkeypatch.setattr(X, "MOST_FOLDERS", 2)
    draw, root, seq, sent = random.Random(seed), str(tmp_path / "dim"), 0, []
    for batch, days in enumerate(([1, 2], [2, 3], [3], [3, 4])):
        part = changes(draw, days, range(12), 20)
        part = [(*r, seq + i) for i, r in enumerate(part)]
        seq, sent = seq + len(part), sent + part
        X.merge_changes(root, spark.createDataFrame(part, FEED), "id", ["city", "tier"], "day", "seq", "sk", "s", batch, 4)
    schema = X.versions_schema(spark.createDataFrame(sent, FEED), "id", "day", "seq", "sk")
    dim = X.read_dimension(spark, root, schema, "id")
    want = scd2_history(spark.createDataFrame(sent, FEED), "id", ["city", "tier"], "day", "seq")
    columns = ["id", "city", "tier", "effective_date", "end_date", "is_current"]
    assert sorted(rows(dim, *columns)) == sorted(rows(want, *columns))
    keys = [r[0] for r in rows(dim, "sk")]
    assert len(set(keys)) == len(keys)


def test_few_keys_write_few_buckets_and_ended_versions_are_added(spark, tmp_path):
    root, day = str(tmp_path / "dim"), dt.date(2024, 1, 1)

    def batch(number, ids, city):
        feed = [(i, city, "x", day + dt.timedelta(days=number), number * 1000 + i) for i in ids]
        return X.merge_changes(root, spark.createDataFrame(feed, FEED), "id", ["city"], "day", "seq", "sk", "s", number, 32)

    batch(0, range(500), "A")
    before = {(e.kind, e.part): e.value for e in V.Manifest(spark, root).entries}
    touched = batch(1, range(10), "B")
    after = V.Manifest(spark, root)
    changed = {e.part for e in after.of("open") if before[e.kind, e.part] != e.value}
    assert len(touched) <= 10 and changed == {str(b) for b in touched}
    ended = after.of("closed")
    batch(2, range(3), "C")
    assert set(ended) < set(V.Manifest(spark, root).of("closed"))
    assert batch(2, range(3), "D") == []  # the same batch again
    schema = X.versions_schema(spark.createDataFrame([], FEED), "id", "day", "seq", "sk")
    dim = X.read_dimension(spark, root, schema, "id")
    assert rows(dim.where("is_current").groupBy("city").count().orderBy("city")) == [("A", 490), ("B", 7), ("C", 3)]
    assert dim.where("NOT is_current").count() == 13


SALES = T.StructType().add("id", "long").add("month", "string").add("amount", "decimal(12,2)")


def test_a_batch_is_appended_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "facts")
    monkeypatch.setattr(V, "MOST_FOLDERS", 2)

    def load(batch):
        data = [(batch * 10 + i, f"2024-0{i + 1}", None) for i in range(3)]
        return V.append_batch(spark.createDataFrame(data, SALES), root, "month", f"b{batch}")

    assert V.read_appended(spark, root, SALES).count() == 0
    assert [load(b) for b in (0, 1, 0, 1, 2, 3, 0)] == [True, True, False, False, True, True, False]
    found = V.read_appended(spark, root, SALES)
    assert found.columns == SALES.names
    assert sorted(r[0] for r in rows(found, "id")) == [b * 10 + i for b in range(4) for i in range(3)]
    assert len(V.Manifest(spark, root).of("rows")) <= 2


def test_a_load_that_fails_leaves_the_table(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "facts")
    data = spark.createDataFrame([(1, "2024-01", None)], SALES)
    V.append_batch(data, root, "month", "a")
    with monkeypatch.context() as broken:
        broken.setattr(V.Manifest, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):  # the files are written, the manifest is not
            V.append_batch(data, root, "month", "b")
    assert V.read_appended(spark, root, SALES).count() == 1
    assert V.append_batch(data, root, "month", "b")
    assert V.read_appended(spark, root, SALES).count() == 2


def test_two_writers_cannot_make_one_version(spark, tmp_path):
    one, two = (V.Manifest(spark, str(tmp_path)) for _ in range(2))
    one.commit([V.Entry("rows", "", "a")])
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        two.commit([V.Entry("rows", "", "b")])


LINES = "month string, region string, customer long, amount decimal(12,2), rows long"


def test_summary_by_differences_equals_a_recompute(spark, tmp_path, monkeypatch):
    draw = random.Random(5)
    summary = V.Summary(str(tmp_path / "s"), ("month", "region"), "month", "customer", ("amount",))

    def order():
        month = draw.choice(["2024-01", "2024-02", "2024-03", None])
        return (month, draw.choice(["N", "S"]), draw.randint(1, 6), dt_cash(draw.randint(1, 9)), 1)

    live = [order() for _ in range(60)]

    def frame(data):
        return spark.createDataFrame(data, LINES)

    def check():
        got = summary.read(spark, frame([]).schema, "customers")
        want = frame(live).groupBy("month", "region").agg(
            F.sum("rows").alias("rows"), F.countDistinct("customer").alias("customers"), F.sum("amount").alias("amount"))
        assert sorted(map(repr, rows(got))) == sorted(map(repr, rows(want)))

    assert set(summary.refresh(frame(live))) == {"2024-01", "2024-02", "2024-03", ""}
    check()
    gone, changed = live[:8], live[8:16]  # deleted ones, and ones that change, also their month
    new = [order() for _ in changed] + [order()]
    summary.refresh(frame(new), frame(gone + changed))
    live = live[16:] + new
    check()
    with monkeypatch.context() as broken:
        broken.setattr(V.Manifest, "commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            summary.refresh(frame([order()]))
    check()
    kept = [e for e in V.Manifest(spark, summary.root).of("rows") if e.part == "2024-03"]
    late = ("2024-01", "N", 99, dt_cash(5), 1)
    assert summary.refresh(frame([late])) == ["2024-01"]
    assert [e for e in V.Manifest(spark, summary.root).of("rows") if e.part == "2024-03"] == kept
    live.append(late)
    check()
    summary.refresh(frame([]), frame([r for r in live if r[0] == "2024-02"]))  # a month without rows
    live = [r for r in live if r[0] != "2024-02"]
    check()


def dt_cash(n):
    from decimal import Decimal

    return Decimal(n)
