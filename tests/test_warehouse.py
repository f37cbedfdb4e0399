import datetime as dt
import random

import pytest
from conftest import day, plan, rows
from pyspark.sql import functions as F

from stocktake.operators import warehouse as W
from stocktake.sources.tables import schema_of

END = day("9999-12-31")
TRACKED = ["city", "tier"]


def feed(spark, data):
    return spark.createDataFrame(
        [(k, c, t, day(d), s, e) for s, (k, c, t, d, e) in enumerate(data)],
        "id string, city string, tier string, day date, seq long, email string",
    )


def replay(data):
    """One change at a time, the plain way; the last change of a day counts."""
    last = {}
    for k, c, t, d, e in data:
        last[(k, d)] = (k, c, t, d, e)
    versions = {}
    for k, c, t, d, e in sorted(last.values(), key=lambda r: r[3]):
        known = versions.setdefault(k, [])
        if known and known[-1][1:3] == [c, t]:
            continue
        if known:
            known[-1][4] = d
        known.append([k, c, t, d, None])
    return sorted(
        ((k, c, t, day(d), day(e) if e else END, e is None)
         for v in versions.values() for k, c, t, d, e in v), key=repr)


def random_changes(n=600):
    rng = random.Random(3)
    start = dt.date(2024, 1, 1)
    return [
        ("hot" if i % 3 == 0 else f"c{rng.randrange(15)}", rng.choice(["X", "Y", None]),
         rng.choice(["a", "b"]), str(start + dt.timedelta(days=rng.randrange(250))), f"m{i}")
        for i in range(n)
    ]


COLUMNS = ["id", "city", "tier", "effective_date", "end_date", "is_current"]


@pytest.mark.parametrize("hot_rows", [10_000, 60])
def test_history_equals_replay(spark, hot_rows):
    data = random_changes()
    got = W.scd2_history(feed(spark, data), "id", TRACKED, "day", "seq", hot_rows)
    assert sorted(rows(got, *COLUMNS), key=repr) == replay(data)


def test_going_back_opens_a_version(spark):
    data = [("k", "A", "x", "2024-01-01", ""), ("k", "B", "x", "2024-02-01", ""),
            ("k", "A", "x", "2024-03-01", ""), ("k", "A", "x", "2024-04-01", "new mail")]
    got = sorted(rows(W.scd2_history(feed(spark, data), "id", TRACKED, "day", "seq"), "city",
                      "effective_date", "end_date"), key=repr)
    assert got == [
        ("A", day("2024-01-01"), day("2024-02-01")), ("A", day("2024-03-01"), END),
        ("B", day("2024-02-01"), day("2024-03-01"))]


@pytest.mark.parametrize("hot_rows", [10_000, 25])
def test_merge_in_batches_equals_replay(spark, hot_rows):
    data = sorted(random_changes(), key=lambda r: r[3])
    third = len(data) // 3
    cut1, cut2 = data[third][3], data[2 * third][3]
    batches = [
        [r for r in data if r[3] < cut1], [r for r in data if cut1 <= r[3] < cut2],
        [r for r in data if r[3] >= cut2]]
    dim = W.with_surrogate_keys(
        W.scd2_history(feed(spark, batches[0]), "id", TRACKED, "day", "seq"),
        ["effective_date", "id"], "sk")
    for batch in batches[1:]:
        dim = W.scd2_merge(
            dim, feed(spark, batch), "id", TRACKED, "day", "seq", "sk", hot_rows=hot_rows)
    assert sorted(rows(dim, *COLUMNS), key=repr) == replay(data)
    keys = sorted(r[0] for r in rows(dim, "sk"))
    assert keys == list(range(1, len(keys) + 1))


@pytest.mark.parametrize("hot_rows", [10_000, 50])
def test_merge_with_batch_borders_inside_a_day(spark, hot_rows):
    data = sorted(random_changes(), key=lambda r: r[3])
    size = len(data) // 3 + 1
    batches = [data[i:i + size] for i in range(0, len(data), size)]
    assert batches[0][-1][3] == batches[1][0][3] or batches[1][-1][3] == batches[2][0][3]
    dim = W.with_surrogate_keys(
        W.scd2_history(feed(spark, batches[0]), "id", TRACKED, "day", "seq"),
        ["effective_date", "id"], "sk")
    for batch in batches[1:]:
        dim = W.scd2_merge(
            dim, feed(spark, batch), "id", TRACKED, "day", "seq", "sk", hot_rows=hot_rows)
    got = sorted(rows(dim, *COLUMNS), key=repr)
    assert got == replay(data)
    assert dim.where("effective_date >= end_date").count() == 0
    assert dim.select("sk").distinct().count() == len(got)


def test_second_change_of_a_day(spark):
    """Replaces the version of that day under its key; back to the old values, the version
    before goes on."""
    dim = W.with_surrogate_keys(
        W.scd2_history(feed(spark, [
            ("a", "Rome", "plain", "2024-01-01", ""), ("a", "Oslo", "plain", "2024-02-01", ""),
            ("b", "Rome", "plain", "2024-01-01", ""), ("b", "Oslo", "plain", "2024-02-01", ""),
            ("c", "Rome", "plain", "2024-02-01", "")]), "id", TRACKED, "day", "seq"),
        ["effective_date", "id"], "sk")
    before = {(r.id, r.effective_date): r.sk for r in dim.collect()}
    later = feed(spark, [("a", "Bonn", "plain", "2024-02-01", ""), ("b", "Rome", "plain", "2024-02-01", ""),
                                  ("c", "Rome", "plain", "2024-02-01", "")])
    got = W.scd2_merge(dim, later, "id", TRACKED, "day", "seq", "sk")
    first, second = day("2024-01-01"), day("2024-02-01")
    assert sorted(rows(got, "id", "city", "effective_date", "end_date", "sk")) == [
        ("a", "Bonn", second, END, before["a", second]), ("a", "Rome", first, second, before["a", first]),
        ("b", "Rome", first, END, before["b", first]), ("c", "Rome", second, END, before["c", second])]


@pytest.fixture(scope="module")
def walkthrough(spark):
    first = feed(spark, [("C1", "Rome", "plain", "2024-01-01", "a"), ("C2", "Oslo", "plain", "2024-01-01", "b")])
    dim = W.with_surrogate_keys(
        W.scd2_history(first, "id", TRACKED, "day", "seq"), ["effective_date", "id"], "sk")
    return dim, feed(spark, [("C1", "Oslo", "vip", "2024-06-01", "a")])


def test_walkthrough(spark, walkthrough):
    dim, change = walkthrough
    merged = W.scd2_merge(dim, change, "id", TRACKED, "day", "seq", "sk")
    assert sorted(rows(merged, "sk", "id", "city", "effective_date", "end_date", "is_current")) == [
        (1, "C1", "Rome", day("2024-01-01"), day("2024-06-01"), False),
        (2, "C2", "Oslo", day("2024-01-01"), END, True),
        (3, "C1", "Oslo", day("2024-06-01"), END, True)]
    asked = spark.createDataFrame(
        [("C1", day(d)) for d in ("2024-01-15", "2024-06-01", "2024-07-15", "2023-12-31")],
        "id string, at date")
    got = W.point_in_time(asked, merged, "id", "at", ["sk"])
    assert dict(rows(got, "at", "sk")) == {
        day("2024-01-15"): 1, day("2024-06-01"): 3, day("2024-07-15"): 3, day("2023-12-31"): None}


def test_statuses(spark, walkthrough):
    dim, _ = walkthrough
    batch = feed(spark, [("C1", "Rome", "vip", "2024-05-01", ""), ("C2", "Oslo", "plain", "2024-05-01", "x"),
                         ("C3", "Bonn", "plain", "2024-05-01", ""), ("C2", "Bonn", "plain", "2023-05-01", "")])
    got = W.scd2_statuses(dim, batch, "id", TRACKED, "day", "seq")
    assert sorted(rows(got)) == [
        ("C1", day("2024-05-01"), "UPDATED_SCD2"), ("C2", day("2023-05-01"), "REJECTED_LATE"),
        ("C2", day("2024-05-01"), "NO_CHANGE"), ("C3", day("2024-05-01"), "INSERTED_NEW")]


@pytest.mark.parametrize("hot_rows", [10_000, 50])
def test_point_in_time_equals_range_join(spark, hot_rows):
    data = random_changes()
    dim = W.scd2_history(feed(spark, data), "id", TRACKED, "day", "seq").withColumn("sk", F.xxhash64("id", "effective_date"))
    rng = random.Random(5)
    asked = spark.createDataFrame(
        [("hot" if i % 2 else f"c{rng.randrange(17)}", dt.date(2023, 12, 20) + dt.timedelta(days=rng.randrange(300)), i)
         for i in range(400)], "id string, at date, n int")
    got = W.point_in_time(asked, dim, "id", "at", ["sk", "city"], hot_rows)
    assert "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    d = dim.select(F.col("id").alias("k"), "effective_date", "end_date", "sk", "city")
    want = asked.join(
        d, (F.col("id") == F.col("k")) & (F.col("at") >= F.col("effective_date")) & (F.col("at") < F.col("end_date")), "left")
    assert sorted(rows(got, "n", "id", "at", "sk", "city"), key=repr) == sorted(
        rows(want, "n", "id", "at", "sk", "city"), key=repr)


def test_overwrite_retain_previous(spark):
    dim = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z")], "id string, v string")
    new = spark.createDataFrame([("a", "X"), ("b", None), ("d", "w")], "id string, v string")
    assert sorted(rows(W.scd0_merge(dim, new, "id"))) == [("a", "x"), ("b", "y"), ("c", "z"), ("d", "w")]
    assert sorted(rows(W.scd1_merge(dim, new, "id"))) == [("a", "X"), ("b", "y"), ("c", "z"), ("d", "w")]
    third = W.scd3_merge(dim, new, "id", "v")
    assert sorted(rows(third), key=repr) == [("a", "X", "x"), ("b", "y", None), ("c", "z", None), ("d", "w", None)]
    again = W.scd3_merge(third, spark.createDataFrame([("a", "X")], "id string, v string"), "id", "v")
    assert ("a", "X", "x") in rows(again)


def test_date_dimension(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-01', DATE'2024-12-31')) AS date")
    dim = W.date_dimension(days)
    assert dim.count() == 366
    assert [f.name for f in dim.schema] == schema_of("dim_date").names
    leap = dim.where("date_key = 20240229").first()
    assert (leap.day_name, leap.day_of_week, leap.quarter, leap.month_name, leap.is_weekend) == (
        "Thursday", 4, 1, "February", False)
    assert dim.where("is_weekend").count() == 104
    fiscal = W.date_dimension(days, fiscal_start_month=4)
    assert rows(fiscal.where("date_key IN (20240101, 20240401)").orderBy("date_key"), "fiscal_quarter") == [("Q4",), ("Q1",)]


def test_month_end_snapshot(spark):
    versions = spark.createDataFrame(
        [("a", day("2024-01-31"), day("2024-03-31")), ("a", day("2024-03-31"), END),
         ("b", day("2024-02-02"), day("2024-02-20"))], "id string, effective_date date, end_date date")
    got = W.month_end_snapshot(versions, F.lit(day("2024-04-30")))
    assert sorted(rows(got, "id", "month_end", "effective_date")) == [
        ("a", day("2024-01-31"), day("2024-01-31")), ("a", day("2024-02-29"), day("2024-01-31")),
        ("a", day("2024-03-31"), day("2024-03-31")), ("a", day("2024-04-30"), day("2024-03-31"))]


def test_junk_dimension(spark):
    facts = spark.createDataFrame([(True, "x"), (True, "x"), (False, "y"), (True, "y")], "gift boolean, pay string")
    got = W.junk_dimension(facts, ["gift", "pay"], "junk_key")
    assert sorted(rows(got, "junk_key", "gift", "pay")) == [(1, False, "y"), (2, True, "x"), (3, True, "y")]


def test_a_large_batch_is_joined_and_sorted_once(spark, monkeypatch):
    """Many changed keys are not broadcast; the branches of the result read what was staged."""
    monkeypatch.setattr(W, "broadcast_if_few", lambda side, counted=None, limit=0: side)
    data = random_changes(200)
    changes = feed(spark, data).drop("email")
    early, late = (changes.where(c) for c in ("day < '2024-05-01'", "day >= '2024-05-01'"))
    dim = W.scd2_history(early, "id", TRACKED, "day", "seq")
    statuses = W.scd2_statuses(dim, late, "id", TRACKED, "day", "seq")
    last = {(k, d) for k, _, _, d, _ in data if d >= "2024-05-01"}
    assert sorted((k, str(d)) for k, d in rows(statuses, "id", "day")) == sorted(last)
    assert "SortMergeJoin" not in plan(statuses)
