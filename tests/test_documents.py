import json

import pytest
from conftest import cash, plan, rows
from pyspark.sql import functions as F

from stocktake.operators import documents as D
from stocktake.sources import files

SCHEMA = (
    "_id STRING, event_id STRING, event_type STRING, timestamp STRING, "
    "user STRUCT<user_id: STRING, tier: STRING>, device STRUCT<os: STRING, type: STRING>, "
    "items ARRAY<STRUCT<product_id: STRING, qty: INT, price: DOUBLE>>, total_amount DOUBLE, "
    "tags MAP<STRING, STRING>"
)
DOCS = [
    {"_id": "E1", "event_type": "purchase", "user": {"user_id": "U1", "tier": "gold"},
     "device": {"os": "iOS", "type": "phone"}, "total_amount": 90.5, "tags": {"lang": "en"},
     "items": [{"product_id": "P1", "qty": 1, "price": 80.5}, {"product_id": "P2", "qty": 2, "price": 5.0}]},
    {"_id": "E2", "event_type": "purchase", "user": {"user_id": "U2", "tier": "basic"},
     "total_amount": 12.0, "items": [{"product_id": "P3", "price": 12.0}]},
    {"_id": "E3", "event_type": "purchase", "user": {"user_id": "U1", "tier": "gold"}, "items": []},
    {"_id": "", "event_id": "E4", "event_type": "view", "user": {"user_id": "U3"}, "items": []},
    {"event_id": "E5", "user": {"tier": "gold"}, "total_amount": 1.0, "items": [{"product_id": "P1", "qty": 3, "price": 0.1}]},
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("docs") / "docs.json"
    path.write_text("\n".join(json.dumps(d) for d in DOCS))
    return files.read_documents(spark, str(path), SCHEMA)


def test_paths(docs):
    got = rows(docs.select(D.field(docs, "user.tier"), D.field(docs, "tags.lang"),
                           D.field(docs, "user.home.zip"), D.field(docs, "nothing")))
    assert got[0] == ("gold", "en", None, None) and got[3] == (None, None, None, None)


def test_find(docs):
    assert rows(D.find(docs, {"event_type": "purchase", "user.tier": "gold"}), "_id") == [("E1",), ("E3",)]
    assert rows(D.find(docs, {"user.tier": None}), "event_id") == [("E4",)]
    assert D.find(docs).count() == 5
    assert rows(D.find_one(docs, {"user.user_id": "U1"}, ["-_id"]), "_id") == [("E3",)]
    assert rows(D.find_one(docs, {"user.user_id": "U9"}, ["_id"])) == []


def test_group_counts_missing_as_zero(docs):
    got = D.aggregate(docs, [
        {"$match": {"event_type": "purchase"}},
        {"$group": {"_id": "$user.tier", "total": {"$sum": "$total_amount"}, "n": {"$sum": 1},
                    "mean": {"$avg": "$total_amount"}}},
        {"$project": {"tier": "$_id", "total": 1, "n": 1, "mean": 1, "zero": 0, "kind": "report"}}])
    assert sorted(rows(got)) == [("basic", 12.0, 1, 12.0, 0, "report"), ("gold", 90.5, 2, 45.25, 0, "report")]


def test_group_by_constant(docs):
    assert rows(D.group(docs, {"_id": None, "n": {"$sum": 1}})) == [(None, 5)]
    assert rows(D.group(docs.where("false"), {"_id": None, "n": {"$sum": 1}})) == []
    assert rows(D.group(docs.limit(3), {"_id": "$event_type"})) == [("purchase",)]


def test_unknown_stage_or_accumulator_fails(docs):
    with pytest.raises(ValueError):
        D.aggregate(docs, [{"$facet": {}}])
    with pytest.raises(ValueError):
        D.group(docs, {"_id": None, "x": {"$max": "$total_amount"}})


def test_parents_and_children(docs):
    parents = {r.event_id: r for r in D.event_parents(docs).collect()}
    assert set(parents) == {"E1", "E2", "E3", "E4", "E5"}
    assert (parents["E4"].user_tier, parents["E4"].device_os, parents["E4"].total_amount) == ("standard", "unknown", 0.0)
    assert parents["E5"].event_type == "unknown" and parents["E5"].user_id is None
    assert sorted(rows(D.event_children(docs), "item_id", "quantity", "unit_price", "item_subtotal")) == [
        ("E1_item_1", 1, 80.5, 80.5), ("E1_item_2", 2, 5.0, 10.0), ("E2_item_1", 1, 12.0, 12.0),
        ("E5_item_1", 3, 0.1, 0.3)]


def test_nest_is_the_inverse_of_unwind(spark):
    lines = spark.createDataFrame([(o, n, f"p{n}") for o in (1, 2) for n in range(1, 8 if o == 1 else 3)],
                                  "o int, n int, p string")
    for hot_rows in (100, 3):
        whole = D.nest(lines, "o", ["n"], ["n", "p"], "items", hot_rows=hot_rows)
        assert {r.o: [i.n for i in r["items"]] for r in whole.collect()} == {1: list(range(1, 8)), 2: [1, 2]}
        back = D.unwind(whole, "$items").select("o", "items.n", "items.p")
        assert sorted(rows(back)) == sorted(rows(lines))
        flat = D.numbered_children(lines, "o", ["-n"], hot_rows=hot_rows)
        assert sorted(rows(flat, "o", "position", "n"))[:2] == [(1, 0, 7), (1, 1, 6)]


def test_unwind_options(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, None)], "k int, v array<string>")
    spec = {"path": "$v", "includeArrayIndex": "i", "preserveNullAndEmptyArrays": True}
    assert sorted(rows(D.unwind(df, spec), "k", "i", "v"), key=repr) == [
        (1, 0, "a"), (1, 1, "b"), (2, None, None), (3, None, None)]
    assert sorted(rows(D.unwind(df, {"path": "$v"}))) == [(1, "a"), (1, "b")]


@pytest.fixture(scope="module")
def many(spark):
    """One parent with 10,001 matches, one with two, one with none, one without key."""
    parents = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (None, "y")], "k int, kind string")
    children = spark.range(10_001).select(F.lit(1).alias("f"), F.col("id").alias("n")).unionByName(
        spark.createDataFrame([(2, 8), (2, 7), (None, 1)], "f int, n long"))
    join = {"from": children, "localField": "k", "foreignField": "f", "as": "found", "order": ["n"]}
    return parents, {"$lookup": join}


def test_a_parent_counts_once_whatever_it_has(many):
    parents, join = many
    counted = D.aggregate(parents, [join, {"$group": {"_id": "$kind", "n": {"$sum": 1}}}])
    assert sorted(rows(counted)) == [("x", 2), ("y", 2)]
    sizes = D.aggregate(parents, [join, {"$match": {"kind": "x"}}, {"$project": {"k": 1, "n": {"$size": "$found"}}}])
    assert sorted(rows(sizes)) == [(1, 10_001), (2, 2)]
    assert "collect_list" not in plan(counted) + plan(sizes)
    whole = D.aggregate(parents, [join])
    assert whole.columns == ["k", "kind", "found"] and whole.count() == 4
    kept = D.aggregate(parents, [join, {"$project": {"kind": 1, "found": 1, "n": {"$size": "$found"}}}])
    assert sorted(rows(kept, "kind", "n")) == [("x", 2), ("x", 10_001), ("y", 0), ("y", 1)]


def test_lookup_then_unwind_is_a_flat_join(many):
    parents, join = many
    flat = D.aggregate(parents, [join, {"$unwind": "$found"}, {"$group": {"_id": "$kind", "t": {"$sum": "$found.n"}}}])
    assert sorted(rows(flat)) == [("x", 10_000 * 10_001 / 2 + 15.0), ("y", 1.0)]
    assert "collect_list" not in plan(flat)
    spec = {"path": "$found", "includeArrayIndex": "i", "preserveNullAndEmptyArrays": True}
    placed = D.aggregate(parents, [join, {"$unwind": spec}, {"$project": {"k": 1, "i": 1, "n": "$found.n"}}])
    found = rows(placed.where("k is null or k <> 1"))
    assert sorted(found, key=repr) == [(2, 0, 7), (2, 1, 8), (3, None, None), (None, 0, 1)]


def test_lookups_in_a_row(spark, many):
    parents, join = many
    again = {"$lookup": join["$lookup"] | {"as": "twice"}}
    both = D.aggregate(parents, [join, again, {"$project": {"k": 1, "a": {"$size": "$found"}, "b": {"$size": "$twice"}}}])
    assert sorted(rows(both), key=repr) == [(1, 10_001, 10_001), (2, 2, 2), (3, 0, 0), (None, 1, 1)]


def test_lookup(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "b"), (1, "a"), (3, "z"), (None, "n")], "f int, v string")
    got = D.lookup(left, right, "k", "f", "found", ["v"])
    assert {r.k: [m.v for m in r.found] for r in got.collect()} == {1: ["a", "b"], 2: [], None: ["n"]}


def test_ingest(spark):
    docs = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "new"), (None, 3, "x"), (None, 4, "x"), ("b", 5, "y")], "_id string, n int, v string")
    got = D.ingest(docs, "n")
    assert sorted(r.v for r in got.collect()) == ["new", "x", "x", "y"]
    assert got.select("_id").distinct().count() == 4


def test_inserts(spark):
    df = spark.createDataFrame([(1, "O'Hara", None, cash("2.50"), 1.5, True)],
                               "id int, name string, note string, price decimal(5,2), x double, ok boolean")
    assert rows(files.inserts(df, "t")) == [
        ("INSERT INTO t (id, name, note, price, x, ok) VALUES (1, 'O''Hara', NULL, 2.50, 1.5, true);",)]
