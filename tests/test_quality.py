import csv
import datetime as dt
import random
import statistics

import pyarrow.parquet as pq
import pytest
from conftest import cash, day, plan, rows
from pyspark.sql import functions as F

from stocktake.functions.scalar import is_missing
from stocktake.operators import quality as Q
from stocktake.sources import files, tables

CSV = "﻿id,customer,units,price,day\n" + "\n".join([
    "1, C1 ,2,10.50,2024-01-01",
    "2,C2,null,20,2024-01-02",
    "3,,3,-,2024-01-03",
    "4,C4,1.5,30.25,N/A",
    "5,C5,x,1e3,2024-01-05",
    "6,C6,4,5d,2024-01-06",
    "7,C7,5,40.0,2024-01-07",
    "7,C7,5,40.0,2024-01-07",
]) + "\n"
SCHEMA = files.parse_schema("units:int, price: float,oddity")


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "sales.csv"
    path.write_text(CSV, encoding="utf-8")
    return files.read_csv_numbered(spark, str(path)).drop(files.CORRUPT)


def test_schema_string():
    assert SCHEMA == {"units": "int", "price": "float"}
    assert files.parse_schema("") == {} and files.parse_schema(None) == {}


def test_read_trims_skips_bom_and_numbers(raw):
    assert raw.columns == ["id", "customer", "units", "price", "day", "row_no"]
    assert rows(raw.where("row_no = 1"), "id", "customer") == [("1", "C1")]
    assert sorted(r[0] for r in rows(raw, "row_no")) == list(range(1, 9))


def test_ragged_rows_are_kept(spark, tmp_path):
    (tmp_path / "r.csv").write_text("a,b\n1,2\n3\n4,5,6\n")
    got = files.read_csv(spark, str(tmp_path))
    assert {r.a: (r.b, r[files.CORRUPT] is None) for r in got.collect()} == {
        "1": ("2", True), "3": ("", False), "4": ("5", False)}


ODD = ['TV 55" wide', 'say "hi", ok', "back\\slash", "one\ntwo", "plain", '"', "a;b"]


def test_quoted_fields_from_another_writer(spark, tmp_path):
    with open(tmp_path / "in.csv", "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(["n", "v.w"])
        writer.writerows([[n, f"\t{v} \u00a0"] for n, v in enumerate(ODD)])
    got = files.read_csv(spark, str(tmp_path / "in.csv"), multiline=True)
    found = got.collect()
    assert {int(r.n): r["v.w"] for r in found} == dict(enumerate(ODD))
    assert {r[files.CORRUPT] for r in found} == {None}


def test_quoted_fields_for_another_reader(spark, tmp_path):
    values = [*ODD, "  kept  "]
    files.export_csv(spark.createDataFrame(list(enumerate(values)), "n int, v string"), str(tmp_path / "out"))
    found = {}
    for part in (tmp_path / "out").glob("part-*"):
        with open(part, newline="") as lines:
            found |= {int(r["n"]): r["v"] for r in csv.DictReader(lines)}
    assert found == dict(enumerate(values))


def test_blanks_of_any_kind_are_missing(spark):
    df = spark.createDataFrame([("\tnull ",), ("\u2003",), ("x",)], "v string")
    assert rows(df.select(is_missing(F.col("v")))) == [(True,), (True,), (False,)]


def test_file_order_numbers_over_many_files(spark, tmp_path):
    for part in range(5):
        (tmp_path / f"part-{part}.csv").write_text("v\n" + "\n".join(str(part * 10 + i) for i in range(1, 11 - part)) + "\n")
    got = files.read_csv_numbered(spark, str(tmp_path), ["v"])
    values = [int(v) for _, v in sorted(rows(got, "row_no", "v"))]
    assert values == sorted(values) and len(values) == 40


def test_null_profile_and_gate(raw):
    profile = Q.null_profile(raw.drop("row_no"), 0.1)
    found = {r.column: (r.nulls, r.warn) for r in profile.collect()}
    assert found == {"id": (0, False), "customer": (1, True), "units": (1, True), "price": (1, True), "day": (1, True)}
    strict = Q.null_profile(raw.drop("row_no"), 0.125)  # strictly above
    assert not any(r.warn for r in strict.collect())
    assert rows(Q.required_gate(profile, ["customer", "day", "other"])) == [(8, ["customer", "day"], False)]
    assert rows(Q.required_gate(profile, ["id"]), "is_valid") == [(True,)]
    empty = Q.null_profile(raw.drop("row_no").limit(0))
    assert rows(Q.required_gate(empty, []), "is_valid") == [(False,)]


def test_duplicates(raw):
    content = raw.drop("row_no")
    assert rows(Q.duplicate_summary(content)) == [(8, 7, 1)]
    assert Q.drop_exact_duplicates(content).count() == 7
    assert sorted(r[0] for r in rows(Q.drop_exact_duplicates(raw, "row_no"), "row_no")) == [1, 2, 3, 4, 5, 6, 7]


def test_type_errors(raw):
    got = sorted(rows(Q.type_errors(raw, SCHEMA, "row_no")))
    assert got == [(2, "units", "null", "int"), (3, "price", "-", "float"), (4, "units", "1.5", "int"),
                   (5, "units", "x", "int"), (6, "price", "5d", "float")]
    assert rows(Q.type_errors(raw, {}, "row_no")) == []


def test_cast_keeps_rejects(raw):
    got = {r.row_no: r for r in Q.cast_with_rejects(raw, SCHEMA).collect()}
    assert (got[1].units, got[1].price, got[1]._rejects) == (2, 10.5, {})
    assert (got[2].units, got[2]._rejects) == (None, {})
    assert (got[4].units, got[4]._rejects) == (None, {"units": "1.5"})
    assert (got[5].price, got[6]._rejects, got[3]._rejects) == (1000.0, {"price": "5d"}, {"price": "-"})


def test_split_required(raw):
    valid, broken = Q.split_required(raw, ["customer", "day", "absent"])
    assert sorted(r[0] for r in rows(broken, "row_no")) == [3, 4]
    assert valid.count() == 6


def test_column_stats_match_the_statistics_module(spark):
    values = [3.5, 1.0, 9.0, 1.0, 1.0, 2.0, 1000.0, 2.0, 2.5, 3.0, 1.0, 2.0, 2.0]
    df = spark.createDataFrame([(i, str(v), "7" if i == 0 else "") for i, v in enumerate(values)], "n int, v string, one string")
    stats = Q.column_stats(df, ["v", "one", "n"]).collect()
    got = {r.column: r for r in stats}
    assert got["v"]["count"] == 13 and got["v"].median == statistics.median(values)
    assert got["v"].mean == pytest.approx(statistics.mean(values))
    assert got["v"].std_dev == pytest.approx(statistics.stdev(values))
    assert (got["one"]["count"], got["one"].std_dev, got["one"].median) == (1, 0.0, 7.0)
    even = spark.createDataFrame([(float(v),) for v in (4, 1, 3, 2)], "v double")
    assert Q.column_stats(even, ["v"]).first().median == 2.5
    none = spark.createDataFrame([("x",)], "v string")
    assert rows(Q.column_stats(none, ["v"]), "count", "mean", "median") == [(0, 0.0, 0.0)]
    assert rows(Q.outliers(df, ["v"], "n", Q.column_stats(df, ["v"]))) == [("v", 6, 1000.0)]


def test_rules_and_references(spark):
    df = spark.createDataFrame([(1, "a"), (None, "bb"), (-1, "c")], "q int, s string")
    got = dict(rows(Q.rule_violations(df, {"q > 0": F.col("q") > 0, "short": F.length("s") <= 1, "set": F.col("q").isNotNull()})))
    assert got == {"q > 0": 1, "short": 1, "set": 1}
    child = spark.createDataFrame([(1,), (5,), (None,)], "ref int")
    parent = spark.createDataFrame([(1,)], "id int")
    found = Q.orphans(child, "ref", parent, "id")
    assert rows(found) == [(5,)] and "LeftAnti" in plan(found)
    assert rows(Q.key_violations(child.union(child), ["ref"]).where("ref = 1")) == [(1, 2)]


def test_header_line_gaps(shop):
    got = sorted(rows(Q.header_line_gaps(shop.orders, shop.items, "order_id", "amount", "line_total"), "order_id", "gap"))
    assert got == [(5, cash("50.00")), (6, cash("999.00")), (8, cash("10.00"))]


def test_cleaning(raw):
    run = Q.Cleaning(raw, SCHEMA, "row_no", ("customer", "day"), ("price",))
    assert rows(run.summary) == [(8, 1, 2, 5, cash("62.5"))]
    assert run.rows.count() == 5 and run.quarantine.count() == 2
    assert rows(run.gate, "is_valid") == [(False,)]
    assert sorted(rows(run.recommendations, "finding")) == [("duplicates",)]
    fine = Q.Cleaning(raw.where("row_no IN (1, 7)"), SCHEMA, "row_no")
    assert rows(fine.recommendations, "finding") == [("no major issues",)]


def test_export_roundtrip(spark, raw, tmp_path):
    clean = Q.cast_with_rejects(raw, SCHEMA).drop("_rejects")
    out = str(tmp_path / "out")
    assert files.export_csv(clean.select("id", "units", "price"), out)
    back = {r.id: (r.units, r.price) for r in files.read_csv(spark, out).collect()}
    assert back["2"] == ("", "20.0") and back["1"] == ("2", "10.5") and back["4"] == ("", "30.25")
    assert not files.export_csv(clean.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_summary_refresh_replaces_only_its_partitions(spark, tmp_path):
    def make(data):
        return spark.createDataFrame([(day(m), v) for m, v in data], "month date, v int")

    path = str(tmp_path / "mv")
    files.store_summary(make([("2024-01-01", 1), ("2024-02-01", 2)]), path, "month")
    got = files.refresh_summary(make([("2024-02-01", 20), ("2024-03-01", 30)]), path, "month")
    assert sorted(rows(got)) == [(day("2024-01-01"), 1), (day("2024-02-01"), 20), (day("2024-03-01"), 30)]
    again = files.store_summary(make([("2024-05-01", 5)]), path, "month")
    assert rows(again) == [(day("2024-05-01"), 5)]


def test_typed_table_defaults(spark):
    raw = spark.createDataFrame([("1", "2", "9.999", None)], "id string, customer_id string, total_amount string, status string")
    typed = tables.apply_table(raw, tables.schema_of("orders"), tables.STORE_DEFAULTS["orders"])
    row = typed.first()
    assert (row.id, row.status, row.total_amount, row.payment_method) == (1, "pending", cash("10.00"), None)
    assert row.order_date is not None
    assert [f.dataType for f in typed.schema] == [f.dataType for f in tables.schema_of("orders")]


def test_bucketed_join_needs_no_shuffle_and_catalog(spark):
    for name in ("left_t", "right_t"):
        files.save_bucketed(spark.range(200).withColumn("v", F.lit(1)), name, "id", 4)
    joined = spark.table("left_t").hint("merge").join(spark.table("right_t"), "id")
    assert "Exchange" not in plan(joined) and joined.count() == 200
    spark.table("left_t").createOrReplaceTempView("left_view")
    kinds = dict(rows(files.list_relations(spark)))
    assert kinds["left_t"] == "MANAGED" and kinds["left_view"] == "TEMPORARY"
    assert ("left_view",) in rows(files.list_relations(spark, "TEMPORARY"), "table_name")


def test_clustered_layout_prunes(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("status"), F.col("id").alias("n"))
    files.write_clustered(df, str(tmp_path / "c"), "status", ["n"])
    back = spark.read.parquet(str(tmp_path / "c")).where("status = '1' AND n < 50")
    assert "PartitionFilters: [isnotnull(status" in plan(back) and "LessThan(n,50)" in plan(back)
    assert back.count() == 17


def test_z_order_skips_on_every_column(spark, tmp_path):
    """A narrow filter on any of three columns overlaps under a fifth of the footers, although
    one customer has a third of the rows. (One across the middle of a column overlaps more.)"""
    draw = random.Random(4)
    start = dt.date(2001, 1, 1)
    made = [
        (i, 7 if i % 3 == 0 else draw.randint(1, 5000), start + dt.timedelta(days=draw.randint(0, 999)), draw.randint(1, 800) / 2)
        for i in range(30_000)
    ] + [(30_000, None, None, None)]
    df = spark.createDataFrame(made, "id long, customer long, day date, price double")
    path = str(tmp_path / "z")
    files.write_z_ordered(df, path, ["customer", "day", "price"], lookups=("id",), files=1000)
    back = spark.read.parquet(path)
    assert back.columns == df.columns and sorted(rows(back), key=lambda r: r[0]) == made
    footers = [pq.ParquetFile(f).metadata for f in (tmp_path / "z").glob("*.parquet")]
    groups = [m.row_group(i) for m in footers for i in range(m.num_row_groups)]
    assert len(groups) > 900
    days = (start + dt.timedelta(days=500), start + dt.timedelta(days=506))
    for place, (low, high) in ((1, (2500, 2520)), (2, days), (3, (230.0, 234.0))):
        stats = [g.column(place).statistics for g in groups]
        hit = [s for s in stats if s and s.has_min_max and s.min <= high and low <= s.max]
        assert len(hit) < len(groups) / 5
    empty = str(tmp_path / "none")
    files.write_z_ordered(df.limit(0), empty, ["customer", "day"])
    assert spark.read.schema(df.schema).parquet(empty).count() == 0
    with pytest.raises(ValueError):
        files.write_z_ordered(df, path, ["customer", "day", "price"], bits=21)


@pytest.mark.parametrize("seed", range(3))
def test_exact_medians_from_bounds(spark, monkeypatch, seed):
    draw = random.Random(seed)
    monkeypatch.setattr(Q, "SKETCH_PARTS", 20)
    skewed = [draw.choice([0.0, -3.5, draw.gauss(0, 9), draw.gauss(0, 9) ** 3]) for _ in range(801 + seed)]
    rows_ = [(v, str(round(v)), 7.25 if i % 3 else None) for i, v in enumerate(skewed)]
    df = spark.createDataFrame(rows_, "a double, b string, c double").repartition(6)
    found = {r.column: r for r in Q.column_stats(df, ["a", "b", "c"]).collect()}
    for c, values in zip("abc", ([r[0] for r in rows_], [float(r[1]) for r in rows_], [r[2] for r in rows_ if r[2]])):
        got = found[c]
        assert (got["count"], got.median, got.min, got.max) == (
            len(values), statistics.median(values), min(values), max(values))
        assert got.mean == pytest.approx(statistics.fmean(values))
        assert got.std_dev == pytest.approx(statistics.stdev(values))


def test_only_values_near_the_median_are_kept_apart(spark):
    df = spark.range(200_000).select(F.rand(1).alias("v"))
    bounds = {"v": tuple(Q._moments(df, ["v"])["v"][5])}
    kept = Q._around(df, bounds)
    assert kept.count() < 0.01 * 200_000
    assert kept.agg(F.sum("n")).first()[0] == df.where(F.col("v") <= bounds["v"][1]).count()


def test_bounds_that_miss_the_median_are_dropped(spark, monkeypatch):
    df = spark.createDataFrame([(float(i),) for i in range(9)], "v double")
    moments = Q._moments(df, ["v"])["v"][:5]
    monkeypatch.setattr(Q, "_moments", lambda df, columns: {"v": (*moments, [7.0, 8.0])})
    assert Q.column_stats(df, ["v"]).first().median == 4.0


def test_a_closed_gate_publishes_nothing(spark, tmp_path):
    def publish(*data, gate=("id",)):
        raw = spark.createDataFrame([(i, *r) for i, r in enumerate(data, 1)], "n long, id string, units string")
        Q.publish_cleaned(raw, str(tmp_path), {"id": "int", "units": "int"}, "n", gate, ("units",))

    with pytest.raises(Q.GateClosed, match="no rows"):
        publish()
    publish(("1", "5"), ("1", "5"), ("2", ""), ("3", "x"))
    good = [(1, 1, 5, 2), (4, 3, None, 1)]
    assert sorted(rows(Q.published(spark, str(tmp_path)), "n", "id", "units", "_copies")) == good
    assert rows(Q.published(spark, str(tmp_path), Q.SET_ASIDE), "n", "id") == [(3, 2)]
    assert rows(Q.published_summary(spark, str(tmp_path))) == [(4, 1, 1, 2, 50.0)]
    with pytest.raises(Q.GateClosed) as closed:
        publish(("1", "5"), ("null", "6"))
    assert closed.value.broken == ["id"]
    assert sorted(rows(Q.published(spark, str(tmp_path)), "n", "id", "units", "_copies")) == good
    publish(("7", "8"), gate=("id", "not there"))
    assert rows(Q.published(spark, str(tmp_path)), "id") == [(7,)]
