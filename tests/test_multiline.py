"""CSV records with line ends in fields, cut into blocks of a few bytes, against Python's csv."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from stocktake.sources import files
from stocktake.sources.multiline import csv_records, goes_on
from tests.conftest import rows


@pytest.fixture
def blocks(spark):
    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))

    yield cut
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def awkward(draw, n):
    pieces = ["a", "bc", '"', "\n", "\r\n", ",", " ", '""', "é", "\n\n", '",\n"', "x" * 90]
    return ["".join(draw.choices(pieces, k=draw.randint(0, 6))) for _ in range(n)]


def write(path, table, mark="", end="\r\n", quoting=csv.QUOTE_MINIMAL):
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write(mark)
        writer = csv.writer(out, lineterminator=end, quoting=quoting)
        writer.writerow(["n", "first,\nname", "v"])
        writer.writerows(table)


@pytest.mark.parametrize("size", [200, 100_000])
def test_equals_another_reader(spark, tmp_path, blocks, size):
    draw = random.Random(size)
    table, k = [], 0
    for f in range(3):
        part = [[str(k + i), *awkward(draw, 2)] for i in range(20)]
        write(tmp_path / f"{f}.csv", part, "﻿" if f else "", "\r\n" if f == 1 else "\n", csv.QUOTE_ALL if f == 2 else csv.QUOTE_MINIMAL)
        table, k = table + part, k + 20
    blocks(size)
    got = files.read_csv_numbered(spark, str(tmp_path), multiline=True)
    assert got.columns == ["n", "first,\nname", "v", files.CORRUPT, "row_no"]
    found = sorted(got.collect(), key=lambda r: r.row_no)
    assert [r.row_no for r in found] == list(range(1, 61))
    assert [list(r)[:3] for r in found] == [[v.strip() for v in row] for row in table]
    assert {r[files.CORRUPT] for r in found} == {None}


def test_records_over_many_blocks(spark, tmp_path, blocks):
    """One field is longer than several blocks, and blocks inside it hold no quote at all."""
    long = "line\n" * 100 + 'say ""x""'.replace('""', '"')
    write(tmp_path / "a.csv", [["1", long, "z"], ["2", "", "y"], ["3", long * 2, '"']])
    blocks(130)
    assert csv_records(spark, str(tmp_path)).select("_block").distinct().count() >= 2
    got = files.read_csv(spark, str(tmp_path), ["n", "m", "v"], multiline=True)
    assert sorted(rows(got, "n", "m", "v")) == [("1", long, "z"), ("2", "", "y"), ("3", (long * 2).strip(), '"')]
    tasks = csv_records(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count()
    assert tasks >= 2


def test_blank_ragged_and_open_records(spark, tmp_path, blocks):
    blocks(9)
    (tmp_path / "r.csv").write_text('a,b\n\n  \n1,"x\ny"\n3\n4,5,6\n7,"open\nto the end')
    got = files.read_csv_numbered(spark, str(tmp_path), ["a", "b"], multiline=True)
    found = {r.a: (r.row_no, r.b, r[files.CORRUPT] is None) for r in got.collect()}
    assert {k: v[:1] + v[2:] for k, v in found.items() if k != "7"} == {"1": (1, True), "3": (2, False), "4": (3, False)}
    assert found["1"][1] == "x\ny" and found["7"][0] == 4
    (tmp_path / "r.csv").write_text("")
    assert files.read_csv(spark, str(tmp_path), ["a"], multiline=True).count() == 0


def test_stray_quotes_do_not_open_a_field(spark, tmp_path, blocks):
    (tmp_path / "s.csv").write_text('a,b\n5" pipe,x\n"q",7" y\nz,"k\nl"\n')
    blocks(6)
    got = files.read_csv(spark, str(tmp_path), ["a", "b"], multiline=True)
    assert sorted(rows(got, "a", "b")) == [('5" pipe', "x"), ("q", '7" y'), ("z", "k\nl")]


@pytest.mark.parametrize(
    "line,outside,inside",
    [("", False, True), ("a,b", False, True), ('"', True, False), ('""', False, True), ('a,"b', True, False),
     ('a"b', False, False), ('",",', False, True), ('x","y', True, True), ('"a"b,"', True, True)],
)
def test_state_behind_a_line(line, outside, inside):
    assert (goes_on(line + "\n", False), goes_on(line + "\n", True)) == (outside, inside)
