import datetime as dt
import random

import pytest
from conftest import day, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.operators.ttl import mark_repeats
from stocktake.sources.versions import Manifest
from stocktake.streaming import streams as X

DIM = (
    T.StructType().add("sk", "long").add("id", "long").add("city", "string")
    .add("effective_date", "date").add("end_date", "date").add("is_current", "boolean")
)

T0 = dt.datetime(2024, 1, 1)


def brute(data, seconds):
    """A cache per key: a miss on an opening event stores it until it expires."""
    expiry, out = {}, []
    for key, at, n, opens in sorted(data, key=lambda r: (r[1], r[2])):
        hit = key in expiry and (expiry[key] is None or at <= expiry[key])
        out.append((n, hit))
        if not hit:
            expiry.pop(key, None)
            if opens:
                expiry[key] = at + dt.timedelta(seconds=seconds) if seconds else None
    return sorted(out)


@pytest.fixture(scope="module")
def lookups():
    rng = random.Random(11)
    return [
        ("hot" if i % 3 == 0 else f"k{rng.randrange(4)}", T0 + dt.timedelta(seconds=rng.randrange(2000)),
         i, rng.random() < 0.8)
        for i in range(300)
    ]


@pytest.mark.parametrize("seconds", [60, 400, 0])
@pytest.mark.parametrize("hot_rows", [10_000, 90])
def test_marking_equals_a_cache(spark, lookups, seconds, hot_rows):
    df = spark.createDataFrame(lookups, "k string, at timestamp_ntz, n long, opens boolean")
    got = mark_repeats(df, ["k"], "at", "n", seconds, F.col("opens"), hot_rows)
    assert sorted(rows(got, "n", "is_repeat")) == brute(lookups, seconds)


def test_expiry_is_strictly_after(spark):
    data = [("a", T0, 1), ("a", T0 + dt.timedelta(seconds=60), 2), ("a", T0 + dt.timedelta(seconds=61), 3)]
    df = spark.createDataFrame(data, "k string, at timestamp_ntz, n long")
    got = mark_repeats(df, ["k"], "at", "n", 60)
    assert sorted(rows(got, "n", "is_repeat")) == [(1, False), (2, True), (3, False)]


def test_stateful_marking_of_shuffled_events(spark, lookups, tmp_path, monkeypatch):
    """Batches overlap by 600 seconds, and each is shuffled."""
    monkeypatch.setattr(X, "CHUNK", 7)
    ids = {"hot": 0, "k0": 1, "k1": 2, "k2": 3, "k3": 4}
    rng = random.Random(3)
    late = {n: rng.randrange(600) for _, _, n, _ in lookups}
    data = sorted(lookups, key=lambda r: r[1] + dt.timedelta(seconds=late[r[2]]))
    src, schema = str(tmp_path / "src"), "k long, at timestamp, n long"
    for start in range(0, 300, 75):
        part = [(ids[k], at, n) for k, at, n, _ in data[start:start + 75]]
        rng.shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        marked = X.first_in_window(spark.readStream.schema(schema).parquet(src), "k", "at", "n", 60, "601 seconds")
        got = X.run_latest(marked, ["event_id"], str(tmp_path / "out"), str(tmp_path / "ck"))
    want = brute([(k, at, n, True) for k, at, n, _ in lookups], 60)
    assert sorted(rows(got, "event_id", "is_repeat")) == want


def test_many_keys_are_few_groups_of_state(spark, tmp_path, monkeypatch):
    """300 keys and rows without one, in two buckets; the second batch lies between the first."""
    monkeypatch.setattr(X, "CHUNK", 11)
    rng = random.Random(5)
    data = [(rng.choice([None, *range(300)]), T0 + dt.timedelta(seconds=rng.randrange(900)), n) for n in range(1500)]
    src, schema = str(tmp_path / "src"), "k long, at timestamp, n long"
    for part in (data[:800], data[800:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema(schema).parquet(src)
        marked = X.first_in_window(stream, "k", "at", "n", 60, "901 seconds", buckets=2)
        got = X.run_latest(marked, ["event_id"], str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(rows(got, "event_id", "is_repeat")) == brute([(k, at, n, True) for k, at, n in data], 60)
    assert {n: k for n, k in rows(got, "event_id", "key")} == {n: k for k, _, n in data}


def test_reads_of_the_latest_state_stay_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(X, "MOST_FOLDERS", 3)
    src, schema = str(tmp_path / "src"), "k long, at timestamp, n long"
    for batch in range(5):
        part = [(k, T0 + dt.timedelta(minutes=10 - batch), batch) for k in range(batch + 1)]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        first = X.first_per_key(spark.readStream.schema(schema).parquet(src), ["k"], "at", "n")
        got = X.run_latest(first, ["k"], str(tmp_path / "out"), str(tmp_path / "ck"))
        assert len(Manifest(spark, str(tmp_path / "out")).of("rows")) <= 3
    assert sorted(rows(got, "k", "n")) == [(k, 4) for k in range(5)]


def test_scd2_stream_in_batches(spark, tmp_path):
    src, root, ck = (str(tmp_path / n) for n in ("src", "dim", "ck"))
    schema = "id long, city string, day date, seq long"
    batches = [
        [(1, "A", "2024-01-01", 1), (2, "B", "2024-01-01", 2)],
        [(1, "C", "2024-02-01", 3), (3, "D", "2024-02-01", 4)],
        [(1, "C", "2024-03-01", 5)],
    ]
    for number, batch in enumerate(batches):
        spark.createDataFrame([(i, c, day(d), s) for i, c, d, s in batch], schema).coalesce(1).write.mode("append").parquet(src)
        changes = spark.readStream.schema(schema).parquet(src)
        X.scd2_stream(changes, root, ck, "id", ["city"], "day", "seq", "sk", 4)
        assert Manifest(spark, root).version == number
    dim = X.read_dimension(spark, root, DIM, "id")
    assert sorted(rows(dim, "sk", "id", "city", "is_current")) == [
        (1, 1, "A", False), (2, 2, "B", True), (3, 1, "C", True), (4, 3, "D", True)]


def test_sliding_windows_and_late_events(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "ts timestamp, v long"

    def add(*minutes):
        data = [(T0 + dt.timedelta(minutes=m), 1) for m in minutes]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        events = spark.readStream.schema(schema).parquet(src)
        summed = X.windowed_revenue(events, "ts", "v", "10 minutes", "5 minutes", "5 minutes")
        X.run_available(summed, str(tmp_path / "out"), str(tmp_path / "ck"))

    add(1, 6, 40)
    add(2, 90)  # minute 2 is behind the watermark and is dropped
    got = spark.read.parquet(str(tmp_path / "out"))
    first = got.where(F.col("window_start") == F.lit("2024-01-01 00:00:00").cast("timestamp"))
    assert rows(first, "revenue", "n") == [(2, 2)]


def test_scd2_stream_goes_on_from_a_stored_dimension(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "dim")
    schema = "id long, city string, day date, seq long"

    def load(folder, checkpoint, *data):
        batch = spark.createDataFrame([(i, c, day(d), s) for i, c, d, s in data], schema)
        batch.coalesce(1).write.mode("append").parquet(f"{src}/{folder}")
        changes = spark.readStream.schema(schema).parquet(f"{src}/{folder}")
        X.scd2_stream(changes, root, str(tmp_path / checkpoint), "id", ["city"], "day", "seq", "sk", 4)

    load("one", "ck1", (1, "A", "2024-02-01", 1), (2, "B", "2024-02-01", 2))
    load("two", "ck2", (1, "C", "2024-03-01", 3), (2, "Z", "2024-01-01", 4))  # a new checkpoint
    dim = X.read_dimension(spark, root, DIM, "id")
    assert sorted(rows(dim, "id", "city", "is_current")) == [(1, "A", False), (1, "C", True), (2, "B", True)]
    late = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/_rejects")
    assert rows(late, "id", "city", "day") == [(2, "Z", day("2024-01-01"))]


@pytest.mark.parametrize("folder", [False, True])
def test_streams_read_files_and_folders(spark, tmp_path, folder):
    where = tmp_path / "t.parquet"
    data = spark.createDataFrame([(1, "a", T0, 7), (1, "a", T0 + dt.timedelta(days=400), 3), (2, "a", T0, 9)],
                                 "user long, kind string, ts timestamp, n long")
    data.coalesce(1).write.parquet(str(where) if folder else str(tmp_path / "parts"))
    if not folder:
        part = next((tmp_path / "parts").glob("part-*.parquet"))
        where.write_bytes(part.read_bytes())
    events = X.read_stream(spark, str(tmp_path), "t.parquet", data.schema)
    first = X.first_per_key(events, ["user", "kind"], "ts", "n")
    got = X.run_latest(first, ["user", "kind"], str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(rows(got, "user", "n")) == [(1, 7), (2, 9)]


def test_latest_state_over_batches(spark, tmp_path):
    src = str(tmp_path / "src")
    schema = "ts timestamp, v long"
    for minutes in ((1, 6, 40), (41, 90)):
        data = [(T0 + dt.timedelta(minutes=m), 1) for m in minutes]
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        events = spark.readStream.schema(schema).parquet(src)
        summed = X.windowed_revenue(events, "ts", "v", "10 minutes", "5 minutes")
        got = X.run_latest(summed, ["window_start"], str(tmp_path / "out"), str(tmp_path / "ck"))
    found = {(r.window_end - r.window_start, r.n) for r in got.collect()}
    assert sorted(r.n for r in got.collect()) == [1, 2, 2] and len(found) == 2
