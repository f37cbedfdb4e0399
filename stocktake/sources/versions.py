"""Stored tables whose files are named by a manifest, so that a change is seen whole or not at all.

``<root>/data`` has a folder for every write, which nothing changes later. A version is one
small file below ``<root>/_versions`` that lists what the table now consists of. Writing that
file, a single rename or upload, is the switch: before it readers have the old version, after it
the new one, and a write that failed halfway has left folders that no manifest names. One writer
at a time may change a table. Only Spark's readers and writers touch the storage.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ENTRY = "kind string, part string, value string"

# Folders that a part may consist of before they are merged into one.
MOST_FOLDERS = 16


@dataclass(frozen=True)
class Entry:
    """One line of a manifest: a folder of a part of the table, a batch it holds, or a setting."""

    kind: str
    part: str
    value: str


class Manifest:
    """The newest version of the table below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.version, self.entries = self._newest()

    def _newest(self) -> tuple[int, list[Entry]]:
        try:
            files = self.spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter="part-*")
            paths = [r.path for r in files.load(f"{self.root}/_versions").select("path").collect()]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return -1, []
        versions = [int(p.rsplit("/", 2)[1].split("=")[1]) for p in paths]
        if not versions:
            return -1, []
        lines = self.spark.read.schema(_ENTRY).json(self._file(max(versions))).collect()
        return max(versions), [Entry(*line) for line in lines]

    def _file(self, version: int) -> str:
        return f"{self.root}/_versions/version={version:012d}"

    def of(self, kind: str) -> list[Entry]:
        return [e for e in self.entries if e.kind == kind]

    def value(self, kind: str, part: str = "") -> str | None:
        return next((e.value for e in self.entries if e.kind == kind and e.part == part), None)

    def folder(self) -> str:
        """A name for the folder of a new write, below ``data``."""
        return uuid.uuid4().hex

    def path(self, folder: str) -> str:
        return f"{self.root}/data/{folder}"

    def commit(self, entries: list[Entry]) -> None:
        """Make ``entries`` the table. Fails if the version exists: somebody else wrote it."""
        lines = self.spark.createDataFrame([(e.kind, e.part, e.value) for e in entries], _ENTRY)
        lines.coalesce(1).write.json(self._file(self.version + 1))
        self.version, self.entries = self.version + 1, entries

    def rows(self, schema: T.StructType, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.path(f) for f in dict.fromkeys(folders)])


# --- appended tables --------------------------------------------------------


def append_batch(df: DataFrame, root: str, by: str, batch: str) -> bool:
    """Append a batch of facts or dimension rows to the table below ``root``, in folders by the
    values of ``by``. A batch that the table already holds is left; a load that fails halfway
    leaves the table as it was, and can be repeated."""
    table = Manifest(df.sparkSession, root)
    if any(e.part == batch for e in table.of("batch")):
        return False
    folder = table.folder()
    # The hint gathers a value's rows into few files and still splits a very large one.
    df.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(table.path(folder))
    folders = [e.value for e in table.of("rows")] + [folder]
    if len(folders) > MOST_FOLDERS:
        merged = table.folder()
        everything = _together(table, df.schema, folders)
        everything.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(table.path(merged))
        folders = [merged]
    held = [*table.of("batch"), Entry("batch", batch, folder)]
    table.commit([*held, *[Entry("rows", "", f) for f in folders]])
    return True


def read_appended(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All batches of the table. Columns are in the order of ``schema``."""
    table = Manifest(spark, root)
    return _together(table, schema, [e.value for e in table.of("rows")])


def _together(table: Manifest, schema: T.StructType, folders: list[str]) -> DataFrame:
    """Folders that have partitions of their own, at most ``MOST_FOLDERS`` and one."""
    parts = [table.rows(schema, [f]).select(*schema.names) for f in folders]
    return reduce(DataFrame.unionByName, parts) if parts else table.rows(schema, [])


# --- stored summaries, kept up to date by differences -------------------------


@dataclass(frozen=True)
class Summary:
    """A stored result of sums by ``keys``, whose partitions are the values of ``by``.

    What is stored has one row for every key and ``member`` (such as a customer), with sums and
    the number of rows it stands for, so that rows can be added and taken away, and the number
    of members that are left is their distinct count. ``by`` is one of the keys, a date or text.
    """

    root: str
    keys: tuple[str, ...]
    by: str
    member: str
    sums: tuple[str, ...]

    def _partial(self, rows: DataFrame) -> DataFrame:
        sums = [F.sum(c).cast(rows.schema[c].dataType).alias(c) for c in self.sums]
        held = rows.groupBy(*self.keys, self.member).agg(*sums, F.sum("rows").alias("rows"))
        return held.where("rows <> 0")

    def refresh(self, added: DataFrame, removed: DataFrame | None = None) -> list[str]:
        """Take ``removed`` rows out and ``added`` ones in, each with keys, member, sums and
        ``rows`` (how many it stands for). A changed row is removed as it was and added as it
        is. Only partitions that these rows lie in are read and written; they are returned."""
        table = Manifest(added.sparkSession, self.root)
        columns = [*self.keys, self.member, *self.sums, "rows"]
        delta = added.select(*columns)
        if removed is not None:
            less = [(-F.col(c)).cast(added.schema[c].dataType).alias(c) for c in (*self.sums, "rows")]
            delta = delta.unionByName(removed.select(*self.keys, self.member, *less))
        value = F.coalesce(F.col(self.by).cast("string"), F.lit(""))
        number = F.xxhash64(value)  # a folder's name, whatever the value holds
        found = dict(tuple(r) for r in delta.select(number, value).distinct().collect())  # a row per partition
        touched = sorted(found.values())
        kept = [e for e in table.of("rows") if e.part not in touched]
        old = [e.value for e in table.of("rows") if e.part in touched]
        merged = self._partial(table.rows(delta.schema, old).unionByName(delta)).withColumn("_part", number)
        folder = table.folder()
        merged.hint("rebalance", F.col("_part")).write.partitionBy("_part").parquet(table.path(folder))
        entries = [Entry("rows", found[n], f"{folder}/_part={n}") for n in partitions_of(table, folder, "_part")]
        table.commit([*kept, *entries])
        return touched

    def read(self, spark: SparkSession, schema: T.StructType, members: str) -> DataFrame:
        """The summary: keys, number of rows and members, and sums. ``schema`` is that of the
        rows it was refreshed with."""
        table = Manifest(spark, self.root)
        names = [*self.keys, self.member, *self.sums, "rows"]
        kind = T.StructType([schema[c] for c in names])
        stored = table.rows(kind, [e.value for e in table.of("rows")])
        sums = [F.sum(c).cast(schema[c].dataType).alias(c) for c in self.sums]
        return stored.groupBy(*self.keys).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias(members), *sums)


def partitions_of(table: Manifest, folder: str, column: str) -> list[int]:
    """The partitions that a write has made; none if it had no rows."""
    try:
        written = table.spark.read.parquet(table.path(folder)).select(F.col(column).cast("long")).distinct()
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return []
    return [row[0] for row in written.collect()]


# --- buckets ----------------------------------------------------------------


class Buckets:
    """A table whose rows are dealt to a fixed number of buckets by a hash of their key, each in
    parts of different kinds. A change names the buckets it rewrites or adds to."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64):
        self.table, self.key = Manifest(spark, root), key
        self.buckets = int(self.table.value("buckets") or buckets)

    def number(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def rows(self, schema: T.StructType, kind: str, buckets: list[int] | None = None) -> DataFrame:
        wanted = None if buckets is None else {str(b) for b in buckets}
        folders = [e.value for e in self.table.of(kind) if wanted is None or e.part in wanted]
        return self.table.rows(schema, folders)

    def folders(self, kind: str, bucket: int) -> int:
        return sum(e.part == str(bucket) for e in self.table.of(kind))

    def write(self, df: DataFrame, kind: str) -> list[Entry]:
        """Write rows into a folder for each bucket. No reader sees them yet."""
        folder = self.table.folder()
        dealt = df.withColumn("_bucket", self.number())
        dealt.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(self.table.path(folder))
        return [Entry(kind, str(b), f"{folder}/_bucket={b}") for b in partitions_of(self.table, folder, "_bucket")]

    def commit(self, replaced: dict[str, list[int]], written: list[Entry], settings: dict[tuple[str, str], str]) -> None:
        """Publish ``written``, in place of what ``replaced`` names by kind, and settings by kind
        and part."""
        gone = {(k, str(b)) for k, bs in replaced.items() for b in bs}
        settings = {("buckets", ""): str(self.buckets), **settings}
        kept = [e for e in self.table.entries if (e.kind, e.part) not in gone and (e.kind, e.part) not in settings]
        self.table.commit([*kept, *written, *[Entry(k, p, v) for (k, p), v in settings.items()]])
