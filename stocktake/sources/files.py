"""File sources and sinks: CSV, JSON documents, INSERT text, stored summaries, layouts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.functions.scalar import number_text, quote_sql, strip
from stocktake.session import broadcast_if_few, stage
from stocktake.sources.multiline import csv_records

CORRUPT = "_corrupt_record"

# A quote inside a quoted field is doubled; backslashes are ordinary characters.
DIALECT = {
    "encoding": "UTF-8", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def parse_schema(text: str | None) -> dict[str, str]:
    """``"age:int, price:float"`` as a dict; entries without a colon are ignored."""
    pairs = (part.strip().split(":", 1) for part in (text or "").split(",") if ":" in part)
    return {name.strip(): kind.strip() for name, kind in pairs}


def read_csv(
    spark: SparkSession, path: str, columns: list[str] | None = None, multiline: bool = False
) -> DataFrame:
    """CSV with a header, every value a string without white space at its ends (missing
    values are empty), byte order mark skipped. Rows of the wrong width keep their text in
    ``_corrupt_record``. Blank lines are no rows.

    ``columns`` saves the pass over the header when the layout is known. ``multiline`` reads
    quoted fields that hold line ends, by as many tasks as the files have blocks.
    """
    columns = columns or _header(spark, path, multiline)
    if multiline:
        return _fields(spark, path, columns).select(*_named(columns), CORRUPT)
    return _lines(spark, path, columns).select(*_trimmed(columns), CORRUPT)


def _header(spark: SparkSession, path: str, multiline: bool) -> list[str]:
    return spark.read.options(header=True, multiLine=multiline, **DIALECT).csv(path).columns


def _named(names: list[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in names]


def _text_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])


def _trimmed(columns: list[str], within: str = "") -> list[Column]:
    return [F.coalesce(strip(F.col(f"{within}`{c}`")), F.lit("")).alias(c) for c in columns]


def _lines(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of files in which every line is a row."""
    return (
        spark.read.options(header=True, **DIALECT)
        .schema(_text_schema(columns))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("enforceSchema", True)
        .csv(path)
    )


def _fields(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Rows of files with line ends in fields, and the place of each: file, block, number."""
    options = {"multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **DIALECT}
    is_header = (F.col("_block") == 0) & (F.col("_no") == 0)
    kind = ", ".join(f"`{f.name}` string" for f in _text_schema(columns))
    rows = csv_records(spark, path).where(~is_header)
    return rows.withColumn("_fields", F.from_csv("_record", kind, options)).select(
        *_trimmed(columns, "_fields."), f"_fields.{CORRUPT}", "_file", "_block", "_no"
    )


def read_csv_numbered(
    spark: SparkSession, path: str, columns: list[str] | None = None, name: str = "row_no",
    multiline: bool = False,
) -> DataFrame:
    """``read_csv`` with the 1-based place of each row in file order.

    Rows are numbered inside their file block where they are read; only the block sizes
    (one row per block) are summed up, so nothing is shuffled.
    """
    columns = columns or _header(spark, path, multiline)
    if multiline:
        placed = _fields(spark, path, columns)
    else:
        placed = _lines(spark, path, columns).select(
            *_trimmed(columns), CORRUPT,
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_no"),
        )
    staged = placed if multiline else stage(placed, "csv")
    blocks = staged.groupBy("_file", "_block").agg(
        F.min("_no").alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    offsets = broadcast_if_few(offsets)
    numbered = staged.join(offsets, ["_file", "_block"])
    place = F.col("_before") + F.col("_no") - F.col("_first") + 1
    return numbered.withColumn(name, place).drop("_file", "_block", "_no", "_first", "_before")


def export_csv(df: DataFrame, path: str) -> bool:
    """Write CSV part files with a header, NULL as empty, in the order of the rows. An empty
    result is not written."""
    if df.isEmpty():
        return False
    doubles = {f.name: number_text(F.col(f"`{f.name}`")) for f in df.schema
               if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    df.withColumns(doubles).write.mode("overwrite").options(
        header=True, nullValue="", emptyValue="", **DIALECT
    ).csv(path)
    return True


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON documents, one per line, with a declared schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def literal(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        text = number_text(c)
    elif isinstance(field.dataType, (T.NumericType, T.BooleanType)):
        text = c.cast("string")
    else:
        text = quote_sql(c.cast("string"))
    return F.coalesce(text, F.lit("NULL"))


def inserts(df: DataFrame, table: str) -> DataFrame:
    """One INSERT statement per row."""
    head = f"INSERT INTO {table} ({', '.join(df.columns)}) VALUES ("
    values = F.concat_ws(", ", *[literal(f) for f in df.schema])
    return df.select(F.concat(F.lit(head), values, F.lit(");")).alias("statement"))


def write_inserts(df: DataFrame, table: str, path: str) -> None:
    inserts(df, table).write.mode("overwrite").text(path)


# --- stored summaries -------------------------------------------------------


def _write_partitioned(df: DataFrame, path: str, by: str, mode: str) -> DataFrame:
    # The rebalance hint gathers the rows of a partition value into few files and still
    # splits a value that is much larger than the others.
    df.hint("rebalance", F.col(by)).write.mode("overwrite").option(
        "partitionOverwriteMode", mode
    ).partitionBy(by).parquet(path)
    return read_summary(df, path)


def store_summary(df: DataFrame, path: str, by: str) -> DataFrame:
    """Store a computed result partitioned by ``by``: the materialized view."""
    return _write_partitioned(df, path, by, "static")


def refresh_summary(df: DataFrame, path: str, by: str) -> DataFrame:
    """Replace only the partitions that ``df`` holds, such as late months."""
    return _write_partitioned(df, path, by, "dynamic")


def read_summary(like: DataFrame, path: str) -> DataFrame:
    return like.sparkSession.read.schema(like.schema).parquet(path).select(*like.columns)


# --- layout -----------------------------------------------------------------


def write_clustered(df: DataFrame, path: str, partition: str, cluster: list[str]) -> None:
    """Partitioned parquet, range-clustered so that footers skip row groups: the role
    of an index on (partition, cluster...). A large partition value gets many files."""
    df.repartitionByRange(partition, *cluster).sortWithinPartitions(
        partition, *cluster
    ).write.mode("overwrite").partitionBy(partition).parquet(path)


def _interleaved(places: list[Column], bits: int) -> Column:
    """The bits of all places in turn, highest first: the way along a Z-curve."""
    n, out = len(places), F.lit(0).cast("long")
    for bit in range(bits):
        for i, place in enumerate(places):
            own = F.shiftright(place, bit).bitwiseAND(F.lit(1))
            out = out.bitwiseOR(F.shiftleft(own.cast("long"), bit * n + n - 1 - i))
    return out


def write_z_ordered(
    df: DataFrame, path: str, columns: list[str], lookups: tuple[str, ...] = (), bits: int = 8,
    files: int | None = None,
) -> None:
    """Parquet along a Z-curve over numeric or date ``columns``, so that a filter on any one of
    them skips most files by their footers: the role of one index for each column.

    A value's place is its quantile among 2^``bits`` (a sketch of each column, in one pass), so
    skewed values spread over the curve; nulls share the lowest place. Rows are range-partitioned
    by the curve, then by all columns, so a value on many rows is cut into several files.
    ``lookups`` are key columns that get bloom filters, for equality on values in no order.
    ``files`` is the number of files; by default Spark chooses. For a narrow filter on one of n
    columns to read a fifth of them there should be some 10^n or more; one that lies across a
    border of the coarsest halves reads twice as many. An empty table is written with its schema. ``df`` is read three times (sketch, range borders, write): stage it if it
    is costly.
    """
    if bits * len(columns) > 62:
        raise ValueError("more bits than a long holds")
    ranked = {c: _number(df, c) for c in columns}
    steps = 1 << bits
    shares = F.array(*[F.lit(i / steps) for i in range(1, steps)])
    found = df.agg(*[F.percentile_approx(v, shares, 20 * steps).alias(c) for c, v in ranked.items()]).first()
    named = {f"_place {i}": _place(v, sorted(set(found[c] or []))) for i, (c, v) in enumerate(ranked.items())}
    placed = df.withColumns(named)
    placed = placed.withColumn("_z curve", _interleaved([F.col(f"`{p}`") for p in named], bits)).drop(*named)
    order = [F.col("`_z curve`"), *[F.col(f"`{c}`") for c in columns]]
    dealt = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    writer = dealt.sortWithinPartitions(*order).drop("_z curve").write.mode("overwrite")
    for c in lookups:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def _number(df: DataFrame, name: str) -> Column:
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise ValueError(f"no order of numbers: {name}")


def _place(value: Column, bounds: list[float]) -> Column:
    """How many of the ascending bounds are not above the value, by halving; 0 for null."""
    if not bounds:
        return F.lit(0)

    def among(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= bounds[middle], among(middle + 1, high)).otherwise(among(low, middle))

    return F.when(value.isNull(), 0).otherwise(among(0, len(bounds)))


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Bucketed table: joins and aggregates on ``key`` then need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def list_relations(spark: SparkSession, kind: str | None = None) -> DataFrame:
    """Tables and views of the session, optionally of one kind."""
    found = [(t.name, t.tableType) for t in spark.catalog.listTables()]
    rows = spark.createDataFrame(found, "table_name STRING, table_type STRING")
    return (rows.where(F.col("table_type") == kind) if kind else rows).orderBy("table_name")


