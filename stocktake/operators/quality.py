"""Data-quality operators: profiles, gates, rejects, quarantine, outliers, rules.

Rows are all-text DataFrames as read from CSV unless stated otherwise.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.functions.scalar import CAST_NULLS, is_missing, parse_as, share_percent
from stocktake.operators.ordered import HOT_ROWS, OrderedGroups, ordered_groups
from stocktake.session import stage
from stocktake.sources.versions import Entry, Manifest, partitions_of


def _long(df: DataFrame, *records: Column) -> DataFrame:
    """One output row per struct in ``records``, for every input row."""
    return df.select(F.inline(F.array(*records)))


# --- nulls ------------------------------------------------------------------


def null_profile(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Per column: missing values, their share, and whether it is above ``threshold``.
    One aggregate over all columns."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(is_missing(F.col(f"`{c}`"))).alias(f"_n_{c}") for c in df.columns],
    )
    long = _long(
        counts,
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col("_rows").alias("rows"),
                F.col(f"`_n_{c}`").alias("nulls"),
            )
            for c in df.columns
        ],
    )
    share = F.col("nulls") / F.nullif(F.col("rows"), F.lit(0))
    return long.withColumn("null_share", F.coalesce(share, F.lit(0.0))).withColumn(
        "warn", F.col("null_share") > threshold
    )


def required_gate(profile: DataFrame, required: list[str]) -> DataFrame:
    """One row: valid unless the data is empty or a required column has a missing value.
    Required names that are not in the data are ignored."""
    broken = (F.col("nulls") > 0) & F.col("column").isin(required)
    return profile.agg(
        F.max("rows").alias("rows"),
        F.sort_array(F.collect_list(F.when(broken, F.col("column")))).alias("broken_columns"),
    ).select(
        "rows", "broken_columns",
        ((F.size("broken_columns") == 0) & (F.col("rows") > 0)).alias("is_valid"),
    )


def missing_in(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_missing(F.col(column)))


def split_required(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required values, and the quarantined rest."""
    checks = [is_missing(F.col(c)) for c in required if c in df.columns]
    broken = reduce(lambda a, b: a | b, checks, F.lit(False))
    return df.where(~broken), df.where(broken)


# --- duplicates -------------------------------------------------------------


def duplicate_summary(df: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus copies. Copies are counted on the map side."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def drop_exact_duplicates(df: DataFrame, row_no: str | None = None) -> DataFrame:
    """Each distinct row once; with ``row_no`` the first place is kept."""
    if row_no is None:
        return df.dropDuplicates()
    content = [c for c in df.columns if c != row_no]
    return df.groupBy(*content).agg(F.min(row_no).alias(row_no)).select(*df.columns)


def key_violations(df: DataFrame, key: list[str]) -> DataFrame:
    """Key values that occur more than once."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrences"))
    return counted.where(F.col("occurrences") > 1)


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Child rows whose reference is set but not found in the parent."""
    keys = parent.select(F.col(key).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


# --- types ------------------------------------------------------------------


def _no_literal(c: Column, kind: str) -> Column:
    return c.isNotNull() & (F.trim(c) != "") & parse_as(c, kind).isNull()


def type_errors(df: DataFrame, schema: dict[str, str], row_no: str) -> DataFrame:
    """One row per value that is no literal of its declared type. Only empty values are
    skipped, so the text ``null`` in a number column is an error."""
    checked = {c: k for c, k in schema.items() if c in df.columns and k in ("int", "float")}
    found = [
        F.when(
            _no_literal(F.col(c), k),
            F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), F.lit(k).alias("expected")),
        )
        for c, k in checked.items()
    ]
    if not found:
        found = [F.lit(None).cast("struct<column:string,value:string,expected:string>")]
    bad = df.select(row_no, F.explode(F.array_compact(F.array(*found))).alias("e"))
    return bad.select(row_no, "e.*")


def cast_with_rejects(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Typed columns plus ``_rejects``, a map of the raw text that could not be cast."""
    typed, rejects = [], []
    for c in df.columns:
        raw, kind = F.col(c), schema.get(c, "str")
        if df.schema[c].dataType.simpleString() != "string":
            typed.append(raw)
            continue
        raw = F.when(~F.trim(raw).isin(*CAST_NULLS), raw)
        typed.append(parse_as(raw, kind).alias(c))
        if kind in ("int", "float"):
            rejects.append(F.when(_no_literal(raw, kind), F.struct(F.lit(c), raw)))
    if rejects:
        kept = F.map_from_entries(F.array_compact(F.array(*rejects)))
    else:
        kept = F.create_map().cast("map<string,string>")
    return df.select(*typed, kept.alias("_rejects"))


# --- numbers ----------------------------------------------------------------


def _as_number(df: DataFrame, column: str) -> Column:
    is_text = df.schema[column].dataType.simpleString() == "string"
    return parse_as(F.col(column), "float") if is_text else F.col(column).cast("double")


def _numbers(df: DataFrame, columns: list[str], row_no: str | None = None) -> DataFrame:
    """(column, value[, row_no]) for every parseable number."""
    extra = [F.col(row_no)] if row_no else []
    records = []
    for c in columns:
        records.append(F.struct(F.lit(c).alias("column"), _as_number(df, c).alias("value"), *extra))
    return _long(df, *records).where(F.col("value").isNotNull())


# The quantile sketch's rank error is at most one part in so many.
SKETCH_PARTS = 2_000
UNBOUNDED = (float("-inf"), float("inf"))


def _moments(df: DataFrame, columns: list[str]) -> dict[str, tuple]:
    """Count, mean, sample deviation, minimum, maximum of each column, and two values around its
    median: those at ranks further from the middle than the quantile sketch can err. One
    aggregate over all columns, whose sketches merge; a handful of numbers per column reaches
    the driver. A column without numbers has none."""
    reach = 2 / SKETCH_PARTS
    found = []
    for i, c in enumerate(columns):
        value = _as_number(df, c)
        sketch = F.percentile_approx(value, [0.5 - reach, 0.5 + reach], SKETCH_PARTS)
        parts = F.count(value), F.avg(value), F.stddev_samp(value), F.min(value), F.max(value), sketch
        found += [part.alias(f"_{i}_{k}") for k, part in enumerate(parts)]
    row = df.agg(*found).first()
    return {c: row[6 * i : 6 * i + 6] for i, c in enumerate(columns) if row[6 * i]}


def _around(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """Rows below each column's bounds (``at`` null), and of every single value between them.
    Rows collapse to these groups before they are shuffled; those above are left out."""
    value = F.col("value")
    low, high = (
        reduce(lambda rest, c: F.when(F.col("column") == c, F.lit(bounds[c][i])).otherwise(rest), bounds, F.lit(None))
        for i in (0, 1)
    )
    near = _numbers(df, list(bounds)).where(value <= high)
    counted = near.groupBy("column", F.when(value >= low, value).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    return stage(counted, "stats")


def column_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, median, sample deviation (0 below two values), minimum, maximum and
    the three-sigma bounds of each number column. Text that is no number is skipped; a
    column without any number has count 0.

    The rows are read twice. The first aggregate has the moments, and a sketch that bounds each
    median from both sides. The second counts the rows below the bounds, and single values
    only between them: some thousandths of the rows. These alone are sorted, and counted
    through for the exact median. Bounds that turn out not to hold it are dropped.
    """
    spark, moments = df.sparkSession, _moments(df, columns)
    kind = "column string, count long, mean double, std_dev double, min double, max double"
    none = (0, 0.0, 0.0, 0.0, 0.0)
    stats = [(c, *(v or 0.0 if i else v for i, v in enumerate(moments.get(c, none)[:5]))) for c in columns]
    stats = spark.createDataFrame(stats, kind)
    bounds = {c: tuple(m[5]) for c, m in moments.items()}
    median = spark.createDataFrame([], "column string, median double")
    if bounds:
        around, below, hot = _settled(df, bounds, {c: m[0] for c, m in moments.items()})
        values, n = around.where("at IS NOT NULL"), F.col("n")
        groups = OrderedGroups(["column"], ["at"], values, None)
        if hot:
            groups = ordered_groups(values, ["column"], ["at"])
        ranks = [(c, below[c], (m[0] + 1) // 2, (m[0] + 2) // 2) for c, m in moments.items()]
        ranks = spark.createDataFrame(ranks, "column string, below long, low long, high long")
        upto = F.col("below") + F.col("_upto")
        reached = groups.running({"_upto": n}).rows().join(F.broadcast(ranks), "column")  # a row per column
        firsts = [F.min(F.when(upto >= F.col(c), F.col("at"))) for c in ("low", "high")]
        median = reached.groupBy("column").agg(((firsts[0] + firsts[1]) / 2).alias("median"))
    size, mean, std = F.col("count"), F.col("mean"), F.col("std_dev")
    return (
        stats.join(median, "column", "left")
        .fillna(0.0, ["median"])
        .withColumn("lower", F.when(size >= 2, mean - 3 * std))
        .withColumn("upper", F.when(size >= 2, mean + 3 * std))
        .select("column", "count", "mean", "median", "std_dev", "min", "max", "lower", "upper")
    )


def _settled(
    df: DataFrame, bounds: dict[str, tuple[float, float]], sizes: dict[str, int]
) -> tuple[DataFrame, dict[str, int], bool]:
    """``_around`` with bounds that hold every median, the rows below them, and whether some
    column has more values between them than a task should sort."""
    while True:
        around = _around(df, bounds)
        under = F.sum(F.when(F.col("at").isNull(), F.col("n")).otherwise(0))
        counts = around.groupBy("column").agg(under, F.sum("n") - under, F.count("at")).collect()
        found = {row[0]: row[1:] for row in counts}  # a row per column
        wrong = [
            c for c, n in sizes.items()
            if c not in found or found[c][0] >= (n + 1) // 2 or sum(found[c][:2]) < (n + 2) // 2
        ]
        if not wrong:
            return around, {c: v[0] for c, v in found.items()}, max(v[2] for v in found.values()) > HOT_ROWS
        bounds = bounds | {c: UNBOUNDED for c in wrong}


def outliers(df: DataFrame, columns: list[str], row_no: str, stats: DataFrame) -> DataFrame:
    """Values strictly outside mean ± 3 deviations, with their row."""
    bounds = F.broadcast(stats.select("column", "lower", "upper"))  # one row per column
    numbers = _numbers(df, columns, row_no).join(bounds, "column")
    value = F.col("value")
    return numbers.where((value < F.col("lower")) | (value > F.col("upper"))).select(
        "column", row_no, "value"
    )


# --- rules ------------------------------------------------------------------


def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violating rows per rule; a rule is the condition that must hold. As with a CHECK
    constraint, an unknown (NULL) outcome passes. One pass for all rules."""
    counts = df.agg(
        *[F.count_if(~rule).alias(f"_r{i}") for i, rule in enumerate(rules.values())]
    )
    return _long(
        counts,
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"_r{i}").alias("violations"))
            for i, name in enumerate(rules)
        ],
    )


def header_line_gaps(
    headers: DataFrame, lines: DataFrame, key: str, header: str, line: str
) -> DataFrame:
    """Headers whose total differs from the sum of their lines (no lines count as 0)."""
    sums = lines.groupBy(key).agg(F.sum(line).alias("line_sum"))
    joined = headers.select(key, header).join(sums, key, "left")
    gap = F.col(header) - F.coalesce("line_sum", F.lit(0))
    return joined.withColumn("gap", gap).where("gap <> 0")


# --- the whole flow ---------------------------------------------------------


def recommendations(
    duplicates: DataFrame, profile: DataFrame, outlier_rows: DataFrame | None
) -> DataFrame:
    """Findings worth acting on; a single all-good row when there are none."""
    found = [
        duplicates.where("duplicates > 0").select(
            F.lit("duplicates").alias("finding"), F.lit(None).cast("string").alias("column"),
            F.col("duplicates").cast("double").alias("value"),
        ),
        profile.where("null_share > 0.3").select(
            F.lit("high null share").alias("finding"), "column",
            F.col("null_share").alias("value"),
        ),
    ]
    if outlier_rows is not None:
        found.append(
            outlier_rows.groupBy("column").agg(F.count(F.lit(1)).cast("double").alias("value"))
            .select(F.lit("outliers").alias("finding"), "column", "value")
        )
    findings = reduce(DataFrame.unionByName, found)
    good = findings.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(
        F.lit("no major issues").alias("finding"), F.lit(None).cast("string").alias("column"),
        F.lit(None).cast("double").alias("value"),
    )
    return findings.unionByName(good)


@dataclass(frozen=True)
class Cleaning:
    """Validate, remove exact copies, quarantine incomplete rows, cast, profile.

    ``row_no`` is the place in the input and not part of a row's content. Parts are
    computed when asked for; the rows without copies are stored once for all of them.
    """

    raw: DataFrame
    schema: dict[str, str]
    row_no: str
    required: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    null_threshold: float = 0.5

    @cached_property
    def profile(self) -> DataFrame:
        return null_profile(self.raw.drop(self.row_no), self.null_threshold)

    @cached_property
    def gate(self) -> DataFrame:
        return required_gate(self.profile, list(self.required))

    @cached_property
    def unique(self) -> DataFrame:
        return stage(drop_exact_duplicates(self.raw, self.row_no), "unique")

    @cached_property
    def complete(self) -> DataFrame:
        return split_required(self.unique, list(self.required))[0]

    @cached_property
    def quarantine(self) -> DataFrame:
        return split_required(self.unique, list(self.required))[1]

    @cached_property
    def rows(self) -> DataFrame:
        return cast_with_rejects(self.complete, self.schema)

    @cached_property
    def stats(self) -> DataFrame:
        return stage(column_stats(self.complete, list(self.numeric)), "stats")

    @cached_property
    def outliers(self) -> DataFrame:
        return outliers(self.complete, list(self.numeric), self.row_no, self.stats)

    @cached_property
    def summary(self) -> DataFrame:
        """Rows in and out, and why rows were left out."""
        checks = [is_missing(F.col(c)) for c in self.required if c in self.raw.columns]
        lacking = reduce(lambda a, b: a | b, checks, F.lit(False))
        unique = self.unique.agg(
            F.count(F.lit(1)).alias("unique_rows"), F.count_if(lacking).alias("incomplete_rows")
        )
        counts = unique.unionByName(
            self.raw.agg(F.count(F.lit(1)).alias("rows_in")), allowMissingColumns=True
        )
        rows_in, rows_out = F.col("rows_in"), F.col("unique_rows") - F.col("incomplete_rows")
        return (
            counts.agg(*[F.max(c).alias(c) for c in counts.columns])
            .select(
                "rows_in",
                (rows_in - F.col("unique_rows")).alias("duplicates"),
                "incomplete_rows",
                rows_out.alias("rows_out"),
            )
            .withColumn("kept_pct", share_percent(F.col("rows_out"), rows_in, 1))
        )

    @cached_property
    def recommendations(self) -> DataFrame:
        return recommendations(
            self.summary, self.profile, self.outliers if self.numeric else None
        )


class GateClosed(ValueError):
    """The data is empty, or columns that must be complete have missing values."""

    def __init__(self, broken: list[str]):
        super().__init__(f"not published: missing values in {broken}" if broken else "not published: no rows")
        self.broken = broken


CLEAN, SET_ASIDE = "clean", "set aside"


def publish_cleaned(
    raw: DataFrame, root: str, schema: dict[str, str], row_no: str, gate: tuple[str, ...] = (),
    required: tuple[str, ...] = (),
) -> None:
    """Remove exact copies, cast, set rows without a required value aside, and publish the
    result below ``root``, unless a column of ``gate`` has a missing value or there are no rows:
    then ``GateClosed`` is raised and readers keep what was published before.

    The input is read once. Missing values are counted while the result is written, and the
    gate is decided from that before a manifest names the files; a stage that runs again can
    count a value twice, which does not change whether there are any. What the run has removed
    is part of the result: each row says how many copies it stands for.
    """
    table = Manifest(raw.sparkSession, root)
    gate = tuple(c for c in gate if c in raw.columns)
    seen = Observation("gate")
    counts = [F.count_if(is_missing(F.col(f"`{c}`"))).alias(f"n{i}") for i, c in enumerate(gate)]
    watched = raw.observe(seen, *counts) if gate else raw
    content = [c for c in raw.columns if c != row_no]
    unique = watched.groupBy(*content).agg(F.min(row_no).alias(row_no), F.count(F.lit(1)).alias("_copies"))
    checks = [is_missing(F.col(f"`{c}`")) for c in required if c in raw.columns]
    lacking = reduce(lambda a, b: a | b, checks, F.lit(False))
    typed = cast_with_rejects(unique.withColumn("_lacking", lacking), schema)
    folder = table.folder()
    typed.withColumn("_kind", F.when(F.col("_lacking"), 1).otherwise(0)).drop("_lacking").write.partitionBy(
        "_kind"
    ).parquet(table.path(folder))
    names = {0: CLEAN, 1: SET_ASIDE}
    parts = [Entry(names[k], "", f"{folder}/_kind={k}") for k in partitions_of(table, folder, "_kind")]
    found = seen.get if parts and gate else {}  # without rows nothing is counted
    broken = [c for i, c in enumerate(gate) if found.get(f"n{i}")]
    if broken or not parts:
        raise GateClosed(broken)
    columns = [f for f in typed.schema if f.name != "_lacking"]
    table.commit([*parts, Entry("schema", "", T.StructType(columns).json())])


def published(spark: SparkSession, root: str, kind: str = CLEAN) -> DataFrame:
    """Published rows: typed columns, row number, ``_copies`` and ``_rejects``."""
    table = Manifest(spark, root)
    schema = T.StructType.fromJson(json.loads(table.value("schema")))
    return table.rows(schema, [e.value for e in table.of(kind)])


def published_summary(spark: SparkSession, root: str) -> DataFrame:
    """Rows in and out of the run that was published, and why rows were left out. Reads counts
    of the result only."""
    kinds = [(CLEAN, 0), (SET_ASIDE, 1)]
    parts = [published(spark, root, k).select("_copies", F.lit(i).alias("aside")) for k, i in kinds]
    rows_in, rows_out = F.col("rows_in"), F.col("rows_out")
    return (
        parts[0].unionByName(parts[1])
        .agg(
            F.sum("_copies").alias("rows_in"), F.sum(F.col("_copies") - 1).alias("duplicates"),
            F.count_if(F.col("aside") == 1).alias("incomplete_rows"),
            F.count_if(F.col("aside") == 0).alias("rows_out"),
        )
        .withColumn("kept_pct", share_percent(rows_out, rows_in, 1))
    )
