"""Nested documents: matching, grouping, projecting, flattening and nesting.

A document collection is a DataFrame with struct, map and array columns. Aggregation
stages are folded into one DataFrame plan, so a match is pushed below what follows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.operators.ordered import keep_one, null_safe_join, ordered_groups, sort_keys

Spec = dict[str, Any]


def field(df: DataFrame, path: str) -> Column:
    """Dotted path; NULL when any step is missing from the schema or the document."""
    here: T.DataType = df.schema
    column: Column | None = None
    for step in path.split("."):
        if isinstance(here, T.StructType) and step in here.names:
            column = F.col(f"`{step}`") if column is None else column.getField(step)
            here = here[step].dataType
        elif isinstance(here, T.MapType) and column is not None:
            column = F.try_element_at(column, F.lit(step))
            here = here.valueType
        else:
            return F.lit(None)
    return column


def _reference(value: Any) -> str | None:
    return value[1:] if isinstance(value, str) and value.startswith("$") else None


def match(df: DataFrame, wanted: Spec) -> DataFrame:
    """Every path equals its value; ``None`` matches a null or missing path."""
    return reduce(lambda d, kv: d.where(field(df, kv[0]).eqNullSafe(F.lit(kv[1]))), wanted.items(), df)


def find(df: DataFrame, wanted: Spec | None = None) -> DataFrame:
    return match(df, wanted or {})


def find_one(df: DataFrame, wanted: Spec, order: list[str]) -> DataFrame:
    """First match in the given order, or no row."""
    return find(df, wanted).orderBy(*sort_keys(order)).limit(1)


def _accumulator(df: DataFrame, expression: Spec) -> Column:
    (operator, target), = expression.items()
    path = _reference(target)
    if operator == "$sum" and target == 1:
        return F.count(F.lit(1))
    if operator in ("$sum", "$avg") and path:
        kind = df.select(field(df, path).alias("v")).schema["v"].dataType
        value = field(df, path)
        if not isinstance(kind, T.DecimalType):
            value = value.cast("double")
        value = F.coalesce(value, F.lit(0))
        return F.sum(value) if operator == "$sum" else F.round(F.avg(value), 2)
    raise ValueError(f"unsupported accumulator {expression!r}")


def group(df: DataFrame, spec: Spec) -> DataFrame:
    """Group by a path or a constant. Missing numbers count as zero, also in averages."""
    path = _reference(spec.get("_id"))
    key = field(df, path) if path else F.lit(spec.get("_id"))
    sums = [_accumulator(df, e).alias(n) for n, e in spec.items() if n != "_id"]
    grouped = df.groupBy(key.alias("_id"))
    return grouped.agg(*sums) if sums else grouped.agg(F.count(F.lit(1)).alias("_n")).drop("_n")


def project(df: DataFrame, spec: Spec) -> DataFrame:
    """``1`` keeps a path under its own name, ``"$path"`` renames, ``{"$size": "$path"}`` counts
    an array's elements, anything else is a constant. ``_id`` is only kept when listed."""

    def column(name: str, value: Any) -> Column:
        if value == 1:
            return field(df, name).alias(name)
        if isinstance(value, dict) and "$size" in value:
            found = field(df, _reference(value["$size"]))
            counted = df.select(found.alias("v")).schema["v"].dataType.simpleString() == "int"
            return (found if counted else F.size(found)).alias(name)
        path = _reference(value)
        return (field(df, path) if path else F.lit(value)).alias(name)

    return df.select(*[column(n, v) for n, v in spec.items()])


def sort(df: DataFrame, spec: dict[str, int]) -> DataFrame:
    """1 ascending (missing first), -1 descending (missing last)."""
    return df.orderBy(
        *[
            field(df, p).asc_nulls_first() if way > 0 else field(df, p).desc_nulls_last()
            for p, way in spec.items()
        ]
    )


def unwind(df: DataFrame, spec: str | Spec) -> DataFrame:
    """One row per element of a top-level array. Empty arrays give none, or one row without
    element if ``preserveNullAndEmptyArrays``; ``includeArrayIndex`` names a column for the
    element's place, from 0."""
    spec = spec if isinstance(spec, dict) else {"path": spec}
    name, index = _reference(spec["path"]) or spec["path"], spec.get("includeArrayIndex")
    keep = spec.get("preserveNullAndEmptyArrays", False)
    if index is None:
        return df.withColumn(name, (F.explode_outer if keep else F.explode)(field(df, name)))
    others = [F.col(f"`{c}`") for c in df.columns if c not in (name, index)]
    placed = (F.posexplode_outer if keep else F.posexplode)(field(df, name)).alias(index, name)
    return df.select(*others, placed).withColumn(index, F.col(f"`{index}`").cast("long"))


def numbered_children(
    children: DataFrame, key: str, order: list[str], name: str = "position", hot_rows: int | None = None
) -> DataFrame:
    """Children with their place (from 0) in the order of their key: the flat form of nested
    rows. A row stays a row, however many its key has; a hot key is numbered in slices."""
    placed = ordered_groups(children, [key], order, hot_rows).running({name: F.lit(1)}).rows()
    return placed.withColumn(name, F.col(f"`{name}`") - 1)


def nest(
    children: DataFrame, key: str, order: list[str], fields: list[str], name: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per key with its children as a sorted array of structs. As a document that is
    written must, an array must fit a row; ``numbered_children`` is the form without that bound."""
    numbered = numbered_children(children, key, order, "_rn", hot_rows)
    element = F.struct("_rn", F.struct(*fields).alias("v"))
    return numbered.groupBy(key).agg(F.sort_array(F.collect_list(element)).alias("_all")).select(
        key, F.col("_all.v").alias(name)
    )


def lookup(
    df: DataFrame, other: DataFrame, local: str, foreign: str, name: str, order: list[str]
) -> DataFrame:
    """Left outer equality join with the matches as an array (empty without any): a row for
    every row of ``df``."""
    matches = nest(other, foreign, order, other.columns, name)
    kind = matches.schema[name].dataType
    keyed = df.withColumn("_key", field(df, local))
    joined = null_safe_join(keyed, matches.withColumnRenamed(foreign, "_key"), ["_key"], "left")
    return joined.withColumn(name, F.coalesce(name, F.array().cast(kind))).drop("_key")


def _matched(df: DataFrame, join: Spec, right: DataFrame, how: str) -> DataFrame:
    keyed = df.drop(join["as"]).withColumn("_key", field(df, join["localField"]))
    return null_safe_join(keyed, right, ["_key"], how).drop("_key")


def _unwound(df: DataFrame, join: Spec, spec: str | Spec) -> DataFrame:
    """``$lookup`` and ``$unwind`` of its matches as one flat join: no array is built."""
    spec = spec if isinstance(spec, dict) else {"path": spec}
    index, other, name = spec.get("includeArrayIndex"), join["from"], join["as"]
    if index:
        other = numbered_children(other, join["foreignField"], join["order"], index)
    element = F.struct(*[F.col(f"`{c}`") for c in join["from"].columns]).alias(name)
    places = [F.col(f"`{index}`")] if index else []
    right = other.select(F.col(f"`{join['foreignField']}`").alias("_key"), *places, element)
    keep = spec.get("preserveNullAndEmptyArrays", False)
    return _matched(df.drop(index) if index else df, join, right, "left" if keep else "inner")


def _sized(df: DataFrame, join: Spec) -> DataFrame:
    """The number of matches in place of the matches: counted before the join."""
    key = F.col(f"`{join['foreignField']}`").alias("_key")
    counts = join["from"].groupBy(key).agg(F.count(F.lit(1)).cast("int").alias(join["as"]))
    return _matched(df, join, counts, "left").fillna(0, [join["as"]])


STAGES: dict[str, Callable[[DataFrame, Any], DataFrame]] = {
    "$match": match,
    "$group": group,
    "$project": project,
    "$sort": sort,
    "$limit": lambda df, n: df.limit(n),
    "$skip": lambda df, n: df.offset(n),
    "$unwind": unwind,
}


def _reads(stage: str, spec: Any, name: str) -> bool:
    """Whether a stage reads a column."""
    if stage in ("$limit", "$skip"):
        return False
    if stage in ("$match", "$sort"):
        paths = list(spec)
    elif stage == "$project":
        paths = [n if v == 1 else _reference(v) for n, v in spec.items()]
    elif stage == "$group":
        targets = [t for e in spec.values() for t in (e.values() if isinstance(e, dict) else [e])]
        paths = [_reference(t) for t in targets]
    else:
        paths = [_reference(spec["path"] if isinstance(spec, dict) else spec) or spec]
    return name in {p.split(".")[0] for p in paths if p}


def _sizes(spec: Spec) -> set[str]:
    """The arrays that a projection only counts."""
    return {_reference(v["$size"]) for v in spec.values() if isinstance(v, dict) and "$size" in v}


def aggregate(df: DataFrame, stages: list[Spec]) -> DataFrame:
    """Run aggregation stages in order; an unknown stage is an error.

    A ``$lookup`` waits for the stage that reads its matches. ``$unwind`` makes it a flat join
    and ``$size`` a count; a ``$group`` or ``$project`` that does not read them ends it, since it
    neither adds nor removes rows. Only where the matches themselves are read, or at the end,
    are they gathered into arrays.
    """
    waiting: dict[str, Spec] = {}

    def gathered(name: str) -> DataFrame:
        s = waiting.pop(name)
        return lookup(df.drop(name), s["from"], s["localField"], s["foreignField"], name, s["order"])

    for stage in stages:
        (name, spec), = stage.items()
        if name == "$lookup":
            roots = {spec["localField"].split(".")[0], spec["as"]}
            for earlier in [w for w in waiting if w in roots]:
                df = gathered(earlier)
            waiting[spec["as"]] = spec
            continue
        if name not in STAGES:
            raise ValueError(f"unsupported stage {name!r}")
        if name == "$unwind":
            path = spec["path"] if isinstance(spec, dict) else spec
            join = waiting.pop(_reference(path) or path, None)
            if join:
                df = _unwound(df, join, spec)
                continue
        sizes = _sizes(spec) if name == "$project" else set()
        for join in list(waiting):
            if _reads(name, spec, join):
                df = gathered(join)
            elif name in ("$project", "$group"):
                ended = waiting.pop(join)
                df = _sized(df, ended) if join in sizes else df
        df = STAGES[name](df, spec)
    for join in list(waiting):
        df = gathered(join)
    return df


# --- documents to tables ----------------------------------------------------


def with_default(df: DataFrame, path: str, default: Any) -> Column:
    """Path value, or the default when it is missing. A stored null also takes it."""
    return F.coalesce(field(df, path), F.lit(default))


def event_id(df: DataFrame) -> Column:
    given = F.nullif(field(df, "_id").cast("string"), F.lit(""))
    return F.coalesce(given, field(df, "event_id").cast("string"))


def event_parents(df: DataFrame) -> DataFrame:
    """One flat row per event document."""
    return df.select(
        event_id(df).alias("event_id"),
        with_default(df, "event_type", "unknown").alias("event_type"),
        field(df, "timestamp").alias("timestamp"),
        field(df, "user.user_id").alias("user_id"),
        with_default(df, "user.tier", "standard").alias("user_tier"),
        with_default(df, "device.os", "unknown").alias("device_os"),
        with_default(df, "device.type", "unknown").alias("device_type"),
        with_default(df, "total_amount", 0.0).alias("total_amount"),
    )


def event_children(df: DataFrame) -> DataFrame:
    """One row per item, numbered from 1; documents without items give none."""
    items = df.select(event_id(df).alias("event_id"), F.posexplode("items").alias("_pos", "item"))
    quantity = F.coalesce(F.col("item.qty").cast("int"), F.lit(1))
    price = F.coalesce(F.col("item.price"), F.lit(0.0))
    return items.select(
        F.concat("event_id", F.lit("_item_"), (F.col("_pos") + 1).cast("string")).alias("item_id"),
        "event_id",
        F.col("item.product_id").alias("product_id"),
        quantity.alias("quantity"),
        price.alias("unit_price"),
        F.round(quantity * price, 2).alias("item_subtotal"),
    )


# --- ingest -----------------------------------------------------------------


def ingest(docs: DataFrame, order: str) -> DataFrame:
    """Documents keyed by ``_id``: a missing id is the SHA-256 of content and position, so
    that different documents never share one, and the last document of an id (by ``order``)
    wins."""
    content = [c for c in docs.columns if c != "_id"]
    text = F.to_json(F.struct(*content), {"ignoreNullFields": "false"})
    generated = F.concat(F.lit("doc_"), F.sha2(text, 256))
    keyed = docs.withColumn("_id", F.coalesce(field(docs, "_id"), generated))
    return keep_one(keyed, ["_id"], [F.col(order).desc()])
