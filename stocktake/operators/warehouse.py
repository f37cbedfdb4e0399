"""Dimensional warehouse operators: date dimension, slowly changing dimensions,
surrogate keys, point-in-time lookup."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.operators.ordered import OrderedGroups, number_rows, ordered_groups
from stocktake.session import broadcast_if_few, stage

# Fixed value: the end date of a current version.
OPEN_END = "9999-12-31"


def open_end() -> Column:
    return F.to_date(F.lit(OPEN_END))


def date_key(c: Column) -> Column:
    """YYYYMMDD as an integer."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def date_dimension(days: DataFrame, day: str = "date", fiscal_start_month: int = 1) -> DataFrame:
    """One row per day. Weekday 1 is Monday; the fiscal quarter counts from
    ``fiscal_start_month``."""
    d = F.col(day)
    fiscal_month = F.pmod(F.month(d) - F.lit(fiscal_start_month), F.lit(12))
    weekday = F.weekday(d) + 1
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
        F.concat(F.lit("Q"), (F.floor(fiscal_month / 3) + 1).cast("string")).alias("fiscal_quarter"),
    )


# --- keys -------------------------------------------------------------------


def with_surrogate_keys(df: DataFrame, order: list[str], name: str, after: int = 0) -> DataFrame:
    """Dense keys ``after + 1, after + 2, ...`` in the given (unique) order."""
    numbered = number_rows(df, order, name)
    return numbered.withColumn(name, F.col(name) + after) if after else numbered


def highest_key(dim: DataFrame, name: str) -> int:
    return dim.agg(F.coalesce(F.max(name), F.lit(0))).first()[0]


# --- SCD type 2 -------------------------------------------------------------


def _differs(columns: list[str], w) -> Column:
    """True where any tracked column differs from the row before (NULL equals NULL)."""
    return reduce(
        lambda a, b: a | b, [~F.col(c).eqNullSafe(F.lag(c).over(w)) for c in columns]
    )


def _superseded(day: str, w) -> Column:
    """True for a change that another one of the same key and day follows."""
    return F.coalesce(F.lead(day).over(w) == F.col(day), F.lit(False))


def scd2_history(
    changes: DataFrame, key: str, tracked: list[str], day: str, sequence: str,
    hot_rows: int | None = None,
) -> DataFrame:
    """All versions from a change log with any number of changes per key.

    A version starts where a tracked column differs from the state before it, and ends
    where the next one starts. Going back to an old value opens a new version. Of several
    changes on a day only the last counts. All three windows share one shuffle and sort.
    """
    groups = ordered_groups(changes, [key], [day, sequence], hot_rows)
    daily = groups.framed(lambda w: {"_old": _superseded(day, w)}, following=1).each(
        lambda df: df.where("NOT _old").drop("_old")
    )
    versions = daily.framed(
        lambda w: {"_new": F.lag(F.lit(True)).over(w).isNull() | _differs(tracked, w)},
        preceding=1,
    ).each(lambda df: df.where("_new").drop("_new"))
    return (
        versions.framed(lambda w: {"_next": F.lead(day).over(w)}, following=1)
        .rows()
        .withColumn("end_date", F.coalesce("_next", open_end()))
        .withColumn("is_current", F.col("_next").isNull())
        .withColumnRenamed(day, "effective_date")
        .drop("_next", sequence)
    )


# Outcome of one change record.
INSERTED, UPDATED, UNCHANGED = "INSERTED_NEW", "UPDATED_SCD2", "NO_CHANGE"
LATE = "REJECTED_LATE"


def _split_current(dim: DataFrame, changes: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Current versions of the changed keys, and the other current versions. A batch of
    few keys is broadcast, so that the dimension is not shuffled for it."""
    keys = broadcast_if_few(changes.select(key).distinct())
    current = dim.where("is_current")
    return current.join(keys, key, "left_semi"), current.join(keys, key, "left_anti")


def scd2_compare(
    current: DataFrame, changes: DataFrame, key: str, tracked: list[str], day: str,
    sequence: str, hot_rows: int | None = None, previous: DataFrame | None = None,
    surrogate: str | None = None,
) -> DataFrame:
    """``current`` versions and the change records in time order, with
    ``_status`` (NULL for an existing version) and the start of the next version.

    Changes dated before the current version are marked late and open no version. A change
    on the day the current version began replaces it and takes over its ``surrogate``; where
    it leads back to the values of the version before (one of ``previous``), that version
    goes on. So a day's changes give the same versions in one batch or in several.

    What several branches read is staged. Otherwise each branch would run the joins and sorts
    of all, and a union of branches by one key runs them in the same task.
    """
    since = current.select(key, F.col("effective_date").alias("_since"))
    batch = (
        changes.withColumnRenamed(day, "effective_date")
        .join(since, key, "left")
        .withColumn("_late", F.coalesce(F.col("effective_date") < F.col("_since"), F.lit(False)))
        .drop("_since")
        .withColumn("_step", F.lit(1))
    )
    batch = stage(batch, "scd2-dated")
    known = current if previous is None else previous.unionByName(current)
    existing = known.withColumn("_step", F.lit(0)).withColumn("_late", F.lit(False))
    rows = existing.unionByName(batch.where(~F.col("_late")), allowMissingColumns=True)
    late = batch.where("_late").withColumn("_status", F.lit(LATE))

    def status(w) -> Column:
        first = F.lag(F.lit(True)).over(w).isNull()
        return F.when(
            F.col("_step") == 1,
            F.when(first, INSERTED).when(_differs(tracked, w), UPDATED).otherwise(UNCHANGED),
        )

    place = ["effective_date", "_step", sequence]
    sizes = changes.select(key).unionAll(current.select(key))
    daily = (
        ordered_groups(rows, [key], place, hot_rows, sizes)
        .framed(lambda w: {"_old": _superseded("effective_date", w)}, following=1)
        .each(lambda df: df.where("_step = 0 OR NOT _old").drop("_old"))
    )
    compared = daily.framed(lambda w: {"_status": status(w)}, preceding=1).each(
        lambda df: stage(df, "scd2-compared")
    )
    versions = compared.each(lambda df: df.where(F.coalesce("_status", F.lit("")) != UNCHANGED))
    versions = _replace_same_day(versions, tracked, surrogate).framed(
        lambda w: {"_next": F.lead("effective_date").over(w)}, following=1
    ).rows()
    same = compared.each(lambda df: df.where(F.col("_status") == UNCHANGED)).rows()
    return (
        versions.unionByName(same, allowMissingColumns=True)
        .unionByName(late, allowMissingColumns=True)
        .drop("_late", "_step", sequence)
    )


def _replace_same_day(versions: OrderedGroups, tracked: list[str], surrogate: str | None) -> OrderedGroups:
    """Versions without those that another one of the same day follows, and without a
    follower that equals the version then before it."""

    def pairs(w) -> dict[str, Column]:
        follows = F.coalesce(F.lag("effective_date").over(w) == F.col("effective_date"), F.lit(False))
        found = {"_gone": _superseded("effective_date", w), "_follows": follows}
        if surrogate:
            found[surrogate] = F.when(follows, F.lag(surrogate).over(w)).otherwise(F.col(surrogate))
        return found

    def back(w) -> dict[str, Column]:
        before = F.lag(F.lit(True)).over(w).isNotNull()
        return {"_back": F.col("_follows") & before & ~_differs(tracked, w)}

    left = versions.framed(pairs, preceding=1, following=1).each(
        lambda df: df.where("NOT _gone").drop("_gone")
    )
    return left.framed(back, preceding=1).each(
        lambda df: df.where("NOT _back").drop("_back", "_follows")
    )


def _versions_before(
    dim: DataFrame, touched: DataFrame, changes: DataFrame, key: str, day: str
) -> tuple[DataFrame, DataFrame]:
    """Closed versions: those right before a current version that a change of its first day
    may replace, and the others. Few keys change twice a day, so they are broadcast if few."""
    closed = dim.where(~F.col("is_current"))
    days = changes.select(key, F.col(day).alias("end_date")).distinct()
    starts = touched.select(key, F.col("effective_date").alias("end_date"))
    twice = broadcast_if_few(stage(starts.join(days, [key, "end_date"]), "scd2-twice"))
    on = [key, "end_date"]
    return closed.join(twice, on, "left_semi"), closed.join(twice, on, "left_anti")


def scd2_merge(
    dim: DataFrame, changes: DataFrame, key: str, tracked: list[str], day: str, sequence: str,
    surrogate: str, hot_rows: int | None = None, rejects: str | None = None,
    highest: int | None = None,
) -> DataFrame:
    """The dimension after a batch of changes: changed versions are closed, new ones
    inserted with fresh keys, everything else is passed through unshuffled when the
    batch touches few keys. ``dim`` should be a stored table. Changes that come too late
    are written to the folder ``rejects``, if one is named. Where ``dim`` is a part of the
    dimension only, ``highest`` is the highest key of all.

    Merging batch by batch gives the versions of ``scd2_history`` over all changes, wherever
    the batches are cut, as long as no change is late."""
    touched, untouched = _split_current(dim, changes, key)
    touched = stage(touched, "scd2-touched")
    previous, closed = _versions_before(dim, touched, changes, key, day)
    compared = stage(
        scd2_compare(
            touched, changes, key, tracked, day, sequence, hot_rows, previous, surrogate
        ),
        "scd2-batch",
    )
    if rejects:
        late = compared.where(F.col("_status") == LATE).withColumnRenamed("effective_date", day)
        late.select(*[c for c in changes.columns if c != sequence]).write.mode("overwrite").parquet(rejects)
    merged = (
        compared.where(F.col("_status").isNull() | F.col("_status").isin(INSERTED, UPDATED))
        .withColumn("end_date", F.coalesce("_next", open_end()))
        .withColumn("is_current", F.col("_next").isNull())
    )
    fresh = with_surrogate_keys(
        merged.where(F.col(surrogate).isNull()).drop(surrogate),
        ["effective_date", key], surrogate, highest_key(dim, surrogate) if highest is None else highest,
    )
    known = merged.where(F.col(surrogate).isNotNull())
    parts = [closed, untouched, known, fresh]
    return reduce(DataFrame.unionByName, [p.select(*dim.columns) for p in parts])


def scd2_statuses(
    dim: DataFrame, changes: DataFrame, key: str, tracked: list[str], day: str, sequence: str
) -> DataFrame:
    """INSERTED_NEW / UPDATED_SCD2 / NO_CHANGE / REJECTED_LATE per change record."""
    current, _ = _split_current(dim, changes, key)
    current = stage(current, "scd2-touched")
    compared = scd2_compare(current, changes, key, tracked, day, sequence)
    return compared.where(F.col("_status").isNotNull()).select(
        key, F.col("effective_date").alias(day), F.col("_status").alias("status")
    )


def point_in_time(
    facts: DataFrame, dim: DataFrame, key: str, at: str, carry: list[str],
    hot_rows: int | None = None, sized_by: DataFrame | None = None,
) -> DataFrame:
    """Every fact with the columns ``carry`` of the version valid at ``at``
    (``effective_date <= at < end_date``), NULL where there is none.

    Versions and facts of a key are merged in time order and the last version is
    carried forward: work is linear in facts + versions, where joining on the key and
    filtering by date would pair every fact with every version of a busy key.
    ``sized_by`` may name a cheaper frame with the facts' keys to find busy keys by.
    """
    sizes = (facts if sized_by is None else sized_by).select(key).unionAll(dim.select(key))
    version = F.struct("end_date", *carry)
    merged = dim.select(
        key, F.col("effective_date").alias("_at"), F.lit(0).alias("_kind"),
        F.lit(0).cast("long").alias("_tie"), version.alias("_version"),
    ).unionByName(
        facts.select(
            key, F.col(at).alias("_at"), F.lit(1).alias("_kind"),
            F.xxhash64(*facts.columns).alias("_tie"),
            F.struct(*[c for c in facts.columns if c != key]).alias("_fact"),
        ),
        allowMissingColumns=True,
    )
    carried = (
        ordered_groups(merged, [key], ["_at", "_kind", "_tie"], hot_rows, sizes)
        .running(lasts={"_seen": F.col("_version")})
        .rows()
        .where("_kind = 1")
    )
    valid = F.col("_seen.end_date") > F.col("_at")
    return carried.select(
        key,
        *[F.col(f"_fact.{c}").alias(c) for c in facts.columns if c != key],
        *[F.when(valid, F.col(f"_seen.{c}")).alias(c) for c in carry],
    )


# --- other dimension and fact types -----------------------------------------


def _against(dim: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    new = incoming.withColumnsRenamed({c: f"_new_{c}" for c in incoming.columns if c != key})
    return dim.withColumn("_old", F.lit(True)).join(
        new.withColumn("_in", F.lit(True)), key, "full_outer"
    )


def scd0_merge(dim: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Retain: known keys keep every value, new keys are added."""
    known = F.col("_old").isNotNull()
    return _against(dim, incoming, key).select(
        key, *[F.when(known, F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c)
               for c in dim.columns if c != key]
    )


def scd1_merge(dim: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Overwrite: values of known keys are replaced by non-null incoming ones."""
    return _against(dim, incoming, key).select(
        key, *[F.coalesce(f"_new_{c}", c).alias(c) for c in dim.columns if c != key]
    )


def scd3_merge(dim: DataFrame, incoming: DataFrame, key: str, column: str) -> DataFrame:
    """Keep the value before the latest change in ``previous_<column>``."""
    joined = _against(dim, incoming, key)
    new, previous = F.col(f"_new_{column}"), f"previous_{column}"
    changed = F.col("_old").isNotNull() & new.isNotNull() & ~new.eqNullSafe(F.col(column))
    kept = F.col(previous) if previous in dim.columns else F.lit(None).cast("string")
    return joined.select(
        key,
        F.coalesce(new, F.col(column)).alias(column),
        F.when(changed, F.col(column)).otherwise(kept).alias(previous),
    )


def month_end_snapshot(versions: DataFrame, through: Column) -> DataFrame:
    """Periodic snapshot: one row per entity and month end it is in force on.

    Month ends are generated from each version's own interval, up to ``through``.
    """
    first = F.last_day("effective_date")
    last = F.least(F.date_sub("end_date", 1), through)
    months = F.when(first <= last, F.sequence(F.trunc(first, "month"), last, F.expr("interval 1 month")))
    return (
        versions.withColumn("_month", F.explode(months))
        .withColumn("month_end", F.last_day("_month"))
        .where(F.col("month_end") <= last)
        .drop("_month")
    )


def junk_dimension(facts: DataFrame, flags: list[str], name: str) -> DataFrame:
    """Distinct flag combinations with a key."""
    return with_surrogate_keys(facts.select(*flags).distinct(), flags, name)
