"""First-in-window marking: per key, an event opens a window of fixed length; events
inside are repeats, the next one after it opens a new window.

The window is anchored at its first event and not extended by repeats, so it is no
gap-based session. With no length the first event of a key covers everything after it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stocktake.operators.ordered import null_safe_join, ordered_groups
from stocktake.session import stage


def _mark_group(length: int):
    def mark(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["_at", "_id"], kind="stable")
        at = rows["_at"].to_numpy()
        opens = rows["_opens"].to_numpy()
        repeat = np.zeros(len(rows), dtype=bool)
        start = 0
        candidates = np.flatnonzero(opens)
        place = 0
        while place < len(candidates):
            start = candidates[place]
            end = len(at) if length <= 0 else np.searchsorted(at, at[start] + length, "right")
            repeat[start + 1:end] = True
            place = np.searchsorted(candidates, end)
        return rows.assign(is_repeat=repeat).drop(columns=["_at", "_id", "_opens"])

    return mark


def _mark_hot(rows: DataFrame, keys: list[str], length: int) -> DataFrame:
    """The same for keys with too many rows for one task.

    Every opening event is linked to the first opening event after its window. Starting
    from each key's first event, the set of openers is doubled round by round by joining
    with links of twice the reach, so a chain of n windows takes log2(n) rounds.
    """
    openers = rows.where("_opens").groupBy(*keys, "_at").agg(F.min("_id").alias("_id"))
    openers = stage(openers, "openers")
    first = openers.groupBy(*keys).agg(F.min("_at").alias("_at"))
    if length > 0:
        probes = openers.select(
            *keys, F.col("_at").alias("_from"), (-(F.col("_at") + length)).alias("_neg"),
            F.lit(0).alias("_kind"),
        )
        targets = openers.select(
            *keys, F.col("_at").alias("_to"), (-F.col("_at")).alias("_neg"), F.lit(1).alias("_kind")
        )
        merged = probes.unionByName(targets, allowMissingColumns=True)
        links = (
            ordered_groups(merged, keys, ["_neg", "_kind"], 0)
            .running(lasts={"_next": F.col("_to")})
            .rows()
            .where("_kind = 0 AND _next IS NOT NULL")
            .select(*keys, "_from", "_next")
        )
        links, chain = stage(links, "links"), stage(first, "chain")
        while True:  # the reach doubles, so rounds are few; none is reached in the last
            reached = null_safe_join(
                chain.withColumnRenamed("_at", "_from"), links, [*keys, "_from"], "inner"
            ).select(*keys, F.col("_next").alias("_at"))
            if reached.isEmpty():
                break
            chain = stage(chain.unionByName(reached).distinct(), "chain")
            further = links.select(
                *keys, F.col("_from").alias("_next"), F.col("_next").alias("_far")
            )
            links = stage(
                null_safe_join(links, further, [*keys, "_next"], "inner").select(
                    *keys, "_from", F.col("_far").alias("_next")
                ),
                "links",
            )
        first = chain
    anchors = null_safe_join(openers, first, [*keys, "_at"], "left_semi").select(
        *keys, "_at", "_id", F.lit(True).alias("_anchor")
    )
    flagged = null_safe_join(rows, anchors, [*keys, "_at", "_id"], "left")
    seen = (
        ordered_groups(flagged, keys, ["_at", "_id"], 0)
        .running(lasts={"_since": F.when(F.col("_anchor"), F.col("_at"))})
        .rows()
    )
    inside = F.col("_since").isNotNull() & F.col("_anchor").isNull()
    if length > 0:
        inside = inside & (F.col("_at") <= F.col("_since") + length)
    return seen.withColumn("is_repeat", inside).drop("_at", "_id", "_opens", "_anchor", "_since")


def mark_repeats(
    events: DataFrame, keys: list[str], at: str, event_id: str, seconds: float | None,
    opens: Column | None = None, hot_rows: int | None = None,
) -> DataFrame:
    """Add ``is_repeat``. ``at`` is a timestamp, ``event_id`` a unique tie-break;
    events where ``opens`` is false can be repeats but open no window."""
    length = int((seconds or 0) * 1_000_000)
    rows = events.withColumns(
        {
            "_at": F.unix_micros(F.col(at).cast("timestamp")),
            "_id": F.col(event_id).cast("long"),
            "_opens": F.lit(True) if opens is None else F.coalesce(opens, F.lit(False)),
        }
    )
    groups = ordered_groups(rows, keys, ["_at", "_id"], hot_rows)
    out = T.StructType([*events.schema.fields, T.StructField("is_repeat", T.BooleanType())])
    parts = []
    if groups.cold is not None:
        parts.append(groups.cold.groupBy(*keys).applyInPandas(_mark_group(length), out))
    if groups.hot is not None:
        hot = groups.hot.drop("_slice")
        parts.append(_mark_hot(hot, keys, length).select(*out.names))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
