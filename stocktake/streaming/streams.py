"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from stocktake.operators.warehouse import scd2_merge
from stocktake.session import stage
from stocktake.sources.versions import MOST_FOLDERS, Buckets, Entry, Manifest

# Parts of a stored dimension: current versions, and those that have ended.
OPEN, CLOSED = "open", "closed"

# Events in one piece of state, and in one frame given back.
CHUNK = 65_536


def read_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType) -> DataFrame:
    """The table ``name`` below ``folder`` as a stream of files, be it one file or a folder of
    them. The braces make the path a pattern, which may stand for either."""
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}}}")


def run_available(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there, then stop; restarts continue from the checkpoint."""
    query = (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_latest(df: DataFrame, keys: list[str], out: str, checkpoint: str) -> DataFrame:
    """Process what is there, then stop; gives the latest state of every key.

    Each micro-batch adds the keys it changed to a table in versions below ``out``, groups still
    open among them; the highest batch of a key counts. When there are ``MOST_FOLDERS`` batches
    they are merged, so that a read never touches more. A repeated batch is left.
    """
    spark = df.sparkSession
    schema = T.StructType([*df.schema, T.StructField("_batch", T.LongType())])

    def write(batch: DataFrame, batch_id: int) -> None:
        table = Manifest(spark, out)
        if int(table.value("batch") or -1) >= batch_id:
            return
        folder = table.folder()
        batch.withColumn("_batch", F.lit(batch_id).cast("long")).write.parquet(table.path(folder))
        folders = [*[e.value for e in table.of("rows")], folder]
        if len(folders) > MOST_FOLDERS:
            merged = table.folder()
            _newest(table.rows(schema, folders), keys).write.parquet(table.path(merged))
            folders = [merged]
        table.commit([Entry("batch", "", str(batch_id)), *[Entry("rows", "", f) for f in folders]])

    df.writeStream.foreachBatch(write).outputMode("update").option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()
    table = Manifest(spark, out)
    return _newest(table.rows(schema, [e.value for e in table.of("rows")]), keys).drop("_batch")


def _newest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The row of the highest batch for each key; a batch has one row for a key."""
    newest = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rows.columns]), "_batch").alias("row")
    return rows.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(newest).select("row.*")


def first_per_key(events: DataFrame, keys: list[str], at: str, event_id: str) -> DataFrame:
    """The first event of every key by time, ties to the smaller id. Holds over any span of
    time; the state is one time and id per key. For ``run_latest``."""
    first = F.min(F.struct(at, event_id)).alias("first")
    return events.groupBy(*keys).agg(first).select(*keys, f"first.{at}", f"first.{event_id}")


def windowed_revenue(
    events: DataFrame, at: str, amount: str, length: str, delay: str, slide: str | None = None
) -> DataFrame:
    """Revenue and count per tumbling or sliding window; closed windows are emitted once."""
    frame = F.window(at, length, slide) if slide else F.window(at, length)
    return (
        events.withWatermark(at, delay)
        .groupBy(frame.alias("w"))
        .agg(F.sum(amount).alias("revenue"), F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                "revenue", "n")
    )


def drop_repeats(events: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """First arrival per key. Keys are remembered for ``delay`` only, so a repeat that comes
    later than that is let through; ``first_per_key`` has no such limit."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark(keys)


def enrich(events: DataFrame, profiles: DataFrame, key: str) -> DataFrame:
    """Stream-static left join; Spark re-plans the static side's size per batch."""
    return events.join(profiles, key, "left")


# The bucket of the rows without a key.
NO_KEY = -1


class FirstInWindow(StatefulProcessor):
    """Marks events in time order although they arrive out of it, for a bucket of keys at once:
    a call for each key would cost more than its events.

    Kept per bucket, in chunks: the start of the window that the last settled event of each key
    lies in, and the pending events as (key, time, id). Events behind the watermark are settled,
    since no event before them can come any more; the others are marked again with whatever
    comes between them. A batch is never gathered in one frame: 24 bytes of an event are held.
    """

    def __init__(self, micros: int):
        self.micros = micros

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        chunk = T.StructType([T.StructField("chunk", T.BinaryType())])
        self.starts = handle.getListState("starts", chunk)
        self.pending = handle.getListState("pending", chunk)

    def handleInputRows(self, key, rows, timer_values) -> Iterator[pd.DataFrame]:
        nameless = key[0] == NO_KEY
        pending, repeats = self._step([self._columns(frame, nameless) for frame in rows], timer_values)
        for at in range(0, len(pending), CHUNK):
            part = slice(at, at + CHUNK)
            yield pd.DataFrame(
                {"key": None if nameless else pending[part, 0], "event_id": pending[part, 2],
                 "at": pending[part, 1], "is_repeat": repeats[part]}
            )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """No event of the bucket came since its pending ones were marked: they stay as they are."""
        self._step([], timerValues)
        yield pd.DataFrame({"key": [], "event_id": [], "at": [], "is_repeat": []}).astype(
            {"key": "int64", "event_id": "int64", "at": "int64", "is_repeat": "bool"}
        )

    def _columns(self, frame: pd.DataFrame, nameless: bool) -> np.ndarray:
        keys = np.zeros(len(frame), "int64") if nameless else frame["key"].to_numpy("int64")
        return np.column_stack([keys, frame["at"].to_numpy("int64"), frame["event_id"].to_numpy("int64")])

    def _step(self, chunks: list[np.ndarray], timer_values) -> tuple[np.ndarray, np.ndarray]:
        """Pending and new events in order, and which are repeats. What is settled is let go."""
        pending = np.concatenate([self._held(self.pending, 3), *chunks])
        pending = pending[np.lexsort((pending[:, 2], pending[:, 1], pending[:, 0]))]
        known = self._held(self.starts, 2)
        starts, repeats = self._marked(pending, known)
        self._settle(pending, starts, known, timer_values)
        return pending, repeats

    def _held(self, state, width: int) -> np.ndarray:
        found = [np.frombuffer(chunk, "int64").reshape(-1, width) for (chunk,) in state.get()]
        return np.concatenate([np.empty((0, width), "int64"), *found])

    def _hold(self, state, values: np.ndarray) -> None:
        state.clear()
        if len(values):
            state.put([(values[at : at + CHUNK].tobytes(),) for at in range(0, len(values), CHUNK)])

    def _marked(self, events: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For events sorted by key and time: the start of the window each lies in, and whether
        it is a repeat. ``known`` has keys, sorted, with the start of their last window."""
        n = len(events)
        keys, first, group = np.unique(events[:, 0], return_index=True, return_inverse=True)
        ends = np.append(first[1:], n)
        place = np.searchsorted(known[:, 0], keys)
        held = np.isin(keys, known[:, 0])
        start = np.zeros(len(keys), "int64")
        start[held] = known[place[held], 1]
        after = self._after(events[:, 1], group, ends, np.concatenate([events[:, 1], start]), np.concatenate([group, np.arange(len(keys))]))
        opens = np.zeros(n, bool)
        at, stop = np.where(held, after[n:], first), ends
        while len(at):  # one window of every key in a round
            at, stop = at[at < stop], stop[at < stop]
            opens[at] = True
            at = after[at]
        last = np.maximum.accumulate(np.where(opens, np.arange(n), -1))
        own = last >= first[group]
        return np.where(own, events[last, 1], start[group]), ~opens

    def _after(self, times: np.ndarray, group: np.ndarray, ends: np.ndarray, opened: np.ndarray, by: np.ndarray) -> np.ndarray:
        """Place of the first event outside the window ``opened`` by a key."""
        if self.micros <= 0:
            return ends[by]
        n = len(times)
        order = np.lexsort((np.arange(n + len(opened)) >= n, np.append(times, opened + self.micros), np.append(group, by)))
        found = np.empty(len(order), "int64")
        found[order] = np.cumsum(order < n)  # the events up to here
        return found[n:]

    def _settle(self, pending: np.ndarray, starts: np.ndarray, known: np.ndarray, timer_values) -> None:
        behind = pending[:, 1] < timer_values.getCurrentWatermarkInMs() * 1000
        if behind.any():
            settled = np.column_stack([pending[behind, 0], starts[behind]])
            both = np.concatenate([known, settled])[::-1]
            keys, newest = np.unique(both[:, 0], return_index=True)
            self._hold(self.starts, np.column_stack([keys, both[newest, 1]]))
        left = pending[~behind]
        self._hold(self.pending, left)
        if len(left):
            self.handle.registerTimer(int(left[:, 1].max()) // 1000 + 1)

    def close(self) -> None:
        pass


def first_in_window(
    events: DataFrame, key: str, at: str, event_id: str, seconds: float, delay: str, buckets: int = 1024
) -> DataFrame:
    """Streaming form of the fixed-window repeat marking, for ``run_latest`` by event_id: an
    event is marked again while events before it may still come. Events that are more than
    ``delay`` behind the latest one are dropped. Needs the RocksDB state store provider.
    The keys are dealt to ``buckets``, each a group of the state; a checkpoint keeps to one number."""
    rows = events.select(
        F.col(key).cast("long").alias("key"),
        F.col(event_id).cast("long").alias("event_id"),
        F.col(at).cast("timestamp").alias("time"),
    )
    bucket = F.when(F.col("key").isNull(), NO_KEY).otherwise(F.pmod(F.xxhash64("key"), F.lit(buckets)))
    timed = rows.withWatermark("time", delay).withColumn("at", F.unix_micros("time"))
    return timed.withColumn("bucket", bucket.cast("int")).groupBy("bucket").transformWithStateInPandas(
        FirstInWindow(int(seconds * 1_000_000)),
        "key long, event_id long, at long, is_repeat boolean",
        "update",
        "eventTime",
    )


# --- SCD type 2 from a stream of changes ------------------------------------


def read_dimension(spark: SparkSession, root: str, schema: T.StructType, key: str) -> DataFrame:
    """All versions of a stored dimension, as of its newest manifest."""
    stored = Buckets(spark, root, key)
    return stored.rows(schema, OPEN).unionByName(stored.rows(schema, CLOSED))


def merge_changes(
    root: str, changes: DataFrame, key: str, tracked: list[str], day: str, sequence: str,
    surrogate: str, source: str, batch: int, buckets: int = 64,
) -> list[int]:
    """Merge a batch of changes into the dimension below ``root``; gives the buckets written.

    Versions lie in buckets by key. Only those of the changed keys are read and written: their
    current versions anew, while versions that end are added to what has ended before. An ended
    version is touched again only if a change of the day it ended on makes it go on. A version
    of the manifest publishes all of it, with the highest surrogate and the batch, so that a
    repeated batch does nothing. Late changes are in ``<root>/_rejects/<source>-<batch>``.
    """
    spark = changes.sparkSession
    stored = Buckets(spark, root, key, buckets)
    if int(stored.table.value("batch", source) or -1) >= batch:
        return []
    done = {("batch", source): str(batch)}
    schema = versions_schema(changes, key, day, sequence, surrogate)
    touched = [r[0] for r in changes.select(stored.number()).distinct().collect()]  # a number per bucket
    highest = int(stored.table.value("highest") or 0)
    current = stored.rows(schema, OPEN, touched)
    same_day = current.join(
        changes.select(key, F.col(day).alias("effective_date")).distinct(), [key, "effective_date"], "left_semi"
    ).select(key, F.col("effective_date").alias("end_date"))
    ended = stored.rows(schema, CLOSED, touched)
    prior = stage(ended.join(same_day, [key, "end_date"], "left_semi"), "scd2-prior")
    merged = stage(
        scd2_merge(
            current.unionByName(prior), changes, key, tracked, day, sequence, surrogate,
            rejects=f"{root}/_rejects/{source}-{batch}", highest=highest,
        ),
        "scd2-merged",
    )
    closed = merged.where(~F.col("is_current")).join(prior.select(surrogate, "end_date"), [surrogate, "end_date"], "left_anti")
    closed = closed.select(*schema.names)
    # Ended versions that go on, or end on another day, leave the ended ones.
    again = stage(prior.join(merged.where(~F.col("is_current")), [surrogate, "end_date"], "left_anti").select(key, surrogate), "scd2-again")
    anew = {r[0] for r in again.select(stored.number()).distinct().collect()}
    anew |= {b for b in touched if stored.folders(CLOSED, b) >= MOST_FOLDERS}
    if anew:
        kept = stored.rows(schema, CLOSED, sorted(anew)).join(again.select(surrogate), surrogate, "left_anti")
        closed = closed.unionByName(kept.select(*schema.names))
    written = stored.write(merged.where("is_current"), OPEN) + stored.write(closed, CLOSED)
    top = max(highest, merged.agg(F.coalesce(F.max(surrogate), F.lit(0))).first()[0])
    replaced = {OPEN: touched, CLOSED: sorted(anew)}
    stored.commit(replaced, written, {**done, ("highest", ""): str(top)})
    return touched


def versions_schema(changes: DataFrame, key: str, day: str, sequence: str, surrogate: str) -> T.StructType:
    """The columns of a dimension that these changes go into."""
    own = [f for f in changes.schema if f.name not in (day, sequence)]
    added = "effective_date date, end_date date, is_current boolean"
    return T.StructType([T.StructField(surrogate, T.LongType()), *own, *T.StructType.fromDDL(added)])


def scd2_stream(
    changes: DataFrame, root: str, checkpoint: str, key: str, tracked: list[str], day: str,
    sequence: str, surrogate: str, buckets: int = 64,
) -> StreamingQuery:
    """Merge each micro-batch of changes into the dimension below ``root`` (``merge_changes``).

    A new checkpoint goes on from the stored dimension, whichever stream wrote that. One stream
    at a time may write to a dimension.
    """
    source = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def merge(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            merge_changes(root, batch, key, tracked, day, sequence, surrogate, source, batch_id, buckets)

    query = (
        changes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
