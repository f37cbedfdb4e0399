"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by a key; the borders between shards are keys. Rounds of counting find them:
each round counts, across all partitions, the exact bytes below evenly spaced candidate keys
between the two keys a border is known to lie between. A border is settled when a candidate
is within tolerance of its target, or when no key is left between; otherwise the next round's
candidates lie between the two nearest. Then the rows are exchanged once, straight to their
places. DataFrame functions only.

The key is a digest of the text, then one of the row's id, then the row's place in the staged
table, so that equal texts stay together, and a group of copies is cut only if it is larger
than the tolerance allows; even rows equal in everything can be cut.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stocktake.llm.shared import named
from stocktake.session import stage

TOLERANCE = 0.001  # of a shard's mean bytes, at each border
LOOSE = 0.5  # of a piece's mean bytes, at borders within a shard
PIECES = 1024  # pieces to exchange into, at most
FIRST_BITS, NEXT_BITS = 12, 8  # candidates of the first round, and between two of them later
DIGEST_BITS, PLACE_BITS = 60, 62


def digest(column: Column) -> Column:
    """60 bits of an MD5, as a long that is not negative."""
    return F.conv(F.substring(F.md5(column), 1, DIGEST_BITS // 4), 16, 10).cast("long")


WIDTHS = (DIGEST_BITS, DIGEST_BITS, PLACE_BITS)
KEYS = ("_text", "_id", "_place")


@dataclass(frozen=True)
class Span:
    """The keys whose parts before ``level`` are ``fixed``, and whose part there begins with
    the ``bits`` bits ``start``."""

    level: int = 0
    bits: int = 0
    fixed: tuple[int, ...] = ()
    start: int = 0

    def candidate(self, place: int, more: int) -> tuple[int, ...]:
        """The least key at or above ``place``, counted in steps of ``more`` further bits."""
        own = ((self.start << more) + place) << (WIDTHS[self.level] - self.bits - more)
        return (*self.fixed, own, *[0] * (len(WIDTHS) - self.level - 1))

    def step(self, place: int, more: int) -> Span:
        return Span(self.level, self.bits + more, self.fixed, (self.start << more) + place)

    def below(self, part: int) -> Span:
        """All keys that go on after this part."""
        return Span(self.level + 1, 0, (*self.fixed, part), 0)


@dataclass(frozen=True)
class Border:
    """A key, and the bytes and rows below it."""

    key: tuple[int, ...]
    size: int
    rows: int


def _histogram(rows: DataFrame, spans: list[Span], bits: int) -> dict[Span, list[tuple[int, ...]]]:
    """Bytes, rows, least and largest key part between neighbouring candidates of the spans
    (which have level and bits in common). A row per span and candidate reaches the driver;
    the parameters bound their number."""
    level, known = spans[0].level, spans[0].bits
    part, width = F.col(KEYS[level]), WIDTHS[level]
    names = [f"_lead{i}" for i in range(level + 1)]
    lead = [*[F.col(k) for k in KEYS[:level]], F.shiftright(part, width - known) if known else F.lit(0).cast("long")]
    place = F.shiftright(part, width - known - bits).bitwiseAND(F.lit((1 << bits) - 1))
    spots = {(*s.fixed, s.start): s for s in spans}
    parts = rows.select(
        *[c.alias(n) for c, n in zip(lead, names)], place.alias("_at"), part.alias("_part"), "_size"
    )
    if spans != [Span()]:
        wanted = rows.sparkSession.createDataFrame(list(spots), ", ".join(f"{n} long" for n in names))
        parts = parts.join(F.broadcast(wanted), names)
    counted = parts.groupBy(*names, "_at").agg(
        F.sum("_size"), F.count("*"), F.min("_part"), F.max("_part")
    )
    found: dict[Span, list[tuple[int, ...]]] = {s: [] for s in spans}
    for row in counted.collect():
        found[spots[tuple(row[: level + 1])]].append(tuple(row[level + 1 :]))
    return {s: sorted(places) for s, places in found.items()}


def borders(rows: DataFrame, targets: list[tuple[float, float]]) -> list[Border]:
    """For each target (bytes below, tolerance) the nearest candidate of the first round that
    has one within tolerance; if none has, the nearest of all keys. Ties go to the smaller.

    ``rows`` has the key's three parts and ``_size``. After the first round only what lies
    next to an unsettled border is read, from a staged copy. Rows that share a key part are
    not probed by it any further, but by the next one. There are at most as many rounds as the
    key has bits, divided by eight.
    """
    open_, base = {Span(): list(range(len(targets)))}, {Span(): (0, 0)}
    settled: dict[int, Border] = {}
    while open_ and targets:
        level, known = min((s.level, s.bits) for s in open_)
        spans = [s for s in open_ if (s.level, s.bits) == (level, known)]
        first = level == known == 0
        bits = min(WIDTHS[level] - known, NEXT_BITS if known or level else FIRST_BITS)
        for span, places in _histogram(rows, spans, bits).items():
            size, count = base[span]
            edges = [Border(span.candidate(0, bits), size, count)]
            for place, own, n, _, _ in places:
                size, count = size + own, count + n
                edges.append(Border(span.candidate(place + 1, bits), size, count))
            for target in open_.pop(span):
                goal, tolerance = targets[target]
                high = min(max(bisect_left(edges, goal, key=lambda b: b.size), 1), len(places))
                under, over = edges[high - 1], edges[high]
                near = under if goal - under.size <= over.size - goal else over
                place, _, n, least, most = places[high - 1]
                inner = span.below(least) if least == most else span.step(place, bits)
                if abs(near.size - goal) <= tolerance or n == 1 or inner.level == len(WIDTHS):
                    settled[target] = near
                else:
                    open_.setdefault(inner, []).append(target)
                    base[inner] = (under.size, under.rows)
        if first and open_:
            shift = DIGEST_BITS - FIRST_BITS
            spots = sorted({(s.fixed[0] >> shift if s.level else s.start,) for s in open_})
            wanted = F.broadcast(rows.sparkSession.createDataFrame(spots, "_spot long"))
            near_borders = rows.join(wanted, F.shiftright(KEYS[0], shift) == F.col("_spot"), "left_semi")
            rows = stage(near_borders, "shard-borders")
    return [settled[t] for t in range(len(targets))]


def sharded(
    df: DataFrame, shards: int, size: Column, key: Column, tie: Column,
    tolerance: float = TOLERANCE, pieces: int | None = None,
) -> DataFrame:
    """``df`` as one column ``doc`` (a struct of all columns, so that no name can clash), with
    size, shard (from 0) and slot, the row's place in its shard, without gaps from 0.

    ``key`` and ``tie`` are longs of at most 60 bits, not negative, as ``digest`` gives them:
    rows of one key lie together, and in the order of the tie. Each border between shards is
    within ``tolerance`` of a shard's mean size of its target; where a single row is larger,
    the border is the nearest one between two rows. What the rows carry is staged once and
    exchanged once, into ``pieces`` of nearly equal bytes (by default as many as the session
    has shuffle partitions), so no shard is ever one task.

    A size that is null or below 1 counts as 1. Rows equal in key and tie are interchangeable;
    repeated rows count as rows and have slots of their own. An empty table gives none.
    """
    spark = df.sparkSession
    laid = df.select(
        F.struct(*[named(c).alias(c) for c in df.columns]).alias("doc"),
        key.alias(KEYS[0]), tie.alias(KEYS[1]),
        F.greatest(F.coalesce(size.cast("long"), F.lit(1)), F.lit(1)).cast("long").alias("_size"),
    )
    laid = stage(laid.withColumn(KEYS[2], F.monotonically_increasing_id()), "shard-rows")
    total, count = laid.agg(F.sum("_size"), F.count("*")).first()
    if not count:
        return laid.select(
            "doc", F.col("_size").alias("size"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")
        )
    wanted = pieces or min(int(spark.conf.get("spark.sql.shuffle.partitions")), PIECES)
    each = max(1, -(-wanted // shards))
    parts = shards * each
    targets = [
        (total * i / parts, LOOSE * total / parts if i % each else tolerance * total / shards)
        for i in range(1, parts)
    ]
    found = borders(laid.select(*KEYS, "_size"), targets)
    placed = laid.join(F.broadcast(_table(spark, found)), F.shiftright(KEYS[0], DIGEST_BITS - FIRST_BITS) == F.col("_spot"))
    passed = F.filter("_inside", lambda b: b <= F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(KEYS)]))
    placed = placed.withColumn("_piece", F.col("_ahead") + F.size(passed)).drop("_spot", "_ahead", "_inside")
    ordered = placed.repartitionById(parts, F.col("_piece")).sortWithinPartitions(*KEYS)
    # The piece is the partition; the low 33 bits of the id are the place in it.
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    rows = [0, *[b.rows for b in found]]
    starts = F.array(*[F.lit(rows[p] - rows[p - p % each]).cast("long") for p in range(parts)])
    return ordered.withColumn("_within", within).select(
        "doc", F.col("_size").alias("size"),
        F.floor(F.col("_piece") / each).cast("int").alias("shard"),
        (F.element_at(starts, F.col("_piece") + 1) + F.col("_within")).alias("slot"),
    )


def _table(spark, found: list[Border]) -> DataFrame:
    """For each first-round span of keys the number of borders at or below its start, and the
    borders within it: as many rows as the first round has candidates."""
    shift = DIGEST_BITS - FIRST_BITS
    keys = [b.key for b in found]
    edges = [bisect_right(keys, (i << shift, 0, 0)) for i in range(1 << FIRST_BITS)] + [len(keys)]
    last = [bisect_left(keys, ((i + 1) << shift, 0, 0)) for i in range(1 << FIRST_BITS)]
    rows = [(i, edges[i], keys[edges[i] : last[i]]) for i in range(1 << FIRST_BITS)]
    return spark.createDataFrame(
        rows, "_spot long, _ahead int, _inside array<struct<k0: long, k1: long, k2: long>>"
    )


def write_shards(rows: DataFrame, path: str) -> None:
    """The sharded rows below ``path``, a folder ``shard=n`` for each shard, the files of a
    shard in the order of its slots."""
    taken = {c.lower() for c in rows.schema["doc"].dataType.names}
    clash = taken & {"shard", "slot"}
    if clash:
        raise ValueError(f"columns named {sorted(clash)} would clash with the shards'; rename them first")
    rows.select("doc.*", "slot", "shard").write.partitionBy("shard").parquet(path)
