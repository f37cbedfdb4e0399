"""The prefix trie of conversations, from sorted neighbours.

Conversations are sequences of turns. Sorted, each node of their trie is a run of neighbours,
and how deep the longest common prefix (LCP) of two neighbours is says where their paths part.
In each sorted partition a union-find joins neighbours along these edges, deepest first: every
joining makes a branching node, and the chains between branching nodes are the other nodes.

A partition's forest is complete but for the paths of its first and last sequence, whose nodes
may go on in the next partition. It is contracted to these two border paths; nodes of equal
prefix are merged across borders. Every figure of a node is a sum over its run, so merging adds
pieces up and corrects for the edge that crosses each border.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from stocktake.llm.shared import named
from stocktake.operators.ordered import ordered_groups
from stocktake.session import stage

WIDTH = 16  # bytes of a turn's digest
ROWS = 10_000  # in a batch that a task gives back
EMPTY = hashlib.sha256(b"").hexdigest()
FAMILY = 5  # conversations that begin with the turns of their family's first
BORROWED = 8  # turns of it, at most

_NODE, _PIECE, _ENDS = 0, 1, 2
_FOUND = (
    "kind int, part int, depth long, key binary, parent_key binary, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, shared long, before long, upto long, "
    "is_first boolean, is_last boolean, ending boolean, ends string"
)
_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
_ARROW = pa.schema([(n, _TYPES[t]) for n, t in (c.split() for c in _FOUND.split(", "))])


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), digest and size (bytes of the text) of every turn.

    Turns are ordered by ``turn``, null first; equal ones by their digest. A null role or text
    is empty. Rows without conv_id belong to no conversation. A conversation that holds most
    rows is numbered in slices.
    """
    role = F.coalesce(named("role").cast("string"), F.lit("")).cast("binary")
    text = F.coalesce(named("text"), F.lit("")).cast("binary")
    both = F.concat(F.md5(role).cast("binary"), text)
    narrow = conversations.where(named("conv_id").isNotNull()).select(
        named("conv_id").cast("long").alias("conv_id"),
        named("turn").isNotNull().alias("timed"), named("turn").alias("turn"),
        F.unhex(F.md5(both)).alias("digest"), F.octet_length(text).cast("long").alias("size"),
    )
    groups = ordered_groups(stage(narrow, "trie-rows"), ["conv_id"], ["timed", "turn", "digest"])
    placed = groups.running(sums={"place": F.lit(1)}).rows()
    return stage(placed.select("conv_id", "place", "digest", "size"), "trie-places")


def borrowed_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % (BORROWED + 1)).cast("int")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations (conv_id, depth, digest, size, total: its number of
    turns) and all conversations (conv_id).

    A conversation begins with the first h turns of its family's first conversation, where
    there is one, and goes on with its own after its first h.
    """
    own, family = borrowed_turns(F.col("conv_id")), F.col("conv_id") - F.col("conv_id") % FAMILY
    lists = (
        turns.where((F.col("place") <= BORROWED) & (F.col("conv_id") == family))
        .groupBy(F.col("conv_id").alias("family"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "size"))).alias("head"))
    )
    head = F.coalesce(F.slice("head", F.lit(1), own), F.array())
    ahead = F.when(F.col("head").isNull(), 0).otherwise(F.least(F.size("head"), own)).cast("long")
    convs = (
        turns.groupBy("conv_id").agg(F.max("place").alias("n"))
        .withColumn("family", family)
        .join(lists, "family", "left")
        .select("conv_id", "head", ahead.alias("ahead"), (ahead + F.greatest(F.col("n") - own, F.lit(0))).alias("total"))
    )
    convs = stage(convs, "trie-convs")
    head = F.slice("head", F.lit(1), F.col("ahead").cast("int"))
    taken = convs.where("ahead > 0").select("conv_id", "total", F.explode(head).alias("t"))
    first = taken.select("conv_id", F.col("t.place").alias("depth"), "t.digest", "t.size", "total")
    rest = turns.where(F.col("place") > own).join(convs.select("conv_id", "ahead", "total"), "conv_id")
    rest = rest.select("conv_id", (F.col("ahead") + F.col("place") - own).alias("depth"), "digest", "size", "total")
    return stage(first.unionByName(rest), "trie-turns"), convs.select("conv_id")


class _Node:
    """A run of sorted sequences that have their first ``depth`` turns in common."""

    __slots__ = ("depth", "low", "high", "least", "shared", "leaves", "ends", "children", "n_children")

    def __init__(self, depth, low, high, least, shared, leaves, ends, children, n_children):
        self.depth, self.low, self.high, self.least = depth, low, high, least
        self.shared, self.leaves, self.ends = shared, leaves, ends
        self.children, self.n_children = children, n_children


def _common(a: bytes, b: bytes) -> int:
    """Turns that two sequences begin with in common."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    differ = np.frombuffer(a, "u1", n) != np.frombuffer(b, "u1", n)
    return int(differ.argmax()) // WIDTH


def _path(sequence: bytes) -> list[bytes]:
    """Digests of all prefixes of a sequence, the empty one first."""
    state, keys = hashlib.blake2b(digest_size=WIDTH), []
    keys.append(state.digest())
    for at in range(0, len(sequence), WIDTH):
        state.update(sequence[at : at + WIDTH])
        keys.append(state.digest())
    return keys


class _Forest:
    """The trie of one partition's sorted sequences."""

    def __init__(self, part: int):
        self.part, self.convs, self.lengths, self.common = part, [], [], []
        self.sums, self.cut = [], []
        self.first = self.last = b""

    def add(self, conv: int, sequence: bytes, sizes: list[int], cut: bool) -> None:
        self.common.append(_common(self.last, sequence) if self.convs else 0)
        if not self.convs:
            self.first = sequence
        self.last = sequence
        self.convs.append(conv)
        self.lengths.append(len(sequence) // WIDTH)
        self.sums.append(np.concatenate(([0], np.cumsum(sizes, dtype="int64"))))
        self.cut.append(cut)

    def rows(self) -> Iterator[tuple]:
        """All nodes: complete ones, and pieces of those that the first or last sequence is in."""
        self.top = len(self.convs) - 1
        self.paths = _path(self.first), _path(self.last)
        nodes = [
            _Node(n, i, i, c, 0, 1, 0 if cut else 1, [], 1 if cut else 0)
            for i, (n, c, cut) in enumerate(zip(self.lengths, self.convs, self.cut))
        ]
        parent = list(range(len(nodes)))

        def find(i: int) -> int:
            while parent[i] != i:
                parent[i] = i = parent[parent[i]]
            return i

        edges = sorted(range(1, len(nodes)), key=lambda i: -self.common[i])
        for depth, level in groupby(edges, key=lambda i: self.common[i]):
            touched = set()
            for i in level:
                left, right = find(i - 1), find(i)
                parent[right] = left
                nodes[left] = self._join(nodes[left], nodes[right], i, depth)
                touched.discard(right)
                touched.add(left)
            for root in touched:
                yield from self._children(nodes[find(root)])
        root = nodes[find(0)]
        if root.depth:
            root = _Node(0, 0, self.top, root.least, root.shared, root.leaves, 0, [root], 1)
            yield from self._children(root)
        yield from self._row(root, 0, None)

    def _join(self, a: _Node, b: _Node, edge: int, depth: int) -> _Node:
        """Left and right of an edge become one node at the edge's depth. A part that is deeper
        is its child; one of this depth is the node itself, or a copy that ends here too."""
        if a.depth > depth:
            a = _Node(depth, a.low, a.high, a.least, a.shared, a.leaves, 0, [a], 1)
        if b.depth > depth:
            a.children.append(b)
            a.n_children += 1
        else:
            a.ends += b.ends
        a.high, a.least = b.high, min(a.least, b.least)
        a.shared += b.shared + int(self.sums[edge][depth])
        a.leaves += b.leaves - (self.lengths[edge - 1] == depth)
        return a

    def _children(self, node: _Node) -> Iterator[tuple]:
        for child in node.children:
            for depth in range(child.depth, node.depth, -1):
                yield from self._row(child, depth, node if depth == node.depth + 1 else child)
        node.children = []

    def _border(self, node: _Node) -> bool:
        return node.low == 0 or node.high == self.top

    def _key(self, node: _Node, depth: int) -> bytes:
        return self.paths[0 if node.low == 0 else 1][depth]

    def _row(self, node: _Node, depth: int, above: _Node | None) -> Iterator[tuple]:
        n, sums = node.high - node.low + 1, self.sums[node.low]
        before, upto = (int(sums[depth - 1]), int(sums[depth])) if depth else (0, 0)
        own = depth == node.depth
        children = node.n_children if own else 1
        ids = ",".join(map(str, self.convs[node.low : node.low + node.ends])) if own else ""
        if self._border(node):
            key, parent = self._key(node, depth), self._key(node, depth - 1) if depth else None
            last = node.high == self.top
            yield (
                _PIECE, self.part, depth, key, parent, node.least, None, n, children, node.leaves, node.shared,
                before, upto, node.low == 0, last, last and depth == self.lengths[self.top], None,
            )
            if ids:
                yield (_ENDS, self.part, depth, key, *[None] * 12, ids)
            return
        open_ = self._border(above)
        yield (
            _NODE, self.part, depth, None, self._key(above, depth - 1) if open_ else None, node.least,
            None if open_ else above.least, n, children, node.leaves, node.shared, before, upto, False, False, False,
            hashlib.sha256(ids.encode()).hexdigest(),
        )


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = _Forest(TaskContext.get().partitionId())
    for batch in batches:
        columns = [batch.column(c) for c in ("conv_id", "sequence", "sizes", "cut")]
        for conv, sequence, sizes, cut in zip(*columns):
            forest.add(conv.as_py(), sequence.as_py(), sizes.as_py(), cut.as_py())
    if forest.convs:
        yield from _batches(forest.rows())


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One SHA-256 for each key from its lists of ids, which come sorted; they are never held
    together."""

    def closed(key, state):
        return pa.RecordBatch.from_pydict({"key": [key], "ends": [state.hexdigest()]})

    key = state = None
    for batch in batches:
        for own, ids in zip(batch.column("key"), batch.column("ends")):
            own, ids = own.as_py(), ids.as_py().encode()
            if own == key:
                state.update(b"," + ids)
                continue
            if key is not None:
                yield closed(key, state)
            key, state = own, hashlib.sha256(ids)
    if key is not None:
        yield closed(key, state)


def _merged(found: DataFrame) -> DataFrame:
    """Pieces of equal prefix as one node each.

    The first sequence of a partition goes on from the last of the one before as deep as their
    paths have equal keys. Above that depth the child that both pieces have counts once; the
    last sequence before the border is no leaf if the next one contains it; and the turns that
    the two share count as shared.
    """
    pieces = found.where(F.col("kind") == _PIECE)
    # A row per partition.
    order = W.Window.orderBy("part")
    parts = pieces.where("depth = 0").select("part", F.lag("part").over(order).alias("prior"))
    left = pieces.where("is_first").join(parts, "part").select("part", "prior", "depth", "key", "upto")
    right = pieces.where("is_last").select(F.col("part").alias("prior"), "depth", "key", "ending")
    reach = (
        left.join(right, ["prior", "depth", "key"])
        .groupBy("part")
        .agg(F.max("depth").alias("reach"), F.max_by("upto", "depth").alias("across"), F.max_by("ending", "depth").alias("ended"))
    )
    joined = pieces.join(reach, "part", "left")
    on = F.coalesce(F.col("is_first") & (F.col("depth") <= F.col("reach")), F.lit(False))
    sums = (
        joined.groupBy("key").agg(
            F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"),
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
            F.sum(F.col("n_children") - F.when(on & (F.col("depth") < F.col("reach")), 1).otherwise(0)).alias("n_children"),
            F.sum(F.col("n_leaves") - F.when(on & F.col("ended"), 1).otherwise(0)).alias("n_leaves"),
            F.sum(F.col("shared") + F.when(on, F.col("across")).otherwise(0)).alias("shared"),
            F.max("before").alias("before"),
        )
    )
    lists = found.where(F.col("kind") == _ENDS).select("key", "part", "ends")
    ends = lists.repartition("key").sortWithinPartitions("key", "part").select("key", "ends")
    ends = ends.mapInArrow(_hashed, "key binary, ends string")
    return stage(sums.join(ends, "key", "left"), "trie-borders")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for every node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens and ends_sha256.

    ``turns`` has conv_id, depth, digest, size and total, ``convs`` every conversation, also
    those without turns, which are members of the root only. Turns behind the first one that no
    other conversation has at its place are cut off before sorting: their nodes are a chain
    with one member. So no conversation is held beyond what it may share with another one. No
    conversations give no nodes, not even a root.
    """
    alone = (
        turns.groupBy("depth", "digest").agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"))
        .where("n = 1")
        .groupBy("conv_id").agg(F.min("depth").alias("cut"))
    )
    cut = turns.join(stage(alone, "trie-cuts"), "conv_id", "left")
    beyond = F.coalesce(F.col("depth") > F.col("cut"), F.lit(False))
    paths = (
        cut.where(~beyond).groupBy("conv_id")
        .agg(
            F.sort_array(F.collect_list(F.struct("depth", "digest", "size"))).alias("path"),
            F.max(F.coalesce(F.col("cut") < F.col("total"), F.lit(False))).alias("cut"),
        )
    )
    path = F.coalesce("path", F.array())
    sequences = convs.join(paths, "conv_id", "left").select(
        "conv_id",
        F.unhex(F.concat_ws("", F.transform(path, lambda t: F.hex(t["digest"])))).alias("sequence"),
        F.transform(path, lambda t: t["size"]).alias("sizes"),
        F.coalesce("cut", F.lit(False)).alias("cut"),
    )
    ordered = sequences.repartitionByRange("sequence", "conv_id").sortWithinPartitions("sequence", "conv_id")
    found = stage(ordered.mapInArrow(_forests, _FOUND), "trie-forests")
    border = _merged(found)
    saved = F.col("shared") - (F.col("n_convs") - 1) * F.col("before")
    columns = ["conv_id", "depth", "parent_key", "parent_conv_id", "n_convs", "n_children", "n_leaves"]
    inner = found.where(F.col("kind") == _NODE).select(*columns, saved.alias("saved_tokens"), "ends")
    none = F.lit(None).cast("long").alias("parent_conv_id")
    outer = border.select(
        *[none if c == "parent_conv_id" else c for c in columns], saved.alias("saved_tokens"),
        F.coalesce("ends", F.lit(EMPTY)).alias("ends"),
    )
    above = border.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    shared = inner.unionByName(outer).join(above, "parent_key", "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "_above").alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.col("ends").alias("ends_sha256"),
    )
    one, last = F.lit(1).cast("long"), F.col("depth") == F.col("total")
    chains = cut.where(beyond).select(
        "conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), one.alias("n_convs"),
        F.when(last, 0).otherwise(1).cast("long").alias("n_children"), one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(last, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).otherwise(EMPTY).alias("ends_sha256"),
    )
    return shared.unionByName(chains)
