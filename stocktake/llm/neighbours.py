"""Nearest neighbours by a block matrix join: exact top-k inner products.

Vectors are quantised to int8 with one scale each, and packed into blocks. A tile is the
product of a query block and a candidate block. The quantised products bound the true ones:
with q = q' + e and c = c' + f, q.c differs from q'.c' by at most |e||c| + |q'||f|. Vectors
are scaled by powers of two first, so that no bound of a finite vector overflows. Per query
the k-th best lower bound, and the k-th best score found so far, rule out most candidates;
the survivors are recomputed from the original vectors in double precision and kept in a
heap. Recall is therefore 1.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from stocktake.llm.shared import named
from stocktake.session import stage

NEAREST = 20
QUERY_BLOCK = 1024
BLOCK = 8192  # candidates
_ROUNDING = 1e-5  # relative slack of the bounds: products are computed in single precision


def usable(vector: Column) -> Column:
    """Neither null nor zero, and every component a finite number."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (id, vector, dim) packed into blocks of about ``size``: dim, block, ids and the
    components of all vectors."""
    counts = rows.groupBy("dim").agg(F.count("*").alias("n"))
    # One row per dimension that occurs.
    dealt = rows.join(counts, "dim").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / size)).cast("int")
    )
    return (
        dealt.groupBy("dim", "block")
        .agg(F.collect_list(F.struct("id", "vector")).alias("rows"))
        .select("dim", "block", F.col("rows.id").alias("ids"), F.flatten("rows.vector").alias("flat"))
    )


class _Block:
    def __init__(self, ids: pa.Scalar, flat: pa.Scalar, dim: int):
        self.ids = ids.values.to_numpy()
        self.vectors = flat.values.to_numpy().reshape(-1, dim).astype(np.float64)
        top = np.abs(self.vectors).max(axis=1)
        # Divided by a power of two, the largest component lies from 1 to 2.
        self.power = np.frexp(top)[1] - 1
        unit = np.ldexp(self.vectors, -self.power[:, None])
        self.scale = np.ldexp(top, -self.power) / 127.0
        self.int8 = np.rint(unit / self.scale[:, None]).astype(np.int8)
        near = self.int8 * self.scale[:, None]
        self.norm = np.linalg.norm(unit, axis=1)
        self.near_norm = np.linalg.norm(near, axis=1)
        self.error = np.linalg.norm(unit - near, axis=1)


def _exact(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component to the last."""
    total = np.zeros(len(rows))
    for d in range(len(query)):
        total += query[d] * rows[:, d]
    return total


def _tile(q: _Block, c: _Block, best: list[list[tuple[float, int]]], k: int) -> None:
    """Adds the candidates of ``c`` to the heaps of the queries: (score, -id), worst on top."""
    dim = q.vectors.shape[1]
    exact_in_single = dim * 127 * 127 < 1 << 24
    kind = np.float32 if exact_in_single else np.float64
    dots = (q.int8.astype(kind) @ c.int8.astype(kind).T).astype(np.float64)
    middle = dots * q.scale[:, None] * c.scale[None, :]
    reach = q.error[:, None] * c.norm[None, :] + q.near_norm[:, None] * c.error[None, :]
    reach += _ROUNDING * q.norm[:, None] * c.norm[None, :]
    # The query's own power is left out: it is the same for all its candidates. What is beyond
    # the largest number or under the smallest keeps its order, or becomes a tie.
    power = np.ldexp(1.0, c.power)
    for i, own in enumerate(q.ids):
        heap = best[i]
        upper = (middle[i] + reach[i]) * power
        floor = np.ldexp(heap[0][0], -q.power[i]) if len(heap) == k else -np.inf
        # One more than k, since one candidate may be the query's own.
        if len(c.ids) > k + 1:
            lower = (middle[i] - reach[i]) * power
            floor = max(floor, np.partition(lower, len(lower) - k - 1)[len(lower) - k - 1])
        some = np.flatnonzero(~(upper < floor))
        some = some[c.ids[some] != own]
        if not len(some):
            continue
        scores = _exact(q.vectors[i], c.vectors[some])
        order = np.lexsort((c.ids[some], -scores))[:k]
        for score, candidate in zip(scores[order].tolist(), c.ids[some][order].tolist()):
            item = (score, -candidate)
            if len(heap) < k:
                heapq.heappush(heap, item)
            elif item > heap[0]:
                heapq.heapreplace(heap, item)
            else:
                break


def nearest(
    queries: DataFrame, rows: DataFrame, k: int = NEAREST, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Each query's ``k`` nearest rows by inner product: query_id, rank (from 1), vec_id, score.

    A row with the query's own id is no candidate; ties go to the smaller id; fewer rows give
    all of them. Vectors that are null, zero or empty, or hold a null or a non-finite number,
    take no part, and neither do rows without an id. Only vectors of equal length meet. A row
    that repeats id and vector counts once; of several vectors under one id each is a
    candidate, scored under that id, and the least one is the query. Other columns are left
    out. Empty tables give an empty result. Vectors of any magnitude take part; a score beyond
    the range of doubles is infinite, or NaN where infinities of both signs meet in its sum.

    Blocks hold a bounded number of vectors, dealt by a hash of the id, and only blocks meet:
    every query block is sent to every candidate block of its length. A candidate block is
    one task's work against one query block; k rows per query leave it.
    """
    def clean(df: DataFrame) -> DataFrame:
        values = F.transform(named(vector), lambda x: x.cast("double"))
        return (
            df.select(named(key).cast("long").alias("id"), values.alias("vector"))
            .where(F.col("id").isNotNull() & usable(F.col("vector")))
            .withColumn("dim", F.size("vector"))
        )

    asked = clean(queries).groupBy("id", "dim").agg(F.min("vector").alias("vector"))
    asked = asked.withColumn("least", F.min("vector").over(W.Window.partitionBy("id")))
    asked = asked.where(F.col("vector") == F.col("least")).drop("least")
    query_blocks = stage(_blocks(stage(asked, "queries"), QUERY_BLOCK), "query-blocks")
    row_blocks = stage(_blocks(stage(clean(rows).distinct(), "vectors"), BLOCK), "vector-blocks")
    numbers = row_blocks.select("dim", "block")
    # A row per tile: which blocks meet is known from their numbers, the vectors follow.
    left = query_blocks.select("dim", F.col("ids").alias("q_ids"), F.col("flat").alias("q")).join(numbers, "dim")
    tiles = left.join(
        row_blocks.select("dim", "block", F.col("ids").alias("c_ids"), F.col("flat").alias("c")),
        ["dim", "block"],
    ).select("dim", "q_ids", "q", "c_ids", "c")

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {}
        for batch in batches:
            for dim, q_ids, q, c_ids, c in zip(*batch.columns):
                dim = dim.as_py()
                one = _Block(q_ids, q, dim)
                two = seen.get("c")
                if two is None or not np.array_equal(two.ids, c_ids.values.to_numpy()):
                    two = seen["c"] = _Block(c_ids, c, dim)
                best: list[list[tuple[float, int]]] = [[] for _ in one.ids]
                _tile(one, two, best, k)
                found = [(own, -n, s) for own, heap in zip(one.ids.tolist(), best) for s, n in heap]
                if found:
                    ids, others, scores = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids, pa.int64()), pa.array(others, pa.int64()), pa.array(scores, pa.float64())],
                        names=["query_id", "vec_id", "score"],
                    )

    found = tiles.mapInArrow(searched, "query_id long, vec_id long, score double")
    order = W.Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
