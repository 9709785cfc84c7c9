"""Approximate nearest neighbours by collision counting over query-centred windows.

Each vector has a position on PROJECTIONS random lines, one sorted array per line. A query looks at a window around its own
position on every line; a vector that lies in many of the windows collides often, and is verified by its exact
inner product. A wider radius widens the windows (virtual rehashing), and the same arrays serve. The radius grows
to the distance of the k-th best vector found; then all vectors inside it have had their chance.

Inner products become distances by one more coordinate: vectors are scaled into the unit ball and lifted to its
surface, queries to unit length, so the largest product is the smallest distance.

Vectors and queries are cut into blocks by hash of their id; every pair of blocks is one task's work, and the best of all
blocks are merged. Each row is indexed, and no bucket or candidate list has a limit.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from stratalake.sources.scratch import stage

NEAREST = 20
PROJECTIONS = 128
#: Half a window in units of the expected offset of a vector at the current radius, and the share of such vectors that collide.
HALF_WINDOW, COLLIDES = 1.0, 0.6827
#: A vector is verified if its collisions reach the expected number for the radius less so many standard deviations.
TOLERANCE = 2.0
FIRST_RADIUS, WIDER = 1.0, 1.15
VECTORS_A_BLOCK, QUERIES_A_BLOCK = 8192, 4096


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, vector`` (doubles) of the rows with an id and a vector that is finite and not zero."""
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(F.col("id").isNotNull() & ~F.coalesce(odd, F.lit(True)) & F.exists("vector", lambda x: x != 0))


def lines(dimensions: int) -> np.ndarray:
    """Unit vectors of the lines, in groups that are orthogonal to each other."""
    random = np.random.default_rng(20_240_603)
    found = []
    while sum(map(len, found)) < PROJECTIONS:
        found.append(np.linalg.qr(random.standard_normal((dimensions, dimensions)))[0].T)
    return np.concatenate(found)[:PROJECTIONS]


class CollisionIndex:
    """The sorted arrays of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        # Smaller ids first, so that a stable order by score breaks ties.
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        norms = np.sqrt((self.vectors**2).sum(axis=1))
        self.scale = norms.max()
        lift = np.sqrt(np.maximum(0.0, 1.0 - (norms / self.scale) ** 2))
        self.lines = lines(vectors.shape[1] + 1)
        positions = self.lines @ np.column_stack([self.vectors / self.scale, lift]).T
        order = np.argsort(positions, axis=1)
        # All sorted arrays in one, each on a stretch of its own: positions lie between -1 and 1.
        self.offsets = 4.0 * np.arange(PROJECTIONS)
        self.sorted = (np.take_along_axis(positions, order, axis=1) + self.offsets[:, None]).ravel()
        #: Place of each vector in the sorted array of each line.
        self.places = np.empty(order.shape, np.uint16 if len(ids) <= 2**16 else np.uint32)
        np.put_along_axis(self.places, order, np.arange(len(ids), dtype=self.places.dtype)[None, :], axis=1)
        self.by_component = np.ascontiguousarray(self.vectors.T)
        mean, spread = PROJECTIONS * COLLIDES, math.sqrt(PROJECTIONS * COLLIDES * (1 - COLLIDES))
        self.usual_radius = FIRST_RADIUS
        self.threshold = mean - TOLERANCE * spread

    def scores(self, query: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact inner products, summed from the first component to the last."""
        products = np.take(self.by_component, rows, axis=1) * query[:, None]
        total = products[0].copy()
        for line in products[1:]:
            total += line
        return total

    def collisions(self, own: np.ndarray, half: float) -> np.ndarray:
        """In how many of the windows around a query each vector lies. Binary search in the sorted arrays gives a window's
        ends; a vector lies in it if its place does."""
        n = len(self.ids)
        ends = np.concatenate([np.maximum(own - half, -1.5) + self.offsets, np.minimum(own + half, 1.5) + self.offsets])
        low, high = np.searchsorted(self.sorted, ends).reshape(2, -1) - n * np.arange(PROJECTIONS)
        kind = self.places.dtype
        inside = (self.places - low.astype(kind)[:, None]) < (high - low).astype(kind)[:, None]
        # A window over all n places of 2**16 would be 0 wide in 16 bits.
        inside[high - low == n] = True
        return np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)

    def nearest(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        length = math.sqrt(float(query @ query))
        own = self.lines[:, :-1] @ (query / length)
        available = len(self.ids) - int((self.ids == query_id).sum())
        k = min(k, available)
        if not k:
            return np.empty(0, np.int64), np.empty(0)
        verified = self.ids == query_id
        rows, scores = np.empty(0, np.int64), np.empty(0)
        radius = 0.0
        while True:
            if not radius:
                # About what queries before needed; too small or too large a start costs time only.
                radius = self.usual_radius
            elif len(rows) < k:
                radius *= WIDER
            else:
                # Distance of the k-th best so far: nothing beyond it can enter.
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                needed = math.sqrt(max(0.0, 2 - 2 * kth / (length * self.scale))) + 1e-12
                if needed <= radius:
                    self.usual_radius += 0.1 * (needed - self.usual_radius)
                    break
                radius = needed
            counts = self.collisions(own, HALF_WINDOW * radius / math.sqrt(self.lines.shape[1]))
            fresh = np.flatnonzero((counts >= self.threshold) & ~verified)
            verified[fresh] = True
            rows, scores = np.concatenate([rows, fresh]), np.concatenate([scores, self.scores(query, fresh)])
            if len(rows) == available:
                break
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[best]], scores[best]


def nearest_neighbours(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = NEAREST,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    vectors_a_block: int = VECTORS_A_BLOCK,
    queries_a_block: int = QUERIES_A_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query its ``k`` nearest vectors found, largest inner product first.

    Rows with the query's own id are no candidates. Ties go to the smaller id; repeated rows are candidates of their own.
    With fewer candidates than ``k``, all are returned. Rows without an id, and vectors that are null, empty, zero, or
    hold a null or non-finite component, take no part; vectors of another length than the query's are not compared with it.
    Empty tables give no rows; other columns are ignored.
    """
    base = stage(usable(vectors, id_column, vector_column), "ann_vectors")
    asked = stage(usable(queries, id_column, vector_column), "ann_queries")
    n_blocks = max(1, math.ceil(base.count() / vectors_a_block))
    n_query_blocks = max(1, math.ceil(asked.count() / queries_a_block))

    def dealt(rows: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int").alias(own)
        others = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other)
        return rows.select("id", "vector", F.size("vector").alias("dimensions"), block, others)

    def search(block: pa.Table, asking: pa.Table) -> pa.Table:
        columns: list[list] = [[], [], []]
        if block.num_rows and asking.num_rows:
            index = CollisionIndex(block["id"].to_numpy(), _matrix(block))
            for query_id, query in zip(asking["id"].to_pylist(), _matrix(asking)):
                ids, scores = index.nearest(query_id, query, k)
                columns[0].append(np.full(len(ids), query_id))
                columns[1].append(ids)
                columns[2].append(scores)
        joined = [np.concatenate(c) if c else np.empty(0) for c in columns]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(joined, types)], names=["query_id", "vec_id", "score"])

    keys = ["block", "query_block", "dimensions"]
    blocks = dealt(base, "block", n_blocks, "query_block", n_query_blocks).groupBy(*keys)
    asking = dealt(asked, "query_block", n_query_blocks, "block", n_blocks).groupBy(*keys)
    found = blocks.cogroup(asking).applyInArrow(search, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _matrix(rows: pa.Table) -> np.ndarray:
    column = rows["vector"].combine_chunks()
    return np.asarray(column.flatten()).reshape(len(column), -1)
