"""Exact top-k search by inner product as a Voronoi join.

With one more component, sqrt(M^2 - |x|^2) for vectors and 0 for queries (M: the
largest norm), the largest inner products are the smallest distances. Pivots are
a sample of the vectors, as many as the square root of their number; every
vector and every query belongs to the cell of its nearest pivot.

1. Each cell is summed up by its size, its radius, and the distances from the
   pivot to the k + 1 nearest vectors, of one row for each vec_id.
2. By the triangle inequality the summaries give each cell of queries a distance
   within which k + 1 vectors of different vec_id are sure to lie, at most one of
   them a query's own, and each query a bound that is lower still.
3. Cells near each other share a block; a cell of more than ``BLOCK`` vectors is
   cut into rings by the distance from its pivot, and a ring of too many equal
   distances into parts. A query goes only to the blocks that can hold a vector
   within its bound: those of cells near enough, and of these the rings whose
   distances differ from its own by no more than the bound.
4. Each block solves its queries; the best of all blocks are the answer.

Components are floor(1024 * x) as integers; scores are exact below 2**53.
Vectors that are null, empty or hold null or non-finite components, and rows
with a null vec_id, take no part; nor do vectors of another length than the
commonest (of equally common ones, the longest). Ties go to the smaller vec_id.
A row whose vec_id repeats is a candidate of its own, but no row is a candidate
for a query of equal vec_id; a repeated query row gives one answer. An empty
table gives no rows. Columns other than vec_id and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import drop_written, finite, matrix, runs, table, written

#: Pivots at least, vectors of a block, queries solved at once, and rings of a cell at most (a larger ring is dealt by hash).
PIVOTS, BLOCK, AT_ONCE, RINGS = 64, 8192, 512, 64


def raised(x: np.ndarray, norm: float | None) -> np.ndarray:
    """Vectors with the component that makes all norms equal, or queries (no norm) with 0."""
    last = np.zeros(len(x)) if norm is None else np.sqrt(np.maximum(norm * norm - (x * x).sum(1), 0))
    return np.concatenate([x, last[:, None]], 1)


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1), 0))


@dataclass
class Summary:
    """What is known of the cells, in the order of their pivots, and how they lie in blocks."""

    pivots: np.ndarray
    radius: np.ndarray
    owner: np.ndarray  # cells of the sure distances
    sure: np.ndarray
    slack: float  # what rounding can make of a distance
    block: np.ndarray  # of each piece: its block, cell, least and largest distance, and parts
    cell: np.ndarray
    low: np.ndarray
    high: np.ndarray
    parts: np.ndarray

    def bound(self, far: np.ndarray, k: int) -> np.ndarray:
        """Per query (its distances to all pivots) a distance that k + 1 vectors are sure not to exceed."""
        if len(self.sure) <= k:
            return np.full(len(far), np.inf)
        return np.partition(far[:, self.owner] + self.sure, k, axis=1)[:, k] + self.slack

    def needed(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Queries and pieces that have to meet; queries of one cell are decided together before each by itself."""
        far = distances(queries, self.pivots)
        home, rows, pieces = far.argmin(1), [], []
        for cell in np.unique(home):
            mine = np.flatnonzero(home == cell)
            bound = self.bound(far[mine], k)
            # of the whole group: its radius, the distances between pivots, and its largest bound
            reach = distances(self.pivots[cell : cell + 1], self.pivots)[0] - far[mine, cell].max() - self.radius - bound.max()
            near = np.flatnonzero(reach[self.cell] <= self.slack)
            away = far[np.ix_(mine, self.cell[near])]
            meets = (away - self.high[near] <= bound[:, None] + self.slack) & (self.low[near] - away <= bound[:, None] + self.slack)
            i, j = np.nonzero(meets)
            rows.append(mine[i])
            pieces.append(near[j])
        return np.concatenate(rows), np.concatenate(pieces)


def _summary(placed: DataFrame, pivots: np.ndarray, k: int, norm: float, block: int) -> Summary:
    """One row per cell and ring comes to the driver, about as many as there are pivots and blocks."""
    # the k + 1 smallest distances of each cell: of each part first, then of the whole cell;
    # a vec_id counts once in all cells, since no row of it is a candidate for its own query
    part = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    single = placed.groupBy("vec_id").agg(F.min(F.struct("distance", "cell")).alias("s"))
    near = single.select("s.cell", "s.distance", part.alias("part")).withColumn("r", F.row_number().over(W.partitionBy("cell", "part").orderBy("distance"))).where(F.col("r") <= k + 1)
    nearest = near.withColumn("r", F.row_number().over(W.partitionBy("cell").orderBy("distance"))).where(F.col("r") <= k + 1).select("cell", "distance").collect()
    sizes = {r.cell: r for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")).collect()}
    radius = np.array([sizes[j].high if j in sizes else -np.inf for j in range(len(pivots))])
    slack = 1e-9 * (norm + 1) + 1e-6 * norm**0.5
    # neighbouring cells one after the other: by the nearest of a few pivots, then by the distance from it
    few = distances(pivots, pivots[: max(1, round(len(pivots) ** 0.5))])
    order = np.lexsort((few.min(1), few.argmin(1)))
    pieces: list[tuple[int, int, float, float, int]] = []
    at = filled = 0
    for cell in (int(c) for c in order if int(c) in sizes):
        r = sizes[cell]
        if r.n <= block:
            if filled and filled + r.n > block:
                at, filled = at + 1, 0
            filled += r.n
            pieces.append((at, cell, r.low, r.high, 1))
    at += 1
    if any(r.n > block for r in sizes.values()):
        # all large cells at once: their cuts, and then what lies between them
        share = [i / RINGS for i in range(1, RINGS)]
        large = placed.groupBy("cell").agg(F.count("*").alias("n"), F.percentile_approx("distance", F.lit(share), F.lit(10000)).alias("at")).where(F.col("n") > block)
        wanted = F.least(F.lit(RINGS), F.ceil(F.col("n") / block)).cast("int")
        cuts = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(wanted - 1, F.lit(1))), lambda i: F.get("at", F.floor(i * (RINGS - 1) / wanted).cast("int"))))
        ringed = placed.select("cell", "distance").join(large.select("cell", cuts.alias("cuts")), "cell").select("cell", "distance", F.size(F.filter("cuts", lambda c: F.col("distance") > c)).alias("ring"))
        for r in ringed.groupBy("cell", "ring").agg(F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")).orderBy("cell", "ring").collect():
            parts = -(-r.n // block)
            pieces.append((at, r.cell, r.low, r.high, parts))
            at += parts
    columns = list(zip(*pieces, strict=True))
    return Summary(pivots, radius, np.array([r.cell for r in nearest], int), np.array([r.distance for r in nearest]), slack, *(np.array(c) for c in columns))


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of one query's scores, ties to the smaller id; what is not finite is none."""
    best = np.flatnonzero(score >= (np.partition(score, -k)[-k] if len(score) > k else -np.inf))
    best = best[np.lexsort((ids[best], -score[best]))][:k]
    return best[np.isfinite(score[best])]


def search(vectors: DataFrame, is_query, k: int, n_pivots: int | None = None, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``vectors`` (vec_id, x as long components) that ``is_query`` picks, its k best others."""
    spark = vectors.sparkSession
    out_schema = "query_id long, rank int, vec_id long, score long"
    squares = F.aggregate("x", F.lit(0.0), lambda total, v: total + v.cast("double") * v.cast("double"))
    widths = vectors.groupBy(F.size("x").alias("width")).agg(F.count("*").alias("n"), F.max(squares).alias("most")).orderBy(F.desc("n"), F.desc("width")).limit(1).collect()
    if not widths:
        return spark.createDataFrame([], out_schema)
    width, norm = widths[0].width, widths[0].most ** 0.5 * (1 + 1e-12)
    vectors = vectors.where(F.size("x") == width)
    wanted = n_pivots or max(PIVOTS, round(widths[0].n ** 0.5))
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()
    pivots = raised(np.array([r.x for r in sample], float), norm)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 2048):
                part = batch.slice(a, 2048)
                far = distances(raised(matrix(part.column("x")), norm), pivots)
                cell = far.argmin(1)
                yield pa.RecordBatch.from_arrays([part.column("vec_id"), part.column("x"), pa.array(cell, pa.int32()), pa.array(far[np.arange(len(far)), cell], pa.float64())], ["vec_id", "x", "cell", "distance"])

    placed = written(vectors.select("vec_id", "x").mapInArrow(assign, "vec_id long, x array<long>, cell int, distance double"), "cells")
    known = _summary(placed, pivots, k, norm, block)
    data = placed.select("vec_id", "x", "cell", "distance").mapInArrow(_to_blocks(known), "block int, asks int, vec_id long, x array<long>")
    asked = placed.where(is_query).dropDuplicates(["vec_id"]).select("vec_id", "x").mapInArrow(_to_needed(known, k), "block int, asks int, vec_id long, x array<long>")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, ids, rows = None, [], []
        for (at, asks), part in runs(batches, "block", "asks"):
            if at != place:
                place, ids, rows = at, [], []
            if not asks:
                ids.append(part.column("vec_id").to_numpy())
                rows.append(matrix(part.column("x")))
                continue
            if not ids:
                continue
            if len(ids) > 1:
                ids, rows = [np.concatenate(ids)], [np.concatenate(rows)]
            for a in range(0, part.num_rows, AT_ONCE):
                some = part.slice(a, AT_ONCE)
                query = some.column("vec_id").to_numpy()
                score = matrix(some.column("x")) @ rows[0].T
                score[query[:, None] == ids[0]] = -np.inf
                best = [_best(s, ids[0], k) for s in score]
                found = [np.repeat(query, [len(b) for b in best]), np.concatenate([ids[0][b] for b in best]), np.concatenate([s[b] for s, b in zip(score, best, strict=True)]).astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in found], ["query_id", "vec_id", "score"])

    both = data.unionByName(asked).repartition("block").sortWithinPartitions("block", "asks")
    found = written(both.mapInArrow(solve, "query_id long, vec_id long, score long"), "scores")
    drop_written(placed)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _to_blocks(known: Summary):
    """Every vector with the block of its piece; pieces of several parts are dealt by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((known.high, known.cell))
        cells, highs = known.cell[order], known.high[order]
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, distance, ids = (batch.column(c).to_numpy() for c in ("cell", "distance", "vec_id"))
            first = np.searchsorted(cells, cell)
            # the first piece of the cell that reaches as far as the vector
            piece = order[[a + int(np.searchsorted(highs[a : a + n], d)) for a, n, d in zip(first, np.searchsorted(cells, cell, side="right") - first, distance, strict=True)]]
            dealt = known.block[piece] + (ids * 2654435761 >> 7) % known.parts[piece]
            yield pa.RecordBatch.from_arrays([pa.array(dealt, pa.int32()), pa.array(np.zeros(len(ids), np.int32)), batch.column("vec_id"), batch.column("x")], ["block", "asks", "vec_id", "x"])

    return run


def _to_needed(known: Summary, k: int):
    """Every query once for each block that it has to meet."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(a, AT_ONCE)
                row, piece = known.needed(raised(matrix(part.column("x")), None), k)
                parts = known.parts[piece]
                row, first = np.repeat(row, parts), np.repeat(known.block[piece], parts)
                offset = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
                pairs = np.unique(np.stack([row, first + offset]), axis=1) if len(row) else np.zeros((2, 0), int)
                at = pa.array(pairs[0])
                yield pa.RecordBatch.from_arrays([pa.array(pairs[1], pa.int32()), pa.array(np.ones(len(at), np.int32)), part.column("vec_id").take(at), part.column("x").take(at)], ["block", "asks", "vec_id", "x"])

    return run


def scaled(embeddings: DataFrame) -> DataFrame:
    """vec_id and x, the components floor(1024 * x) as integers, of the vectors that take part."""
    return embeddings.where(finite() & F.col("vec_id").isNotNull()).select("vec_id", F.transform("embedding", lambda v: F.floor(F.lit(1024.0) * v.cast("double"))).alias("x"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(scaled(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 100 == 0, 10)


def sql() -> str:
    return """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.x, v.x) AS score
  FROM (SELECT DISTINCT ON (vec_id) * FROM v WHERE vec_id % 100 = 0) q JOIN v ON v.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 10
"""
