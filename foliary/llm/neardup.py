"""Near-duplicate embeddings by a pivot-permutation index.

Pivots are a sample of the vectors. Every distinct vector is described by the
order of its nearest pivots and listed under each pair among the first
``PREFIX`` of them, so that vectors with two or more shared pivots meet in an
inverted list. In each list all cosines are computed in blocks, in double
precision, and only those of at least the threshold count; a pair that shares
several lists counts in the first one. Equal vectors are one point with a
number of copies. What leaves a list is, per vector, a count of links and the
first vector of its part of the list, never the pairs.

The number of pivots is the square root of the number of distinct vectors (32 at
least), so a list has some tens of members whatever the size of the data, and
what comes to the driver grows as that root only. A list longer than ``BLOCK``
is split into blocks, and each two blocks are one task, so a list of any length
is compared in whole; blocks are compared in slices, so memory does not grow
with the number of links. Vectors of different lengths never link and have lists
of their own; a length with fewer than two pivots has one list.

Every row is a vector of its own: n_links counts the other rows linked with it.
Rows of one vec_id are one node of the components. Vectors that are null, empty,
zero, or hold null or non-finite components, and rows with a null vec_id, link
with nothing: n_links 0, component_id their vec_id, kept. An empty table gives no
rows. Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .graph import components
from .shared import drop_written, finite, matrix, runs, table, written

PREFIX, BLOCK, THRESHOLD = 6, 2048, 0.9
#: Rows of a block that are compared with another one at once.
SLICE = 64


def _units(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _linked(a: np.ndarray, b: np.ndarray, ua: np.ndarray, ub: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and of b whose cosine is at least ``threshold``; close ones as computed for the pair alone."""
    near = ua @ ub.T
    link = near >= threshold
    i, j = np.nonzero(np.abs(near - threshold) < 1e-9)
    if len(i):
        dot = np.einsum("ij,ij->i", a[i], b[j])
        link[i, j] = dot / (np.sqrt(np.einsum("ij,ij->i", a[i], a[i])) * np.sqrt(np.einsum("ij,ij->i", b[j], b[j]))) >= threshold
    return np.nonzero(link)


def _first_pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Per row the two smallest pivots that both permutations hold, as one number; rows are sorted."""
    common = np.where((x[:, :, None] == y[:, None, :]).any(2), x, np.int64(1 << 30))
    common.sort(axis=1)
    return (common[:, 0] << 31) | common[:, 1]


def _spread(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest row reachable from each of n rows along the links i - j."""
    low = np.arange(n)
    while True:
        new = low.copy()
        np.minimum.at(new, i, low[j])
        np.minimum.at(new, j, low[i])
        new = new[new]
        if (new == low).all():
            return low
        low = new


def compared(v: np.ndarray, m: np.ndarray, near: np.ndarray, pair: np.ndarray | None, left: np.ndarray, right: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Per row the copies linked with it, and the first row of its part; rows ``left`` against ``right``, which are the same or disjoint.

    ``pair`` holds the list's pivots; a link counts only in the first list that its ends share. Without it all count.
    """
    n, label = np.zeros(len(v), np.int64), np.arange(len(v))
    same = left is right
    units = _units(v)
    for at in range(0, len(left), SLICE):
        some = left[at : at + SLICE]
        others = right[at:] if same else right
        i, j = _linked(v[some], v[others], units[some], units[others], threshold)
        i, j = some[i], others[j]
        if same:
            i, j = i[i < j], j[i < j]
        if pair is not None and len(i):
            mine = _first_pair(near[i], near[j]) == (pair[0] << 31) | pair[1]
            i, j = i[mine], j[mine]
        n += np.bincount(i, weights=m[j], minlength=len(v)).astype(np.int64) + np.bincount(j, weights=m[i], minlength=len(v)).astype(np.int64)
        a, b = label[i], label[j]
        if (a != b).any():
            label = _spread(a[a != b], b[a != b], len(v))[label]
    return n, label


def classes(vectors: DataFrame, threshold: float = THRESHOLD, prefix: int = PREFIX, block: int = BLOCK, n_pivots: int | None = None) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding)."""
    usable = finite() & F.exists("embedding", lambda x: x != 0) & F.col("vec_id").isNotNull()
    keyed = vectors.select("vec_id", "embedding", usable.alias("usable")).withColumns({"k1": F.when(F.col("usable"), F.xxhash64("embedding")), "k2": F.when(F.col("usable"), F.xxhash64(F.lit("other"), "embedding"))})
    grouped = keyed.where("usable").groupBy("k1", "k2").agg(F.count("*").alias("m"), F.first("embedding").alias("v"), F.min("vec_id").alias("low"), F.max("vec_id").alias("high"))
    points = written(grouped.withColumn("x", F.monotonically_increasing_id()), "points")
    total = points.count()
    if not total:
        return keyed.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    wanted = n_pivots or max(32, round(total**0.5))
    sample = points.orderBy(F.xxhash64("k1", "k2")).limit(wanted).select("v").collect()
    pivots = {w: _units(np.array([r.v for r in sample if len(r.v) == w], float)) for w in {len(r.v) for r in sample}}

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = np.array([len(v) for v in batch.column("v")])
            for w in np.unique(widths):
                for at in np.array_split(np.flatnonzero(widths == w), -(-int((widths == w).sum()) // 2048)):
                    part = batch.take(pa.array(at))
                    own = pivots.get(int(w), np.zeros((0, w)))
                    first = min(prefix, len(own))
                    if first > 1:
                        near = np.sort(np.argpartition(-(_units(matrix(part.column("v"))) @ own.T), first - 1, axis=1)[:, :first], axis=1).astype(np.int32)
                        sides = [np.stack(x, 1) for x in zip(*[(near[:, i], near[:, j]) for i, j in combinations(range(first), 2)], strict=True)]
                    else:
                        near = np.zeros((len(at), 0), np.int32)
                        sides = [np.full((len(at), 1), -1, np.int32)] * 2
                    lists = [pa.array(list(x), pa.list_(pa.int32())) for x in (near, *sides)]
                    yield pa.RecordBatch.from_arrays([part.column("x"), part.column("m"), part.column("v"), pa.array(np.full(len(at), w, np.int32)), *lists], ["x", "m", "v", "width", "near", "p", "q"])

    index = written(points.select("x", "m", "v").mapInArrow(listed, "x long, m long, v array<float>, width int, near array<int>, p array<int>, q array<int>"), "index")
    key = ["width", "p", "q"]
    opened = lambda *kept: index.select("width", *kept, F.explode(F.arrays_zip("p", "q")).alias("pq")).select("width", *kept, "pq.p", "pq.q")
    sizes = opened().groupBy(*key).agg(F.count("*").alias("size")).where("size > 1")
    sized = opened("x", "m", "v", "near").join(sizes, key).withColumn("blocks", F.ceil(F.col("size") / F.lit(block)).cast("int")).withColumn("own", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int"))
    # block i is compared with itself and with every block after it
    placed = sized.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        *key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("side"), "x", "m", "v", "near"
    )
    place = [*key, "i", "j"]

    def solve(at: tuple, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(parts).combine_chunks()
        x, m, side = (whole.column(c).to_numpy() for c in ("x", "m", "side"))
        v = matrix(whole.column("v").combine_chunks())
        near = np.asarray(whole.column("near").combine_chunks().flatten().to_numpy(zero_copy_only=False), "i8").reshape(len(x), -1)
        everything = np.arange(len(x))
        left, right = (everything, everything) if at[3] == at[4] else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        n, label = compared(v, m, near, np.array(at[1:3], np.int64) if at[1] >= 0 else None, left, right, threshold)
        rows = np.flatnonzero(n > 0)
        return pa.RecordBatch.from_arrays([pa.array(x[rows], pa.int64()), pa.array(n[rows], pa.int64()), pa.array(x[label[rows]], pa.int64())], ["x", "n", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts = None, []
        for now, part in runs(batches, *place):
            if now != at:
                if parts:
                    yield solve(at, parts)
                at, parts = now, []
            parts.append(part)
        if parts:
            yield solve(at, parts)

    found = written(placed.repartition(*place).sortWithinPartitions(*place).mapInArrow(run, "x long, n long, to long"), "links")
    # rows of one vec_id are one node: points that share one are joined
    lists = keyed.where("usable").select("vec_id", "k1", "k2").join(points.select("k1", "k2", "x"), ["k1", "k2"])
    ends = lists.groupBy("vec_id").agg(F.min("x").alias("to"), F.max("x").alias("most")).where("`to` < most")
    joined = lists.join(ends, "vec_id").where("x > `to`").select("x", "to").distinct()
    reached = components(found.select(F.col("x").alias("a"), F.col("to").alias("b")).unionByName(joined.select(F.col("x").alias("a"), F.col("to").alias("b")))).withColumnRenamed("id", "x")
    named = points.join(reached, "x", "left").withColumn("component", F.coalesce("component", "x"))
    smallest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    counts = found.groupBy("x").agg(F.sum("n").alias("n"))
    known = written(named.join(smallest, "component").join(counts, "x", "left").select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n"), "component_id"), "known")
    for done in (points, index, found):
        drop_written(done)
    return keyed.join(known, ["k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def sql(threshold: float = THRESHOLD) -> str:
    """The same rows in DuckDB, from all pairs of rows."""
    return f"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
v AS (
  SELECT r, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM t
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), e AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b, a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.r <> b.r AND len(a.x) = len(b.x)
  WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= {threshold}
), d AS MATERIALIZED (SELECT DISTINCT x, y FROM e WHERE x <> y),
c(x, y) AS (SELECT vec_id, vec_id FROM v UNION SELECT d.y, c.y FROM c JOIN d ON d.x = c.x),
m AS (SELECT x, min(y) AS component FROM c GROUP BY x), n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT t.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(m.component, t.vec_id) AS component_id, coalesce(m.component, t.vec_id) = t.vec_id AS kept
FROM t LEFT JOIN n ON n.a = t.r LEFT JOIN v ON v.r = t.r LEFT JOIN m ON m.x = v.vec_id
"""
