"""Mixing sources to target weights by systematic sampling.

Each source's documents are expected ``target / size of the source`` times, at
most three times. Along a fixed order of the source's documents the expected
copies are summed; one random offset per source is added, and a document is
emitted once for each integer that its stretch of the sum crosses.

The order is by size class and then by a digest of doc_id and text, so that every
size class is sampled evenly and a source's words come near its target. It needs
no global sort: counts per cell (source, size class, first digits of the digest)
are summed over cells, whose number does not grow with the documents of a
source, and ranks by doc_id and size are taken inside the cells, which split a
source of any size, and rows of one doc_id or none as well.

Null sources form one source; null texts have size 0. Repeated rows are documents
of their own. The order depends on the rows alone, not on where they stand: rows
that agree in doc_id, source, size and cell can change places, but nothing of
that shows in the result, and mixed() shares their copies by their texts. A
source without words has target 0. An empty table gives no rows. Other columns
are kept by mixed(), whatever their names, and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import table, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def plan(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """Per source: source_size, target, rate and offset. ``sizes`` has is_null, name and size.

    Targets share the total by weight; those above ``most`` times their source
    stop there, and the excess is shared anew by weight until none is above:
    all sources whose ratio of limit to weight is below one level are full.
    One row per source is handled in one task.
    """
    source = sizes.groupBy("is_null", "name").agg(F.sum("size").alias("source_size"))
    at = (F.row_number().over(W.orderBy("is_null", "name")) - 1) % len(weights)
    filling = W.orderBy("ratio", "is_null", "name")
    level = (F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("limit").over(filling.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("weight").over(filling.rowsBetween(0, W.unboundedFollowing))
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "is_null", F.lit(":"), "name")), 1, 8), 16, 10)
    return (
        source.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), at + 1))
        .withColumn("limit", F.lit(float(most)) * F.col("source_size"))
        .withColumn("ratio", F.col("limit") / F.col("weight"))
        .withColumn("level", level)
        .withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "is_null", "name", "level"))).over(W.partitionBy())["level"])
        .withColumn("target", F.least("limit", F.col("level") * F.col("weight")))
        .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("offset", digits.cast("double") / F.lit(float(1 << 32)))
        .select("is_null", "name", "source_size", "target", "rate", "offset")
    )


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target and copies."""
    size = F.col("size")
    length = F.length(F.bin(size))
    sized = written(
        docs.select(
            F.col("doc_id"),
            F.col("source").isNull().cast("int").alias("is_null"),
            F.coalesce(F.col("source"), F.lit("")).alias("name"),
            size_of(F.col("text")).alias("size"),
            F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))).alias("digest"),
        ).select(
            "*",
            (length * 16 + F.call_function("shiftright", size, F.greatest(length - 4, F.lit(0)))).cast("int").alias("class"),
            F.substring("digest", 1, 2).alias("part"),
        ).drop("digest"),
        "sizes",
    )
    cell = ["is_null", "name", "class", "part"]
    cells = sized.groupBy(*cell).agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("is_null", "name").orderBy("class", "part")) - F.col("n")
    cells = cells.withColumn("before", before).drop("n").join(plan(sized, weights, most, seed), ["is_null", "name"])
    rank = F.row_number().over(W.partitionBy(*cell).orderBy("doc_id", "size"))
    k = F.col("before") + F.col("rank")
    crossed = F.floor(F.col("offset") + F.col("rate") * k) - F.floor(F.col("offset") + F.col("rate") * (k - 1))
    return (
        sized.withColumn("rank", rank)
        .join(cells, cell)
        .select("doc_id", F.when(F.col("is_null") == 0, F.col("name")).alias("source"), "size", "source_size", "target", F.least(crossed, F.lit(most)).cast("int").alias("copies"))
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    chosen = copies(docs, weights, most, seed).where("copies > 0").groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    # rows that agree in doc_id, source and size share their copies evenly, the first ones one more
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & F.col("row.source").eqNullSafe(F.col("source")) & (size_of(F.col("row.text")) == F.col("size"))
    rank = F.row_number().over(W.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64("row.text")))
    share = F.floor((F.col("copies") + F.col("rows") - rank) / F.col("rows")).cast("int")
    taken = keyed.join(chosen, same).select("row", share.alias("n")).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).select("row.*")


def report(docs: DataFrame) -> DataFrame:
    return copies(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"))


def sql(documents: str = "documents", seed: str = SEED) -> str:
    """The same rows in DuckDB, with one window over each source."""
    weights = ", ".join(f"{float(w)}" for w in WEIGHTS)
    return f"""
WITH s AS (
  SELECT doc_id, CAST(source IS NULL AS INTEGER) AS is_null, coalesce(source, '') AS name,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest
  FROM {documents}
), c AS (
  SELECT *, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 4, 0)) AS class,
         substr(digest, 1, 2) AS part
  FROM s
), g AS (
  SELECT is_null, name, sum(size) AS source_size FROM c GROUP BY ALL
), w AS (
  SELECT *, [{weights}][(row_number() OVER (ORDER BY is_null, name) - 1) % {len(WEIGHTS)} + 1] AS weight, CAST({MOST_COPIES}.0 AS DOUBLE) * CAST(source_size AS DOUBLE) AS lim FROM g
), r AS (SELECT *, lim / weight AS ratio FROM w),
l AS (
  SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(lim) OVER (ORDER BY ratio, is_null, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
            / sum(weight) OVER (ORDER BY ratio, is_null, name ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM r
), p AS (
  SELECT is_null, name, CAST(source_size AS BIGINT) AS source_size,
         CAST(least(lim, (SELECT level FROM l WHERE ratio >= level ORDER BY ratio, is_null, name LIMIT 1) * weight) AS DOUBLE) AS target,
         CAST(('0x' || substr(md5('{seed}:' || is_null || ':' || name), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM l
), k AS (
  SELECT c.*, row_number() OVER (PARTITION BY is_null, name ORDER BY class, part, doc_id NULLS FIRST, size) AS k FROM c
)
SELECT k.doc_id, k.size, p.source_size, p.target,
       CAST(k.size * least({MOST_COPIES}, CASE WHEN p.source_size > 0 THEN floor(u + target / p.source_size * k) - floor(u + target / p.source_size * (k - 1)) ELSE 0 END) AS BIGINT) AS taken
FROM k JOIN p USING (is_null, name)
"""
