"""Test tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.catalog import TASK_TYPES
from ..sources.files import table

EXTENSIONS = (".pdf", ".pptx", ".docx", ".key", ".txt")


def pdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents as text blocks, twenty to a page, and an image for every third document."""
    role = lambda i: F.when(i % 20 == 0, "heading").when(i % 20 == 1, "list-item").when(i % 20 == 19, "caption")
    blank = F.struct(F.lit(None).cast("boolean").alias("bold"), F.lit(None).cast("boolean").alias("italic"))
    block = lambda line, i: F.struct(line.alias("text"), role(i).alias("role"), blank.alias("style"), F.struct((i / 20).cast("int").alias("pageIndex")).alias("locator"))
    picture = F.struct(
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("k/"), F.col("doc_id"), F.lit(".png"))).alias("key"),
        F.lit(None).cast("string").alias("fileName"), F.struct(F.lit(0).alias("pageIndex")).alias("locator"), F.lit(None).cast("bigint").alias("bytes"), F.lit(None).cast("string").alias("hash"),
    )
    return table(spark, sf_dir, "documents").select("doc_id", F.struct(F.transform(F.split("text", "\n"), block).alias("textBlocks"), F.array(picture).alias("images")).alias("result"))


def keynote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as decks, a turn a slide; every third turn has an image, which in every fifth deck belongs to no slide."""
    turns = table(spark, sf_dir, "conversations")
    text = F.transform(F.split("text", "\n"), lambda t: F.struct(F.lit(None).cast("string").alias("id"), t.alias("text")))
    empty = lambda kind: F.array().cast(kind)
    slide = F.struct(text.alias("text"), empty("array<struct<id:string,data:array<string>>>").alias("table"), empty("array<struct<id:string,data:struct<rowName:array<string>,columnName:array<string>>>>").alias("chart"))
    decks = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", slide.alias("slide")))).alias("turns"))
    numbered = F.transform("turns", lambda t, i: F.struct(t["turn"].alias("turn"), i.alias("at")))
    image = lambda t: F.struct(
        F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("fileName"),
        (t["at"] + F.when(F.col("conv_id") % 5 == 0, 1000).otherwise(0)).cast("double").alias("pageIndex"), F.concat(F.lit("k/"), F.col("conv_id"), F.lit("-"), t["turn"]).alias("key"),
    )
    return decks.select("conv_id", F.struct(F.transform("turns", lambda t: t["slide"]).alias("slides"), F.transform(F.filter(numbered, lambda t: t["turn"] % 3 == 0), image).alias("images")).alias("result"))


LINE = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with rn, a number inside each order that is the same in every run."""
    return table(spark, sf_dir, "lineitem").withColumn("rn", F.row_number().over(W.partitionBy("l_orderkey").orderBy(*LINE)))


def docx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as documents: a heading and a table of the order's lines."""
    none = lambda kind: F.lit(None).cast(kind)

    def element(idx: int, kind: str, text: Column, level: Column, rows: Column) -> Column:
        style = F.struct(none("string").alias("styleId"), none("string").alias("styleName"), level.cast("double").alias("outlineLvl"))
        strings = {k: none("array<string>").alias(k) for k in ("series", "categories", "texts")}
        return F.struct(
            F.lit(float(idx)).alias("idx"), F.lit(kind).alias("type"), text.cast("string").alias("text"), style.alias("style"), none("string").alias("image"), none("string").alias("name"),
            none("string").alias("children"), rows.cast("array<array<string>>").alias("table"), *strings.values(),
        )

    kept = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct(*LINE))).alias("rows"))
    row = lambda r, i: F.array((i + 1).cast("string"), r["l_partkey"].cast("string"), r["l_quantity"].cast("bigint").cast("string"))
    header = F.array(F.array(F.lit("line"), F.lit("part"), F.lit("qty")))
    cells = F.when(F.col("rows").isNull(), header).otherwise(F.concat(header, F.transform("rows", row)))  # an order may have no lines
    heading = F.concat(F.lit("Order "), F.col("o_orderkey"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey").join(kept, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    content = F.array(element(1, "table", none("string"), none("double"), cells), element(0, "text", heading, F.lit(0.0), none("array<array<string>>")))
    return orders.select("o_orderkey", F.struct(content.alias("content")).alias("result"))


def shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of orders as the shapes of a slide."""
    return lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("slide"), (F.col("rn") - 1).alias("ord"), (F.col("l_partkey") * 1000).alias("x"), (F.col("l_suppkey") * 10000).alias("y"),
        ((1 + F.col("l_partkey") % 50) * 10000).alias("w"), ((1 + F.col("l_suppkey") % 20) * 10000).alias("h"), F.concat(F.lit("L"), F.col("rn")).alias("txt"), (F.col("l_linenumber") % 7 == 0).alias("hidden"),
    )


def odd_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shapes with some of no size, of one side only, and some blank ones as large as a slide."""
    part, flat, blank = F.col("x") / 1000, F.lit(0).cast("bigint"), F.lit(" ")
    none, line, back = part % 11 == 0, part % 17 == 0, part % 13 == 0
    return shapes(spark, sf_dir).select(
        "slide", "ord", F.when(back, flat).otherwise(F.col("x")).alias("x"), F.when(back, flat).otherwise(F.col("y")).alias("y"), F.when(none, flat).when(back, 9_000_000).otherwise(F.col("w")).alias("w"),
        F.when(none | line, flat).when(back, 6_000_000).otherwise(F.col("h")).alias("h"), F.when(back | (part % 5 == 0), blank).otherwise(F.col("txt")).alias("txt"), "hidden",
    )


def decks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shapes of each slide as the JSON of a deck."""
    run = F.struct(F.array(F.struct(F.array(F.struct(F.col("txt").alias("t"))).alias("children"))).alias("children"))
    place = F.struct("x", "y", F.col("w").alias("cx"), F.col("h").alias("cy"))
    shape = F.struct("ord", F.struct(F.lit("Shape").alias("type"), "hidden", place.alias("xfrm"), run.alias("txBody")).alias("shape"))
    tree = shapes(spark, sf_dir).groupBy("slide").agg(F.array_sort(F.collect_list(F.struct("ord", F.to_json(shape["shape"]).alias("j")))).alias("s"))
    text = F.concat(F.lit('{"slides":[{"spTree":['), F.array_join(F.transform("s", lambda s: s["j"]), ","), F.lit("]}]}"))
    return tree.select("slide", text.alias("deck"))


def task_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as snapshots of tasks."""
    return snapshots_of(table(spark, sf_dir, "events"))


def snapshots_of(events: DataFrame) -> DataFrame:
    status = F.create_map(*map(F.lit, ("signup", "pending", "view", "running", "click", "running", "purchase", "completed", "error", "failed")))
    kind = F.element_at(F.array(*map(F.lit, TASK_TYPES)), (F.get_json_object("props", "$.k").cast("int") % len(TASK_TYPES)) + 1)
    return events.select(F.col("user_id").alias("task_id"), kind.alias("type"), status[F.col("event_type")].alias("status"), "ts", F.col("event_id").alias("seq"))


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = F.element_at(F.array(*map(F.lit, EXTENSIONS)), (F.col("doc_id") % 5 + 1).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", "source", F.concat(F.lit("doc-"), F.col("doc_id"), ext).alias("name"), F.octet_length("text").cast("bigint").alias("bytes"), F.md5("text").alias("hash"))
