"""Bounded samples of labelled documents for fitting a classifier."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus``; a null doc_id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def labelled(docs: DataFrame, labels: DataFrame, label: str, usable: Column, max_rows: int, max_bytes: int) -> DataFrame:
    """At most ``max_rows`` distinct labelled texts of at most ``max_bytes`` in all: doc_id, text, label.

    ``usable`` says by doc_id which rows may be learned from. Rows come in the order of a hash of
    doc_id, so the sample is the same in each run; a text that would go beyond ``max_bytes`` is passed
    over, so the sample holds fewer very long texts than the corpus. Of repeated doc_ids the larger
    label and the shortest text hold.
    """
    rows = labels.where(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    first = rows.withColumn("order", F.xxhash64("doc_id")).orderBy("order", "doc_id").limit(max_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sized = texts.select("doc_id", F.struct(F.octet_length("text").alias("size"), F.xxhash64("text").alias("key")).alias("of"))
    joined = sized.join(F.broadcast(first), "doc_id")  # bounded by max_rows
    sizes = joined.groupBy("doc_id", "order", "label").agg(F.min("of").alias("of")).collect()  # one row a doc_id
    taken, total = [], 0
    for r in sorted(sizes, key=lambda r: (r["order"], r["doc_id"])):
        if total + r["of"]["size"] <= max_bytes:
            total += r["of"]["size"]
            taken.append((r["doc_id"], r["label"], r["of"]["key"]))
    columns = [pa.array([t[i] for t in taken], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.int64()))]
    chosen = docs.sparkSession.createDataFrame(pa.table(columns, ["doc_id", "label", "key"]))  # rows from a list would start Python workers
    return texts.withColumn("key", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "key"]).select("doc_id", "text", "label").dropDuplicates(["text"])
