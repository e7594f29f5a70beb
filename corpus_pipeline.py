"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

quality (documents that the classifier rejects go), near duplicates (one
document of each class stays), repeated passages (bytes of long repeated strings
and words of repeated passages go), mixing (documents are emitted as often as the source's target asks for), and
tokens (ids of the encoded text and the bytes that they decode to).

Rows are what every stage works on. Quality scores each row alone; a null or
empty text has a score like any other. Near duplicates: equal rows become one,
a doc_id may stand on several texts, and rows without words or without a doc_id
stay. Repeated passages: equal rows are documents of their own, and rows without
text stay. Mixing: rows that agree in doc_id, source and size share their copies;
null sources are one source; rows without words go, as nothing of them is wanted.
Tokens: null texts have none. Stages return the columns of documents only, so
other columns, whatever their names, end at the first stage. Empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliary.llm import bpe, jaccard, mixing, quality, suffixes
from foliary.llm.shared import drop_written, table, written

#: Columns of documents, which all stages but the last return.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs.select(*COLUMNS), model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Classes of 80 % or more of equal sets of five words; the document of the smallest doc_id stays."""
    return jaccard.survivors(docs.select(*COLUMNS), width=5, percent=80)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The text without strings of 400 bytes, and without strings of 51 words, that occur elsewhere; a document with nothing left goes, one without text stays.

    A removed span may begin or end inside a character, which goes as a whole.
    """
    cleaned = suffixes.cleaned(docs.select(*COLUMNS), words=suffixes.WORDS)
    left = cleaned.where((F.col("n_removed") == 0) & (F.col("n_passages") == 0) | (F.col("text") != ""))
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs.select(*COLUMNS))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    both = bpe.round_trip(docs.select("doc_id", "source", "text"), ranks, public_tokenizers.PATTERN)
    return both.select("doc_id", "source", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", drop_repeated_passages),
    ("mixing", mix_sources),
    ("tokens", to_tokens),
]

#: SQL has neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage has written goes when the next one has read it."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = written(docs, name)
            drop_written(before)
    return docs
