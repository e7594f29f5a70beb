"""Files by content: digests, what is stored already, what goes inline, and parts for upload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Total bytes below which files go along with the task; bytes of a part.
INLINE_LIMIT = CHUNK = 10 * 1024 * 1024


def manifest(files: DataFrame, content: str = "content") -> DataFrame:
    """name, bytes and hash of files given as name and content; a file without a name is an error."""
    name = F.when(F.assert_true(F.col("name").isNotNull(), "a file needs a name").isNull(), F.col("name"))
    return files.select(name.alias("name"), F.octet_length(content).cast("bigint").alias("bytes"), F.md5(content).alias("hash"))


def upload_needed(files: DataFrame, stored: DataFrame) -> DataFrame:
    """Files whose content (hash) is not stored yet."""
    return files.join(stored.select("hash").distinct(), "hash", "left_anti")


def inline_decision(files: DataFrame, *by: str, given: str | None = None) -> DataFrame:
    """Per task: number of files, their bytes, and whether they go inline: there is one, they are small, and no ids are given.

    ``given`` names a column with the number of ids that a task has besides.
    """
    summed = files.groupBy(*by).agg(F.count("bytes").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), *([F.max(given).alias("_given")] if given else []))
    inline = (F.col("files") > 0) & (F.col("bytes") < INLINE_LIMIT)
    return summed.withColumn("inline", inline & (F.coalesce("_given", F.lit(0)) == 0) if given else inline).drop("_given")


def parts(size: Column, chunk: int = CHUNK) -> Column:
    """part_number (from 1), start and stop of the parts of a file; an empty file has one empty part."""
    count = F.greatest(F.lit(1), F.ceil(size / F.lit(chunk))).cast("bigint")
    return F.transform(F.sequence(F.lit(1).cast("bigint"), count), lambda n: F.struct(n.alias("part_number"), ((n - 1) * chunk).alias("start"), F.least(n * chunk, size).alias("stop")))


def part_contents(files: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Each part with its bytes and digest."""
    cut = files.withColumn("p", F.explode(parts(F.octet_length("content").cast("bigint"), chunk)))
    body = F.substring(F.col("content"), F.col("p.start").cast("int") + 1, F.lit(chunk))
    return cut.select("name", F.col("p.part_number").alias("part_number"), body.alias("content")).withColumn("hash", F.md5("content"))


def progress(done: Column, total: Column) -> Column:
    """Share of an upload that is done: 0.95 for the parts, the rest for completion."""
    return F.when(done >= total, 1.0).otherwise(F.lit(0.95) * done / total)


def merged_options(file: dict[str, Column], default: dict[str, Column]) -> list[Column]:
    """Options of a file where it has them, else the task's."""
    return [F.coalesce(*[o[k] for o in (file, default) if k in o]).alias(k) for k in {**default, **file}]


def completed_parts(parts: DataFrame, *by: str) -> DataFrame:
    """What completing an upload sends: the tags of its parts in the order of their numbers, whatever order they came in."""
    listed = F.array_sort(F.collect_list(F.struct("part_number", "tag")))
    return parts.groupBy(*by).agg(F.count("*").alias("parts"), F.array_join(F.transform(listed, lambda p: F.concat(p["part_number"].cast("string"), F.lit("="), p["tag"])), ",").alias("completion"))


def transfer(stored: Column, platform: Column, part_size: Column, size: Column) -> Column:
    """How a file's bytes travel: not at all if the content is stored, in parts if the grant has a part size that it exceeds, else as a put to an object store or as a form."""
    return F.when(stored, "none").when(size > part_size, "parts").when(platform == "oss", "put").otherwise("form")
