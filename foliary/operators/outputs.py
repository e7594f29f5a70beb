"""Where the files of a finished task go, and writing them."""

from __future__ import annotations

import io
import json
import os
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Values of the key that are ranked together.
CELL = 4096


def extension_of_url(url: Column) -> Column:
    """Lower-case extension of a URL's path, .bin if it has none."""
    ext = F.lower(F.regexp_extract(F.coalesce(F.try_parse_url(url, F.lit("PATH")), url), r"[^/](\.[A-Za-z0-9]+)$", 1))
    return F.when(ext != "", ext).otherwise(".bin")


def sink_kind(files: Column, out: Column, is_dir: Column | None = None) -> Column:
    """json without files, file for one; several go to a zip if that is asked for, else to a directory."""
    zipped = F.lower(out).endswith(".zip")
    zipped = zipped if is_dir is None else zipped & ~is_dir
    return F.when(files == 0, "json").when(files == 1, "file").when(zipped, "zip").otherwise("directory")


def file_path(out: Column, task_id: Column, expected: Column, is_dir: Column | None = None) -> Column:
    """``out`` itself if it has the expected extension, else a file named for the task inside it."""
    own = F.lower(F.regexp_extract(out, r"(\.[^./]+)$", 1))
    inside = (own == "") | (own != expected)
    inside = inside if is_dir is None else is_dir | inside
    return F.when(inside, F.concat(F.regexp_replace(out, "/$", ""), F.lit("/"), task_id, expected)).otherwise(out)


def numbered(at: Column, total: Column, url: Column) -> Column:
    """01.jpg and so on: as many digits as the total has, two at least."""
    return F.concat(F.lpad(at.cast("string"), F.greatest(F.lit(2), F.length(total.cast("string"))), F.lit("0")), extension_of_url(url))


def ranked(rows: DataFrame, by: str, key: str, name: str = "at") -> DataFrame:
    """Rows with their place (from 1) inside ``by`` in the order of an integer key, and the number of rows of ``by`` (total).

    Keys are ranked in cells of neighbouring values and cells are put in order by their counts, so that no
    group has to be sorted in one task; equal keys in one group are in no certain order.
    """
    celled = rows.withColumn("_cell", F.floor(F.col(key) / CELL))
    counts = celled.groupBy(by, "_cell").agg(F.count("*").alias("_n"))
    order = W.partitionBy(by).orderBy(F.col("_cell").asc_nulls_last())
    before = counts.select(F.col(by).alias("_by"), F.col("_cell").alias("_c"), (F.sum("_n").over(order) - F.col("_n")).alias("_before"), F.sum("_n").over(W.partitionBy(by)).alias("total"))
    place = F.row_number().over(W.partitionBy(by, "_cell").orderBy(key))
    placed = celled.withColumn("_place", place).join(before, F.col(by).eqNullSafe(F.col("_by")) & F.col("_cell").eqNullSafe(F.col("_c")))
    return placed.withColumn(name, (F.col("_before") + F.col("_place")).cast("bigint")).drop("_cell", "_c", "_by", "_place", "_before")


def packed(files: Column) -> Column:
    """One task's output as bytes: a zip of its files, an array of structs of name and content."""

    @F.pandas_udf("binary")
    def pack(lists: pd.Series) -> pd.Series:
        return lists.map(lambda files: zip_bytes([(f["name"], bytes(f["content"])) for f in (files if files is not None else [])]))

    return pack(files)


def unpacked(archive: Column) -> Column:
    """name, bytes and CRC of the files in a zip, in its order."""

    @F.pandas_udf("array<struct<name:string,bytes:bigint,crc:string>>")
    def unpack(archives: pd.Series) -> pd.Series:
        def read(data):
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                return [{"name": i.filename, "bytes": i.file_size, "crc": f"{i.CRC:08x}"} for i in z.infolist()]

        return archives.map(read)

    return unpack(archive)


def zip_bytes(files: list[tuple[str, bytes]]) -> bytes:
    """An archive that stores its files as they are."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as archive:
        for name, content in files:
            archive.writestr(zipfile.ZipInfo(name), content)
    return out.getvalue()


def write_output(kind: str, path: str, files: list[tuple[str, bytes]], result: object = None) -> list[str]:
    """Writes one task's output and returns the paths.

    Executors call this in foreachPartition with a path that all machines share.
    """
    if kind == "directory":
        os.makedirs(path, exist_ok=True)
        for name, content in files:
            with open(os.path.join(path, name), "wb") as f:
                f.write(content)
        return [os.path.join(path, name) for name, _ in files]
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    body = json.dumps(result, indent=2, ensure_ascii=False).encode() if kind == "json" else zip_bytes(files) if kind == "zip" else files[0][1]
    with open(path, "wb") as f:
        f.write(body)
    return [path]
