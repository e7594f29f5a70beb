"""What several operators of this subpackage share: tables, scratch space, batches."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a Python worker handles at once.
BATCH_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is ``spark.checkpoint.dir``; where that is unset (tests on one machine)
    a temporary folder of this process becomes it.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="foliary-")
        atexit.register(shutil.rmtree, at, True)
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet into the shared folder and read back.

    This cuts the lineage: what follows survives the loss of executors without
    computing ``df`` again, and every later use sees the same rows.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/foliary/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def drop_written(df: DataFrame) -> None:
    """Deletes the files of a frame that :func:`written` made and nothing reads any more; any other frame is left alone."""
    if path := getattr(df, "written_to", None):
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column``, one row at least."""
    import numpy as np
    import pyarrow.compute as pc

    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = np.cumsum(size + 1)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def give_back() -> None:
    """Memory that this process has freed goes back to the system, where the C library can do that."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)``; workers, which wait for further tasks, keep nothing of what a task has freed.

    A task has a worker for each of these that it runs without a shuffle between, so steps in Python are chained
    inside ``run`` instead.
    """

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(lean, schema)


def text_or_empty(df: DataFrame, column: str = "text") -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit("")))


Query = Callable[[SparkSession, str], DataFrame]


def runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Slices of consecutive rows with equal integer ``keys``; a run that goes over batches comes in several slices."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield tuple(int(c[a]) for c in columns), batch.slice(a, b - a)


def matrix(column: pa.Array, dtype: str = "f8"):
    """The rows of a list column of equal lengths as a matrix."""
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.asarray(flat, dtype).reshape(len(column), -1)


def finite(vector: str = "embedding"):
    """Whether a vector is not null or empty and holds neither nulls nor non-finite numbers."""
    from pyspark.sql import functions as F

    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & (F.size(vector) > 0), F.lit(False))
