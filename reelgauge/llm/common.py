"""Helpers the operators share: tables, Arrow batches of bounded size, words."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from reelgauge.session import scratch_path

# White space that ends a word; bytes.split() without arguments cuts at exactly these six bytes.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def python_tasks(spark: SparkSession) -> None:
    """Settings for operators whose tasks run Python.

    Arrow batches are held to 2,000 rows and 16 MB, so that a task's memory stays bounded; a session
    that already asks for smaller batches keeps them. Workers also look for this package where the
    driver found it, so that it need not be installed on a shared file system; elsewhere
    ``--py-files`` brings it.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows, "10000")) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    spark.conf.set(size, str(BATCH_BYTES))


def utf8(column) -> list[bytes | None]:
    """The texts of an Arrow column as UTF-8 bytes; null stays None."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def long_lists(values: bytes, counts: np.ndarray, kind=pa.int32()) -> pa.Array:
    """An Arrow list column from all values in one buffer and the number of values per row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    flat = pa.Array.from_buffers(kind, int(offsets[-1]), [None, pa.py_buffer(values)])
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the folder all executors share and read again.

    It cuts the lineage: what is lost later is read, not computed anew, and a recomputation cannot
    deal rows out differently. The folder goes when the application ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)
