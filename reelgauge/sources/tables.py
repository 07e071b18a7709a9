"""Silver and gold tables: reads, the caller-owned cache, and idempotent writes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.times import with_ymd
from ..schemas import GOLD, SILVER
from ..session import scratch_path
from .mixed import read_mixed, unmergeable

YMD = ("year", "month", "day")


def table_path(base: str, table: str) -> str:
    return f"{base.rstrip('/')}/{table}"


def read_silver(spark: SparkSession, base: str, table: str) -> DataFrame:
    """A silver table with its declared schema: no footer is read to plan the scan."""
    return spark.read.schema(SILVER[table]).parquet(table_path(base, table))


def read_gold(
    spark: SparkSession, base: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """All files of a gold table united by column name, absent columns null.

    With ``schema`` the files are read as declared, which costs no look at their footers; without
    it Spark merges the schemas of all files, and files that give a column another type are read
    apart and cast to the type that holds both. A table that was never written, or holds no file,
    is an empty frame with the gold schema.
    """
    path = table_path(base, table)
    try:
        if schema is not None:
            return spark.read.schema(schema).parquet(path)
        return spark.read.option("mergeSchema", True).parquet(path)
    except Exception as error:
        if schema is None and unmergeable(error):
            return read_mixed(spark, path)
        absent = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
        if isinstance(error, AnalysisException) and error.getCondition() in absent:
            return spark.createDataFrame([], schema or GOLD[table])
        raise


@contextmanager
def cached_gold(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a gold frame for the reports built inside the ``with`` block, then let it go."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def write_partitioned(
    df: DataFrame | None,
    base: str,
    table: str,
    mode: str = "overwrite",
    by: tuple[str, ...] = ("dt",),
    files: int | None = None,
    spread: bool = True,
    measures: dict[str, Column] | None = None,
) -> Observation | None:
    """Write Parquet partitioned by ``by``; nothing to do for None.

    * overwrite replaces only the partitions that ``df`` has rows for, append adds files.
    * ``spread`` rebalances by the partition columns first: small partitions end in one file, a
      partition holding a third of the rows is split over many tasks. Pass False when all rows
      belong to one partition, which saves that shuffle.
    * ``files`` writes that many tasks' worth of files instead. The work before the write keeps
      its own width.
    * ``measures`` are aggregates taken while writing, without a job of their own.
    """
    if df is None:
        return None
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode must be overwrite or append, not {mode!r}")
    if files:
        df = df.repartition(files)
    elif spread:
        df = df.hint("rebalance", *[F.col(c) for c in by])
    seen = None
    if measures:
        seen = Observation()
        df = df.observe(seen, *[column.alias(name) for name, column in measures.items()])
    writer = df.write.mode(mode).option("compression", "snappy").partitionBy(*by)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(table_path(base, table))
    return seen


def write_full(
    df: DataFrame, base: str, table: str, by: tuple[str, ...] = (), rows_as: str | None = None
) -> Observation | None:
    """Replace a whole table, partitions without new rows included.

    ``df`` must not read from the same folder.
    """
    seen = None
    if by:
        df = df.hint("rebalance", *[F.col(c) for c in by])
    if rows_as:
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias(rows_as))
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if by:
        writer = writer.option("partitionOverwriteMode", "static").partitionBy(*by)
    writer.parquet(table_path(base, table))
    return seen


def write_gold(
    df: DataFrame,
    base: str,
    table: str,
    mode: str = "overwrite",
    measures: dict[str, Column] | None = None,
) -> Observation | None:
    """Gold days by year, month and day; overwriting a day again leaves the table unchanged.

    ``append`` is there for one-off loads only, a second run of it doubles the rows.
    """
    return write_partitioned(with_ymd(df), base, table, mode, by=YMD, measures=measures)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is on."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(conf).delete(target, True)


@contextmanager
def scratch_folder(spark: SparkSession, name: str) -> Iterator[str]:
    """A folder for intermediate tables, gone after the ``with`` block however that ends."""
    path = scratch_path(spark, name)
    try:
        yield path
    finally:
        drop_folder(spark, path)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the scratch folder and read from there: for a frame that is needed
    more than once and costs more than its own size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_days(spark: SparkSession, base: str, table: str, days: Iterable) -> None:
    """Delete gold day folders that have no rows any more; ``days`` are rows with an ``event_date``
    (null: rows without a date).

    Dynamic overwrite only touches partitions it has rows for.
    """
    for row in days:
        day = row["event_date"]
        parts = (day.year, day.month, day.day) if day else ("__HIVE_DEFAULT_PARTITION__",) * 3
        folder = "/".join(f"{k}={v}" for k, v in zip(YMD, parts))
        drop_folder(spark, f"{table_path(base, table)}/{folder}")
