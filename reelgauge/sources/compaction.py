"""Day folders with many small files rewritten as few large ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import BROADCAST_BYTES, measured_bytes

TARGET_BYTES = 256 * 1024 * 1024


def folder_files(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``folder`` and ``bytes`` of the Parquet files of a table; they are listed only."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    file = F.col("_metadata.file_path")
    return listed.select(
        file.alias("file"), F.regexp_replace(file, "/[^/]*$", "").alias("folder"),
        F.col("length").alias("bytes"),
    )


def packed(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``file`` and the ``bin`` it goes to, for the folders that fewer files could hold.

    A folder needs as many bins as its bytes fill of ``target_bytes``. Its files, smallest first,
    are laid end to end and cut into bins of even size; a file goes where its middle lies. A folder
    that already has no more files than bins, or a single one, is left alone. Bins are numbered
    through from 0 over all folders, by the files' folders, which are days, not rows.
    """
    per_folder = files.groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("all_bytes")
    ).withColumn("bins", F.greatest(F.lit(1), F.ceil(F.col("all_bytes") / target_bytes)).cast("int"))
    chosen = per_folder.where("files > bins")
    before = F.sum("bins").over(
        Window.orderBy("folder").rowsBetween(Window.unboundedPreceding, -1)
    )
    chosen = chosen.withColumn("first", F.coalesce(before, F.lit(0)))
    laid = Window.partitionBy("folder").orderBy("bytes", "file")
    middle = F.sum("bytes").over(laid) - F.col("bytes") / 2
    share = F.floor(middle * F.col("bins") / F.greatest("all_bytes", F.lit(1)))
    place = F.col("first") + F.least(F.col("bins") - 1, share)
    return files.join(F.broadcast(chosen), "folder").select(
        "file", "folder", place.cast("int").alias("bin"), "bytes"
    )


def compact(
    spark: SparkSession, path: str, schema: T.StructType | str, by: Sequence[str],
    target_bytes: int = TARGET_BYTES, broadcast_bytes: int = BROADCAST_BYTES,
) -> int:
    """Rewrite the folders of a table whose files are too many for their bytes; returns how many
    folders were rewritten.

    ``schema`` and ``by`` are the table's columns and the partition columns among them. Rows go to
    the bin of their file, one task and one file per bin, without being sorted or changed. Each
    folder is replaced as a whole when all its rows are written, by Spark's dynamic overwrite; what
    other runs add to the table meanwhile would be lost, so no other run may write to it. Reading the
    list of files and the names of the folders costs no look into the files.
    """
    plan = packed(folder_files(spark, path), target_bytes)
    plan = plan.persist()
    try:
        size = plan.agg(
            F.count_distinct("folder").alias("folders"), F.max("bin").alias("last"),
            F.count(F.lit(1)).alias("files"),
        ).first()
        if not size["files"]:
            return 0
        bins = plan.select(F.col("file").alias("_file"), "bin")
        if measured_bytes(bins) <= broadcast_bytes:
            bins = F.broadcast(bins)
        rows = spark.read.schema(schema).parquet(path)
        columns = rows.columns
        dealt = rows.withColumn("_file", F.col("_metadata.file_path")).join(bins, "_file")
        dealt = dealt.repartitionById(size["last"] + 1, F.col("bin")).select(*columns)
        writer = dealt.write.mode("overwrite").option("compression", "snappy").partitionBy(*by)
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
        return size["folders"]
    finally:
        plan.unpersist()
