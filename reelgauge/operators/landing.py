"""Which days of the feeds are there, and which are still to be landed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import dt_from_path
from ..schemas import DATASETS

LANDED = "dataset string, day date, files long, bytes long"


def landed_days(
    spark: SparkSession, bronze_base: str, datasets: Sequence[str] = DATASETS
) -> DataFrame:
    """``dataset``, ``day``, ``files`` and ``bytes`` of every day folder that holds something.

    Files are listed, not opened. Empty files and files outside day folders do not count.
    """
    out = spark.createDataFrame([], LANDED)
    for dataset in datasets:
        path = f"{bronze_base.rstrip('/')}/{dataset}"
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found = files.select(dt_from_path(F.col("path")).alias("day"), "length").where("length > 0")
        out = out.unionByName(
            found.where("day is not null").groupBy(F.lit(dataset).alias("dataset"), "day").agg(
                F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
            )
        )
    return out


def incomplete_days(
    expected: DataFrame, landed: DataFrame, datasets: Sequence[str] = DATASETS
) -> DataFrame:
    """``day`` and the sorted datasets it is ``lacking``, for each expected day that lacks any.

    ``expected`` has a ``day`` per row, as ``backfill_days`` gives them.
    """
    there = landed.groupBy("day").agg(F.collect_set("dataset").alias("there"))
    wanted = F.array(*[F.lit(d) for d in sorted(datasets)])
    have = F.coalesce("there", F.array().cast("array<string>"))
    return (
        expected.select("day").where("day is not null").distinct().join(there, "day", "left")
        .select("day", F.array_except(wanted, have).alias("lacking")).where("size(lacking) > 0")
    )


def missing_days(
    expected: DataFrame, landed: DataFrame, datasets: Sequence[str] = DATASETS
) -> DataFrame:
    """``first_day``, ``last_day``, ``days``, ``lacking`` and ``partial``: runs of expected days
    that lack the same datasets. ``partial`` days have at least one other dataset.

    Days that follow each other differ from their rank by the same day; that day names the run. One
    row per calendar day goes into the window, however large the feeds are.
    """
    days = incomplete_days(expected, landed, datasets)
    rank = F.row_number().over(Window.partitionBy("lacking").orderBy("day"))
    return (
        days.withColumn("run", F.date_sub("day", rank)).groupBy("lacking", "run")
        .agg(
            F.min("day").alias("first_day"), F.max("day").alias("last_day"),
            F.count(F.lit(1)).alias("days"),
        )
        .select(
            "first_day", "last_day", "days", "lacking",
            (F.size("lacking") < len(set(datasets))).alias("partial"),
        )
    )
