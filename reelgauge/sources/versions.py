"""Small tables that are replaced as a whole without a moment in which they are gone.

Each write goes to a folder ``version=N`` of its own; readers take the highest one that is complete.
A table can be marked stale while what it is made from changes: it is then not read until the next
version is written, so a run that dies in between leaves no outdated rows behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Complete versions that stay: the current one, and the one a running query may still read.
KEPT = 2
STALE = "_stale"


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def _child(spark: SparkSession, path: str, name: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, in order."""
    system, folder = _folder(spark, path)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    numbers = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
    return sorted(n for n in numbers if system.exists(_child(spark, path, f"version={n}/_SUCCESS")))


def mark_stale(spark: SparkSession, path: str) -> None:
    """Take the table out of use until its next version is written."""
    system, folder = _folder(spark, path)
    if system.exists(folder):
        system.create(_child(spark, path, STALE), True).close()


def is_stale(spark: SparkSession, path: str) -> bool:
    system, _ = _folder(spark, path)
    return system.exists(_child(spark, path, STALE))


def read_version(
    spark: SparkSession, path: str, schema: T.StructType, even_stale: bool = False
) -> DataFrame | None:
    """The current version; None where there is none, or the table is stale.

    ``even_stale`` is for the run that marked it and now brings it up to date.
    """
    found = complete_versions(spark, path)
    if not found or not even_stale and is_stale(spark, path):
        return None
    return spark.read.schema(schema).parquet(f"{path}/version={found[-1]}")


def write_version(df: DataFrame, path: str) -> int:
    """Write the next version, which may be made from the current one; returns its number."""
    spark = df.sparkSession
    number = max(complete_versions(spark, path), default=0) + 1
    df.write.mode("overwrite").parquet(f"{path}/version={number}")
    system, _ = _folder(spark, path)
    system.delete(_child(spark, path, STALE), False)
    for old in complete_versions(spark, path)[:-KEPT]:
        system.delete(_child(spark, path, f"version={old}"), True)
    return number
