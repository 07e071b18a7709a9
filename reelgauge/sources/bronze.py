"""Bronze: day-partitioned JSON, read with declared schemas and landed idempotently."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import dt_from_path
from ..schemas import BRONZE, CORRUPT, SOURCE_PATH, as_text

FORMATS = ("ndjson", "json")


def read_schema(dataset: str) -> T.StructType:
    return as_text(BRONZE[dataset]).add(CORRUPT, "string")


def read_bronze(
    spark: SparkSession,
    base: str,
    dataset: str,
    fmt: str = "ndjson",
    days: list[str] | None = None,
    partitioned: bool = True,
) -> DataFrame:
    """Rows of one dataset plus ``source_path`` and ``_corrupt_record``.

    ``ndjson`` files split across tasks; ``json`` (one document, or one array, per file) gives
    each file to one task. ``days`` prunes to those ``dt=`` folders before any file is opened.
    ``partitioned=False`` takes every file below the folder, flat or not; ``dt`` then has to come
    from the path.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    reader = (
        spark.read.schema(read_schema(dataset))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", fmt == "json")
    )
    if not partitioned:
        reader = reader.option("recursiveFileLookup", True)
    df = reader.json(f"{base.rstrip('/')}/{dataset}")
    df = df.select("*", F.col("_metadata.file_path").alias(SOURCE_PATH))
    # Spark refuses a JSON scan that needs nothing but the corrupt column; leaning on a payload
    # column, in a term that is always null, lets corrupt lines be counted like any others.
    payload = F.col(df.columns[0])
    df = df.withColumn(CORRUPT, F.coalesce(CORRUPT, F.nullif(payload, payload)))
    if days:
        folder, path = F.col("dt").try_cast("date"), dt_from_path(F.col(SOURCE_PATH))
        day = folder if "dt" in df.columns else path
        df = df.where(day.isin([F.lit(d).cast("date") for d in days]))
    return df


def stage_bronze(
    df: DataFrame, path: str, measures: dict[str, Column]
) -> tuple[DataFrame, dict[str, int]]:
    """The rows as a Parquet table at ``path``, and ``measures`` taken on the way.

    JSON is parsed once, however many tables are built of it, and all of them see the same files.
    The table survives lost executors.
    """
    seen = Observation()
    rows = df.observe(seen, *[column.alias(name) for name, column in measures.items()])
    rows.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, lines that did not)."""
    keep = [c for c in (CORRUPT, SOURCE_PATH, "dt") if c in df.columns]
    bad = df.where(F.col(CORRUPT).isNotNull()).select(*keep)
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT), bad


def tag_rows(df: DataFrame, media_id: str | None, day: date | str) -> DataFrame:
    """Stamp the media and the day a feed page was fetched for onto its rows."""
    tags = {"event_date": F.lit(str(day)), "dt": F.lit(str(day)).cast("date")}
    if media_id is not None:
        tags["media_id"] = F.lit(media_id)
    return df.withColumns(tags)


def land_bronze(
    df: DataFrame, base: str, dataset: str, overwrite: bool = True, spread: bool = True
) -> None:
    """Write rows as NDJSON into their ``dt=`` folders.

    With ``overwrite`` the days present in ``df`` are replaced and all others stay, so landing a
    day again changes nothing; without it files are added to the day. ``spread`` gathers each day
    into few files, splitting a large one; for rows of one day it is not needed.
    """
    if spread:
        df = df.hint("rebalance", F.col("dt"))
    writer = df.write.mode("overwrite" if overwrite else "append").partitionBy("dt")
    if overwrite:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.json(f"{base.rstrip('/')}/{dataset}")


def land_day(df: DataFrame, base: str, dataset: str, day: date | str) -> None:
    """Replace one day folder, also when the day came back empty."""
    rows = df.drop("dt")
    rows.write.mode("overwrite").json(f"{base.rstrip('/')}/{dataset}/dt={day}")
