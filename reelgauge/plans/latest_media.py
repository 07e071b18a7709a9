"""One row per media, stored beside the history and kept current from the days that change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import LATEST_DT, latest_dim
from ..schemas import LATEST_MEDIA
from ..sources.tables import read_silver, table_path
from ..sources.versions import mark_stale, read_version, write_version

TABLE = "dim_media_latest"


def _path(silver_base: str) -> str:
    return table_path(silver_base, TABLE)


def _ranked(history: DataFrame) -> DataFrame:
    known = history.where("media_id is not null")
    return latest_dim(known, "media_id").withColumnRenamed("dt", LATEST_DT)


def read_latest_media(spark: SparkSession, silver_base: str) -> DataFrame:
    """The stored table; where there is none that can be trusted, the ranked history."""
    stored = read_version(spark, _path(silver_base), LATEST_MEDIA)
    return _ranked(read_silver(spark, silver_base, "dim_media")) if stored is None else stored


def invalidate_latest_media(spark: SparkSession, silver_base: str) -> None:
    """To be called before days of the dimension are rewritten."""
    mark_stale(spark, _path(silver_base))


def merged_latest(
    latest: DataFrame, history: DataFrame, days: Sequence[str]
) -> DataFrame:
    """The latest dimension after the given days of the history were rebuilt.

    A media keeps its row unless that row is from a rebuilt day or a rebuilt day has a later one.
    If its row was from a rebuilt day and the rebuilt days now end earlier for it, some other day may
    have its latest row: its rows are ranked anew, and only then is the rest of the history read.
    Rows without a day are the oldest.
    """
    rebuilt = F.coalesce(
        F.col("_day").isin([F.lit(d).cast("date") for d in days]), F.lit(False)
    )
    old = latest.withColumn("_day", F.col(LATEST_DT))
    fresh = _ranked(history.withColumn("_day", F.col("dt")).where(rebuilt).drop("_day"))
    kept = old.where(~rebuilt).drop("_day")
    now = fresh.select("media_id", F.col(LATEST_DT).alias("_now"))
    gone = old.where(rebuilt).join(now, "media_id", "left").where(
        F.col("_now").isNull() | (F.col("_now") < F.col(LATEST_DT))
    ).select("media_id")
    candidates = kept.unionByName(fresh)
    if gone.limit(1).count():
        candidates = candidates.unionByName(_ranked(history.join(gone, "media_id", "left_semi")))
    return _ranked(candidates.withColumnRenamed(LATEST_DT, "dt"))


def update_latest_media(
    spark: SparkSession, silver_base: str, days: Sequence[str] | None, trusted: bool = True
) -> None:
    """Bring the stored table up to date after the given days (None: all) were rebuilt.

    ``trusted`` says that it held before them; otherwise it is made from the whole history.
    """
    history = read_silver(spark, silver_base, "dim_media")
    path = _path(silver_base)
    current = None
    if days is not None and trusted:
        current = read_version(spark, path, LATEST_MEDIA, even_stale=True)
    df = _ranked(history) if current is None else merged_latest(current, history, days)
    write_version(df.select(*LATEST_MEDIA.names), path)


def latest_media_holds(spark: SparkSession, silver_base: str) -> bool:
    return read_version(spark, _path(silver_base), LATEST_MEDIA) is not None
