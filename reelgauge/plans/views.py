"""Gold as views, for reports written in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import with_title
from ..schemas import GOLD
from ..sources.tables import read_gold
from .gold_job import MEDIA, VISITOR
from .latest_media import read_latest_media

# The names existing SQL knows the two tables by.
VIEW_NAMES = {MEDIA: (MEDIA, f"{MEDIA}_p"), VISITOR: (VISITOR, f"{VISITOR}_p")}


def prunable(gold: DataFrame) -> DataFrame:
    """Gold whose ``event_date`` is made of the partition columns.

    The value is the same, and a plain ``event_date between ...`` then skips other days' files
    without the query having to know how the table is partitioned.
    """
    return gold.withColumn("event_date", F.make_date("year", "month", "day"))


def gold_views(spark: SparkSession, gold_base: str, silver_base: str) -> None:
    """Register the gold tables as temporary views, the media one with its titles."""
    media = prunable(read_gold(spark, gold_base, MEDIA, GOLD[MEDIA]))
    visitor = prunable(read_gold(spark, gold_base, VISITOR, GOLD[VISITOR]))
    titled = with_title(media, read_latest_media(spark, silver_base))
    frames = {MEDIA: titled, VISITOR: visitor}
    for table, df in frames.items():
        for name in VIEW_NAMES[table]:
            df.createOrReplaceTempView(name)
