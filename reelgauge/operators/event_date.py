"""The day an interaction counts for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import day_of
from .dedup import latest_dim
from ..sources.tables import staged
from .joins import BROADCAST_BYTES, HOT_KEYS, hot_key_left_join, measured_bytes, narrow_dim

# latest_activity: last_active, else first_seen, else the day the media was created.
# first_seen: that day only.
MODES = ("latest_activity", "first_seen")


def own_day(fact: DataFrame, mode: str = "latest_activity") -> Column:
    """The event day a row states itself, null if it has no stamp."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if mode == "first_seen":
        return day_of(fact, "first_seen")
    return F.coalesce(day_of(fact, "last_active"), day_of(fact, "first_seen"))


def media_days(media_dim: DataFrame) -> DataFrame:
    """(media_id, media_created_date), one row per media, so a join cannot multiply facts."""
    latest = latest_dim(narrow_dim(media_dim), "media_id")
    return latest.select("media_id", day_of(latest, "created_at").alias("media_created_date"))


def resolve_event_date(
    fact: DataFrame,
    media_dim: DataFrame,
    mode: str = "latest_activity",
    broadcast_bytes: int = BROADCAST_BYTES,
    hot_keys: int = HOT_KEYS,
) -> DataFrame:
    """Add ``event_date`` to every fact row; it stays null where nothing gives a day.

    The columns are those of the fact and ``event_date`` last; one the fact had is replaced.

    The media days are measured first. Up to ``broadcast_bytes`` they are broadcast and the fact
    is not shuffled. Beyond that only the rows without a day of their own are joined, those of
    the ``hot_keys`` most frequent media still without a shuffle, and the others pass by untouched.
    The rows to join are staged, so that the fact itself is read twice and not once per step.
    """
    fact = fact.drop("event_date")
    dated = fact.withColumn("event_date", own_day(fact, mode))
    if mode == "first_seen":
        return dated
    days = media_days(media_dim)
    if measured_bytes(days) <= broadcast_bytes:
        joined = dated.join(F.broadcast(days), "media_id", "left")
        day = F.coalesce("event_date", "media_created_date")
        return joined.withColumn("event_date", day).select(*dated.columns)
    missing = staged(
        fact.where(own_day(fact, mode).isNull() & F.col("media_id").isNotNull()), "missing-day"
    )
    found = hot_key_left_join(missing, days, "media_id", hot_keys).withColumnRenamed(
        "media_created_date", "event_date"
    ).select(*dated.columns)
    return dated.where("event_date is not null or media_id is null").unionByName(found)


def event_date_coverage(fact: DataFrame, media_dim: DataFrame) -> DataFrame:
    """One row: fact rows, and rows without a day before and after the media fallback.

    Counted per media first, so the join sees one row per media.
    """
    per_media = fact.groupBy("media_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(own_day(fact).isNull()).alias("n_null")
    )
    joined = per_media.join(media_days(media_dim), "media_id", "left")
    still = F.when(F.col("media_created_date").isNull(), F.col("n_null")).otherwise(0)
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows"),
        F.coalesce(F.sum("n_null"), F.lit(0)).alias("null_before"),
        F.coalesce(F.sum(still), F.lit(0)).alias("null_after"),
    )
