"""Daily aggregates. Neither carries a visitor's email or name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .counters import counted
from .event_date import media_days, own_day, resolve_event_date
from .joins import BROADCAST_BYTES

# What media_interactions means: fact rows, or the sum of plays.
INTERACTIONS = ("rows", "sum_plays")
SUMS = {"total_loads": "load_count", "total_plays": "play_count"}
VISITOR_INPUT = (
    "media_id", "visitor_id", "dt", "load_count", "play_count", "first_seen", "last_active"
)


def media_daily(
    fact: DataFrame,
    media_dim: DataFrame | None = None,
    mode: str = "latest_activity",
    latest_only: bool = False,
    counters: str = "daily",
) -> DataFrame:
    """Loads and plays per media and event date; rows without any date keep a null date.

    Counters of every ``dt`` are added up. Where the feed lands running totals each day, use
    ``counters="increments"`` for what each day added, or ``"latest"`` (the same as
    ``latest_only``) to keep the last day per media and visitor.

    The fact is summed per media and own day before it meets the dimension: the join then sees
    media x days rows, with a media at most once among those that lack a day, however hot it is
    in the fact.
    """
    fact = counted(fact, "latest" if latest_only else counters)
    per_day = (
        fact.withColumn("event_date", own_day(fact, mode))
        .groupBy("media_id", "event_date")
        .agg(*[F.sum(source).alias(name) for name, source in SUMS.items()])
    )
    if mode == "first_seen":
        return per_day
    if media_dim is None:
        raise ValueError("the fallback to the media's day needs media_dim")
    joined = per_day.join(media_days(media_dim), "media_id", "left")
    day = F.coalesce("event_date", "media_created_date")
    return (
        joined.withColumn("event_date", day)
        .groupBy("media_id", "event_date")
        .agg(*[F.sum(name).alias(name) for name in SUMS])
    )


def media_sums(dated_fact: DataFrame) -> DataFrame:
    """The media aggregate of a fact that has its ``event_date``."""
    sums = [F.sum(source).alias(name) for name, source in SUMS.items()]
    return dated_fact.groupBy("media_id", "event_date").agg(*sums)


def visitor_sums(dated_fact: DataFrame, interactions: str = "rows") -> DataFrame:
    """The visitor aggregate of a fact that has its ``event_date``."""
    if interactions not in INTERACTIONS:
        raise ValueError(f"interactions must be one of {INTERACTIONS}, not {interactions!r}")
    counted = F.count("media_id") if interactions == "rows" else F.sum("play_count")
    return dated_fact.groupBy("visitor_id", "event_date").agg(
        counted.alias("media_interactions"),
        F.sum("play_count").alias("total_plays"),
        F.sum("load_count").alias("total_loads"),
    )


def visitor_daily(
    fact: DataFrame,
    media_dim: DataFrame | None = None,
    mode: str = "latest_activity",
    interactions: str = "rows",
    latest_only: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES,
    counters: str = "daily",
) -> DataFrame:
    """Interactions, plays and loads per visitor and event date; see ``media_daily``."""
    if media_dim is None and mode != "first_seen":
        raise ValueError("the fallback to the media's day needs media_dim")
    fact = counted(fact, "latest" if latest_only else counters)
    fact = fact.select(*[c for c in fact.columns if c in VISITOR_INPUT])
    return visitor_sums(resolve_event_date(fact, media_dim, mode, broadcast_bytes), interactions)
