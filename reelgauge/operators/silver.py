"""Bronze rows to typed, deduplicated silver tables.

Fixed values: the names of the feeds' fields and of the tables' columns, and which field fills which
column, are those of the data contract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import to_double, to_long
from ..functions.paths import (
    MEDIAS_FILE, METADATA_FILE, VISITORS_FILE, dt_from_path, id_from_path,
)
from ..functions.times import parse_ts
from ..schemas import SOURCE_PATH
from .dedup import latest_per_key
from .joins import with_title


def filled(name: str) -> Column:
    """The column with empty text as null."""
    return F.nullif(F.col(name), F.lit(""))


def ensure_dt(df: DataFrame) -> DataFrame:
    """``dt`` as a date: the column if there is one, else the day folder of the file."""
    if "dt" in df.columns:
        return df.withColumn("dt", F.col("dt").try_cast("date"))
    return df.withColumn("dt", dt_from_path(F.col(SOURCE_PATH)))


def media_id_or_name(pattern: str, own: str = "media_id") -> Column:
    """The row's own media id, else the one in its file name; null if neither has it."""
    return F.coalesce(filled(own), id_from_path(F.col(SOURCE_PATH), pattern))


def ensure_media_id(df: DataFrame, pattern: str, own: str = "media_id") -> DataFrame:
    return df.withColumn("media_id", media_id_or_name(pattern, own))


def with_ids(df: DataFrame) -> DataFrame:
    """``media_id``, ``dt`` and ``event_date`` read off the file path alone, for any dataset."""
    path = F.col(SOURCE_PATH)
    return df.withColumns(
        {"media_id": id_from_path(path), "dt": dt_from_path(path), "event_date": dt_from_path(path)}
    )


def media_rows(metadata: DataFrame) -> DataFrame:
    """Metadata flattened and typed, not yet deduplicated."""
    df = ensure_dt(ensure_media_id(metadata, METADATA_FILE, own="hashed_id"))
    return df.select(
        "media_id",
        F.col("name").alias("title"),
        to_double(F.col("duration")).alias("duration_seconds"),
        parse_ts(F.col("created")).alias("created_at"),
        parse_ts(F.col("updated")).alias("updated_at"),
        "status",
        "tags",
        F.col("project.id").alias("project_id"),
        F.col("project.name").alias("project_name"),
        F.col("thumbnail.url").alias("thumbnail_url"),
        "dt",
    )


def dim_media(metadata: DataFrame) -> DataFrame:
    """One row per media and day, the last update winning."""
    return latest_per_key(media_rows(metadata), ["media_id", "dt"], ["updated_at", "created_at"])


def dim_visitor(visitors: DataFrame) -> DataFrame:
    """One row per visitor and day, the last activity winning."""
    rows = ensure_dt(visitors).select(
        filled("visitor_key").alias("visitor_id"),
        F.col("visitor_identity.email").alias("email"),
        F.col("visitor_identity.name").alias("name"),
        F.col("visitor_identity.org.name").alias("org_name"),
        F.col("visitor_identity.org.title").alias("org_title"),
        F.col("user_agent_details.browser").alias("browser"),
        F.col("user_agent_details.platform").alias("platform"),
        F.col("user_agent_details.mobile").try_cast("boolean").alias("is_mobile"),
        parse_ts(F.col("created_at")).alias("first_seen"),
        parse_ts(F.col("last_active_at")).alias("last_active"),
        "dt",
        "last_event_key",
    )
    kept = latest_per_key(rows, ["visitor_id", "dt"], ["last_active", "last_event_key"])
    return kept.drop("last_event_key")


def engagement_rows(visitors: DataFrame) -> DataFrame:
    """Visitor rows typed and with both keys present, not yet deduplicated."""
    df = ensure_dt(ensure_media_id(visitors, VISITORS_FILE))
    return df.select(
        "media_id",
        filled("visitor_key").alias("visitor_id"),
        to_long(F.col("load_count")).alias("load_count"),
        to_long(F.col("play_count")).alias("play_count"),
        "last_event_key",
        parse_ts(F.col("created_at")).alias("first_seen"),
        parse_ts(F.col("last_active_at")).alias("last_active"),
        "dt",
    ).where("media_id is not null and visitor_id is not null")


def fact_media_engagement(visitors: DataFrame) -> DataFrame:
    """Counters per media, visitor and day, the last activity winning."""
    return latest_per_key(
        engagement_rows(visitors),
        ["media_id", "visitor_id", "dt"],
        ["last_active", "last_event_key"],
    )


def fact_media_daily_raw(medias: DataFrame, media_dim: DataFrame | None = None) -> DataFrame:
    """The feed's own totals per media and day; the largest counters are the latest.

    The order covers every value column, so the latest row is the greatest struct of them: one
    aggregate that combines in each task. ``media_dim`` adds the title.
    """
    df = ensure_dt(ensure_media_id(medias, MEDIAS_FILE)).where("media_id is not null")
    rows = df.select(
        "media_id",
        to_long(F.col("load_count")).alias("load_count"),
        to_long(F.col("play_count")).alias("play_count"),
        to_double(F.col("play_rate")).alias("play_rate"),
        to_double(F.col("hours_watched")).alias("hours_watched"),
        to_double(F.col("engagement")).alias("engagement"),
        to_long(F.col("visitors")).alias("visitors"),
        "dt",
    )
    newest = ["load_count", "play_count", "hours_watched", "visitors", "engagement", "play_rate"]
    values = [c for c in rows.columns if c not in ("media_id", "dt")]
    latest = rows.groupBy("media_id", "dt").agg(F.max(F.struct(*newest)).alias("latest"))
    kept = latest.select("media_id", *[F.col("latest")[c].alias(c) for c in values], "dt")
    return kept if media_dim is None else with_title(kept, media_dim, "title")
