"""The engine's inputs read out of the star-schema test tables.

| engine input | table | how |
|---|---|---|
| visitors feed | events | one row per event, media from props, visitor from user_id |
| metadata feed | part | media ``m<p_size>``; many parts share a media, so the last update decides |
| medias feed | lineitem | one row per line, media from l_partkey, day from l_shipdate |

Sizes run from 1 to 50 and the events' media from 0 to 99, so half of the media in the fact have
no dimension row. Every table is used whole.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.paths import VISITORS_FILE
from ..operators.silver import ensure_dt, ensure_media_id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _event_media(events: DataFrame) -> Column:
    """Props hold one number, k; a pattern finds it several times faster than a JSON parse."""
    return F.concat(F.lit("m"), F.regexp_extract("props", '^\\{"k": *([0-9]+)\\}$', 1))


def _is(*kinds: str) -> Column:
    return F.col("event_type").isin(*kinds)


def event_fact(events: DataFrame) -> DataFrame:
    """A typed engagement fact straight from events, one row per event.

    Views and clicks load, clicks play. Signups and errors have no stamp of their own, views no
    last activity.
    """
    ts = F.col("ts").cast("timestamp")
    return events.select(
        _event_media(events).alias("media_id"),
        F.col("user_id").cast("string").alias("visitor_id"),
        F.when(_is("view", "click"), 1).otherwise(0).cast("bigint").alias("load_count"),
        F.when(_is("click"), 1).otherwise(0).cast("bigint").alias("play_count"),
        F.concat(F.lit("e"), "event_id").alias("last_event_key"),
        F.when(~_is("signup", "error"), ts).alias("first_seen"),
        F.when(~_is("signup", "error", "view"), ts).alias("last_active"),
        F.to_date(ts).alias("dt"),
    )


def running_fact(events: DataFrame) -> DataFrame:
    """A fact of running totals: per media, one of seven visitors and day, what was loaded and played
    since the last reset, which comes with every tenth day of a month."""
    days = event_fact(events).groupBy(
        "media_id", F.concat(F.lit("v"), F.pmod(F.col("visitor_id").cast("long"), F.lit(7)))
        .alias("visitor_id"), "dt",
    ).agg(
        F.sum("load_count").alias("load_count"), F.sum("play_count").alias("play_count"),
        F.max("last_event_key").alias("last_event_key"), F.min("first_seen").alias("first_seen"),
        F.max("last_active").alias("last_active"),
    )
    since = Window.partitionBy(
        "media_id", "visitor_id", F.trunc("dt", "month"), F.floor(F.dayofmonth("dt") / 10)
    ).orderBy("dt")
    return days.withColumns({
        name: F.sum(name).over(since) for name in ("load_count", "play_count")
    }).select(event_fact(events).columns)


def visitors_feed(events: DataFrame) -> DataFrame:
    """Raw visitor rows as they would be landed: nested, all text, some of it unusable.

    The kind of event decides the spelling of the stamps and whether the media id is in the row,
    missing or empty; the file name always has it.
    """
    day = F.to_date("ts").cast("string")
    milli = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    second = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    offset = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+02:00'")
    media, user = _event_media(events), F.col("user_id").cast("string")
    none = F.lit(None).cast("string")
    return events.select(
        user.alias("visitor_key"),
        F.struct(
            F.concat(F.lit("visitor"), user, F.lit("@example.com")).alias("email"),
            F.concat(F.lit("Visitor "), user).alias("name"),
            F.struct(
                F.concat(F.lit("Org "), F.length(user)).alias("name"),
                F.col("event_type").alias("title"),
            ).alias("org"),
        ).alias("visitor_identity"),
        F.struct(
            F.concat(F.lit("browser-"), "event_type").alias("browser"),
            F.when(F.col("value") < 10, "desktop").otherwise("phone").alias("platform"),
            F.when(F.col("value") < 10, "false").otherwise("true").alias("mobile"),
        ).alias("user_agent_details"),
        F.when(_is("click"), milli)
        .when(_is("view"), second)
        .when(_is("purchase"), offset)
        .when(_is("error"), "")
        .otherwise(none)
        .alias("created_at"),
        F.when(_is("click", "purchase"), milli)
        .when(_is("view"), "")
        .when(_is("error"), "garbage")
        .otherwise(none)
        .alias("last_active_at"),
        F.when(_is("click"), "1").when(_is("view"), "1.0").otherwise("0").alias("load_count"),
        F.when(_is("click"), "1").when(_is("error"), "n/a").otherwise("0").alias("play_count"),
        F.concat(F.lit("e"), "event_id").alias("last_event_key"),
        F.when(_is("view"), none).when(_is("error"), "").otherwise(media).alias("media_id"),
        day.alias("event_date"),
        F.concat(
            F.lit("file:/bronze/visitors/dt="), day, F.lit("/visitors_"), media,
            F.lit("_page1_"), day, F.lit(".ndjson"),
        ).alias("source_path"),
    )


def metadata_feed(part: DataFrame) -> DataFrame:
    """Raw media metadata, updated once a minute from the start of 2024 on."""
    media = F.concat(F.lit("m"), "p_size")
    start = F.lit("2024-01-01").cast("date")
    first = F.unix_timestamp(start.cast("timestamp"))
    updated = F.timestamp_seconds(first + F.col("p_partkey") * 60)
    day = F.date_format(updated, "yyyy-MM-dd")
    return part.select(
        media.alias("hashed_id"),
        F.col("p_name").alias("name"),
        F.col("p_retailprice").cast("string").alias("duration"),
        F.date_format(F.date_add(start, F.col("p_size")), "yyyy-MM-dd").alias("created"),
        F.date_format(updated, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated"),
        F.lit("ready").alias("status"),
        F.array("p_brand", "p_type").alias("tags"),
        F.struct(F.col("p_brand").alias("id"), F.col("p_type").alias("name")).alias("project"),
        F.struct(
            F.concat(F.lit("https://img.example.com/"), "p_partkey", F.lit(".jpg")).alias("url")
        ).alias("thumbnail"),
        F.concat(
            F.lit("file:/bronze/metadata/dt="), day, F.lit("/metadata_"), media, F.lit("_"), day,
            F.lit(".ndjson"),
        ).alias("source_path"),
    )


def medias_feed(lineitem: DataFrame) -> DataFrame:
    """Raw per-media totals; the media id is in the file name only."""
    day = F.to_date("l_shipdate").cast("string")
    none = F.lit(None).cast("string")
    return lineitem.select(
        F.col("l_quantity").cast("string").alias("load_count"),
        F.col("l_linenumber").cast("string").alias("play_count"),
        F.col("l_tax").cast("string").alias("play_rate"),
        F.col("l_extendedprice").cast("string").alias("hours_watched"),
        F.col("l_discount").cast("string").alias("engagement"),
        F.col("l_orderkey").cast("string").alias("visitors"),
        none.alias("media_id"),
        none.alias("event_date"),
        F.concat(
            F.lit("file:/bronze/medias/dt="), day, F.lit("/medias_m"), "l_partkey", F.lit("_"), day,
            F.lit(".ndjson"),
        ).alias("source_path"),
    )


def daily_totals_feed(events: DataFrame) -> DataFrame:
    """Raw per-media totals of each day of the events, with the media id in the row."""
    return (
        events.groupBy(_event_media(events).alias("media_id"), F.to_date("ts").alias("dt"))
        .agg(
            F.count_if(_is("view", "click")).cast("string").alias("load_count"),
            F.count_if(_is("click")).cast("string").alias("play_count"),
            F.count(F.lit(1)).cast("string").alias("visitors"),
        )
        .withColumn("event_date", F.col("dt").cast("string"))
    )


def old_media_gold(events: DataFrame) -> DataFrame:
    """Media gold in its older naming: text dates and numbers, some unreadable, and watch time."""
    day = F.to_date("ts").cast("string")
    return events.select(
        _event_media(events).alias("media_id"),
        F.when(_is("error"), "n/a").otherwise(day).alias("d"),
        F.when(_is("click"), "1").when(_is("signup"), "none").otherwise("0").alias("plays"),
        F.when(_is("click", "view"), "1").otherwise("0").alias("loads"),
        F.floor("value").cast("string").alias("watch_time"),
    )


def old_visitor_gold(events: DataFrame) -> DataFrame:
    """Visitor gold in its older naming, with the other name of the watch time."""
    return events.select(
        F.col("user_id").cast("string").alias("visitor_id"),
        F.to_date("ts").alias("d"),
        F.when(_is("click"), 1).otherwise(0).alias("plays"),
        F.floor("value").alias("seconds_watched"),
    )


def landed_rows(feed: DataFrame) -> DataFrame:
    """Feed rows ready for ``land_bronze``: media id in the row, ``dt`` from the path.

    Spark names the files it writes, so what the file name said has to move into the row.
    """
    if "visitor_key" in feed.columns:
        feed = ensure_media_id(feed, VISITORS_FILE)
    return ensure_dt(feed).drop("source_path")


def json_arrays(df: DataFrame) -> DataFrame:
    """Text lines that make one JSON array of each partition's rows, for multi-line files."""

    def bracket(batches):
        mark = "["
        for batch in batches:
            lines = "," + batch["line"]
            if mark == "[" and len(lines):
                lines.iloc[0] = mark + lines.iloc[0][1:]
                mark = "]"
            yield lines.to_frame("value")
        if mark == "]":
            yield pd.DataFrame({"value": [mark]})

    rows = df.select(F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("line"))
    return rows.mapInPandas(bracket, "value string")
