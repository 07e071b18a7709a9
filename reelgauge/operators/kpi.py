"""KPI frames over gold. A scalar KPI is a frame of one row."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import number, per_head, percent, zero_long
from .filters import date_between, media_in
from .joins import with_title

# Column names of older gold files and what they are called here.
ALIASES = {"d": "event_date", "plays": "total_plays", "loads": "total_loads"}
# Sources of the watch time, the first one a row has wins.
WATCH_COLUMNS = ("watch_time", "seconds_watched")


def unify_watch_time(df: DataFrame) -> DataFrame:
    """``watch_time_sec`` from the first watch column a row has a number in, else 0."""
    found = [number(F.col(name)) for name in WATCH_COLUMNS if name in df.columns]
    return df.withColumn("watch_time_sec", F.coalesce(*found, F.lit(0.0)))


def prep_kpi(df: DataFrame, numeric: Sequence[str] = ("total_plays", "total_loads")) -> DataFrame:
    """Gold in canonical names and types, whichever naming its files use, alone or mixed.

    Per row the canonical column counts, and the older name where that is null. A date that cannot
    be read becomes null, a number 0. Whole-number columns keep their type.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    older = {name: alias for alias, name in ALIASES.items()}
    for name in ("event_date", *numeric):
        names = [n for n in (name, older.get(name)) if n in kinds]
        if not names:
            continue
        if name == "event_date":
            value = F.coalesce(*[
                F.col(n) if isinstance(kinds[n], T.DateType)
                else F.try_to_date(F.col(n).cast("string")) for n in names
            ])
        elif all(isinstance(kinds[n], T.IntegralType) for n in names):
            value = zero_long(F.coalesce(*[F.col(n) for n in names]))
        else:
            value = F.coalesce(*[number(F.col(n)) for n in names], F.lit(0.0))
        if name in kinds:
            df = df.withColumn(name, value).drop(*[n for n in names if n != name])
        else:  # only the older name: the column keeps its place
            df = df.withColumn(names[0], value).withColumnRenamed(names[0], name)
    return unify_watch_time(df)


def _total(name: str) -> Column:
    """Sum cut to whole numbers, 0 for no rows."""
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")


def media_totals(media: DataFrame) -> DataFrame:
    """Plays, loads, play rate in percent and watch time over all rows."""
    totals = media.agg(
        _total("total_plays").alias("total_plays"),
        _total("total_loads").alias("total_loads"),
        _total("watch_time_sec").alias("total_watch_time_sec"),
    )
    rate = percent(F.col("total_plays"), F.col("total_loads"))
    return totals.withColumn("avg_play_rate", rate)


def unique_visitors(visitors: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct visitors, exact unless asked otherwise; null ids are not visitors."""
    counted = F.approx_count_distinct if approximate else F.count_distinct
    return visitors.agg(counted("visitor_id").alias("unique_visitors"))


def visitor_totals(visitors: DataFrame) -> DataFrame:
    """Distinct visitors, their plays and watch time, and watch time per visitor."""
    totals = visitors.agg(
        F.count_distinct("visitor_id").alias("unique_visitors"),
        _total("total_plays").alias("total_visitor_plays"),
        _total("watch_time_sec").alias("total_visitor_watch"),
    )
    each = per_head(F.col("total_visitor_watch"), F.col("unique_visitors"))
    return totals.withColumn("avg_watch_per_visitor", each)


def trend(df: DataFrame) -> DataFrame:
    """Plays and watch time per day in order, for media and visitor gold; dated rows only."""
    return (
        df.where("event_date is not null")
        .groupBy("event_date")
        .agg(F.sum("total_plays").alias("plays"), F.sum("watch_time_sec").alias("watch_time_sec"))
        .orderBy("event_date")
    )


def media_kpis(media: DataFrame) -> DataFrame:
    """Plays, loads, watch time and play rate per media, most played first."""
    return (
        media.where("media_id is not null")
        .groupBy("media_id")
        .agg(
            F.sum("total_plays").alias("plays"),
            F.sum("total_loads").alias("loads"),
            F.sum("watch_time_sec").alias("watch_time_sec"),
        )
        .withColumn("play_rate", percent(F.col("plays"), F.col("loads")))
        .orderBy(F.desc("plays"), "media_id")
    )


def top_visitors(visitors: DataFrame, n: int = 25) -> DataFrame:
    """The ``n`` visitors with most plays, then most watch time, then by id."""
    return (
        visitors.where("visitor_id is not null")
        .groupBy("visitor_id")
        .agg(F.sum("total_plays").alias("plays"), F.sum("watch_time_sec").alias("watch_time_sec"))
        .orderBy(F.desc("plays"), F.desc("watch_time_sec"), "visitor_id")
        .limit(n)
    )


def media_list(media: DataFrame, media_dim: DataFrame | None = None) -> DataFrame:
    """Distinct media ids, with titles where the frame has them, sorted for the selector.

    ``media_dim`` gives the titles to a frame without them, to one row per media.
    """
    names = [c for c in ("media_id", "media_title") if c in media.columns]
    listed = media.where("media_id is not null").select(*names).distinct()
    if media_dim is not None:
        listed, names = with_title(listed, media_dim), ["media_id", "media_title"]
    return listed.orderBy(*reversed(names))


def default_media(media: DataFrame, n: int = 15) -> DataFrame:
    """The first ``n`` media ids, which a report starts with; all of them if there are fewer."""
    ids = media.where("media_id is not null").select("media_id").distinct()
    return ids.orderBy("media_id").limit(n)


def summary_kpis(
    media: DataFrame,
    visitors: DataFrame,
    start: date,
    end: date,
    chosen: Sequence[str] | DataFrame | None = None,
) -> DataFrame:
    """Unique visitors, plays, loads and unrounded play rate of a range, in one row.

    ``chosen`` narrows the media side only: visitor gold does not know the media. The visitor
    count is a scalar subquery next to the media totals.
    """
    seen = unique_visitors(date_between(visitors, start, end))
    totals = media_in(date_between(media, start, end), chosen).agg(
        _total("total_plays").alias("total_plays"), _total("total_loads").alias("total_loads")
    )
    return totals.select(
        seen.scalar().alias("unique_visitors"),
        "total_plays",
        "total_loads",
        percent(F.col("total_plays"), F.col("total_loads"), None).alias("play_rate_pct"),
    )


def media_daily_series(
    media: DataFrame, start: date, end: date, chosen: Sequence[str] | DataFrame | None = None
) -> DataFrame:
    """Per day and media: title, plays and loads, missing numbers as 0, in day and title order.

    ``media`` is gold with ``media_title`` (see ``with_title``).
    """
    rows = media_in(date_between(media, start, end), chosen).select(
        "event_date",
        "media_id",
        "media_title",
        zero_long(F.col("total_plays")).alias("total_plays"),
        zero_long(F.col("total_loads")).alias("total_loads"),
    )
    return rows.orderBy("event_date", "media_title", "media_id")


def visitor_daily_series(visitors: DataFrame, start: date, end: date) -> DataFrame:
    """Interactions and plays per day of a range."""
    return (
        date_between(visitors, start, end)
        .groupBy("event_date")
        .agg(
            _total("media_interactions").alias("media_interactions"),
            _total("total_plays").alias("total_plays"),
        )
        .orderBy("event_date")
    )
