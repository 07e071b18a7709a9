"""Stamps and days."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def has_day(text: Column) -> Column:
    """Whether a text begins like ``2025-09-19``: a year of four digits, a month and a day of two.

    Spark's casts also read a time alone, as one of the day of the run, and years of five digits.
    """
    return (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")


def parse_ts(text: Column) -> Column:
    """Text to timestamp; text in no known spelling or without a day gives null, also under ANSI
    mode.

    Spark's cast reads every ISO-8601 spelling the feeds use (a test holds it to that) and more.
    Trying patterns one after the other would only cost: text that none of them matches raises and
    catches an exception per pattern and row.
    """
    text = F.trim(text)
    return F.when(has_day(text), F.try_to_timestamp(text))


def date10(text: Column) -> Column:
    """Day as written: the first ten characters, whatever the offset behind them says."""
    return F.when(has_day(text), F.try_to_date(F.substring(text, 1, 10)))


def day_of(df: DataFrame, name: str) -> Column:
    """Day of column ``name``: the UTC day of a typed stamp, the written day of text."""
    if df.schema[name].dataType.typeName() == "string":
        return date10(F.col(name))
    return F.to_date(F.col(name))


def with_ymd(df: DataFrame, name: str = "event_date") -> DataFrame:
    """Add the year, month and day that gold is partitioned by."""
    return df.withColumns(
        {"year": F.year(name), "month": F.month(name), "day": F.dayofmonth(name)}
    )


def days_between(start: Column, end: Column) -> Column:
    """Array of the days from start to end, both included; empty where end is before start."""
    return F.when(end >= start, F.sequence(start, end)).otherwise(
        F.array().cast("array<date>")
    )


def backfill_days(df: DataFrame, start: Column, exec_day: Column, end: Column) -> DataFrame:
    """One row per day to land, ``day``: from start to the earlier of exec_day and end."""
    return df.select(
        F.explode(days_between(start, F.least(exec_day, end))).alias("day")
    )


def last_n_days(today: date, days: int = 30) -> tuple[date, date]:
    """Default range of the reports."""
    return today - timedelta(days=days), today


def as_range(chosen: date | tuple[date, date]) -> tuple[date, date]:
    """A single date stands for that day."""
    return chosen if isinstance(chosen, tuple) else (chosen, chosen)
