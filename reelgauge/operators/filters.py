"""Report filters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Up to here a selection is a list of literals, beyond it a semi join.
LITERAL_IDS = 200


def date_between(df: DataFrame, start: date, end: date, name: str = "event_date") -> DataFrame:
    """Rows of the days from start to end, both included; rows without a date fall out.

    On a gold table the same range is put on its partition columns, which keeps other days'
    files from being read at all.
    """
    low, high = F.lit(start).cast("date"), F.lit(end).cast("date")
    df = df.where(F.col(name).between(low, high))
    if name == "event_date" and {"year", "month", "day"} <= set(df.columns):
        df = df.where(F.make_date("year", "month", "day").between(low, high))
    return df


def media_in(df: DataFrame, chosen: Sequence[str] | DataFrame | None) -> DataFrame:
    """Rows of the chosen media ids (a list, or a frame with ``media_id``); none chosen: all.

    A list and a frame with the same ids give the same rows and columns, an empty one all rows.
    """
    if chosen is None:
        return df
    if not isinstance(chosen, DataFrame):
        ids = sorted(set(chosen))
        if not ids:
            return df
        if len(ids) <= LITERAL_IDS:
            return df.where(F.col("media_id").isin(ids))
        chosen = df.sparkSession.createDataFrame([(i,) for i in ids], "media_id string")
    ids = chosen.select(F.col("media_id").alias("_chosen")).where("_chosen is not null").distinct()
    if ids.isEmpty():
        return df
    return df.join(ids, df["media_id"] == F.col("_chosen"), "left_semi")
