"""The frames behind the KPI page."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame

from ..operators import kpi
from ..operators.filters import date_between, media_in
from ..operators.quality import sample_rows


def media_frames(media_all: DataFrame, media: DataFrame) -> dict[str, DataFrame]:
    """Frames of the media side: ``media_all`` for the selector, ``media`` after the filters."""
    return {
        "media_list": kpi.media_list(media_all),
        "default_media": kpi.default_media(media_all),
        "media_totals": kpi.media_totals(media),
        "media_trend": kpi.trend(media),
        "media_kpis": kpi.media_kpis(media),
        "media_sample": sample_rows(media, 50),
    }


def visitor_frames(visitor: DataFrame) -> dict[str, DataFrame]:
    return {
        "visitor_totals": kpi.visitor_totals(visitor),
        "top_visitors": kpi.top_visitors(visitor),
        "visitor_trend": kpi.trend(visitor),
        "visitor_sample": sample_rows(visitor, 50),
    }


def in_range(gold: DataFrame, start: date, end: date) -> DataFrame:
    """Gold of a date range in canonical names; other days' files are not read.

    This is the frame worth keeping with ``cached_gold`` while a page is drawn from it.
    """
    return date_between(kpi.prep_kpi(gold), start, end)


def kpi_frames(
    media_gold: DataFrame,
    visitor_gold: DataFrame,
    start: date,
    end: date,
    chosen: Sequence[str] | DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every KPI frame of a date range and media selection, all lazy.

    The selection narrows the media frames only; visitor gold does not know the media.
    """
    media = media_in(in_range(media_gold, start, end), chosen)
    frames = media_frames(kpi.prep_kpi(media_gold), media)
    return frames | visitor_frames(in_range(visitor_gold, start, end))
