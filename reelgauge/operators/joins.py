"""Joins of facts and gold with the media dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import staged
from .dedup import LATEST_DT, STAMPS, latest_dim

# A side may be broadcast up to this many bytes, measured before the join is planned.
BROADCAST_BYTES = 128 * 1024 * 1024
# What a row of a hash table costs beside its own columns, generously.
ROW_OVERHEAD = 100
# This many keys are treated as hot where a side is too large to be broadcast.
HOT_KEYS = 10_000


def measured_bytes(df: DataFrame) -> int:
    """Size a narrow frame would have as a hash table; one aggregation job, one row back."""
    width = F.lit(ROW_OVERHEAD)
    for field in df.schema:
        if field.dataType.typeName() == "string":
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0))
        else:
            width = width + F.lit(8)
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()["size"]


def hot_key_left_join(
    left: DataFrame, right: DataFrame, key: str, hot_keys: int = HOT_KEYS
) -> DataFrame:
    """Left join of a fact with a one-row-per-key side of any size, for keys that may be very hot.

    The ``hot_keys`` most frequent keys of the fact are found first, pre-counted in each task, and
    kept in a scratch table. Their rows are joined by broadcast, which is safe as the side then has
    at most ``hot_keys`` rows, and are not shuffled. Of the rows that are, no key can hold more than
    one part in ``hot_keys``. Rows with a null key are expected to be kept out by the caller, and
    ``left`` to be cheap to read, as it is read three times.
    """
    top = left.groupBy(key).count().orderBy(F.desc("count"), key).limit(hot_keys).select(key)
    hot = F.broadcast(staged(top, "hot-keys"))
    few = F.broadcast(right.join(hot, key, "left_semi"))
    by_broadcast = left.join(hot, key, "left_semi").join(few, key, "left")
    by_shuffle = left.join(hot, key, "left_anti").join(right, key, "left")
    return by_broadcast.unionByName(by_shuffle)


def narrow_dim(media_dim: DataFrame, *columns: str) -> DataFrame:
    """The media dimension cut to its key, its stamps and the given columns."""
    keep = ("media_id", LATEST_DT, *STAMPS, *columns)
    return media_dim.select(*[c for c in media_dim.columns if c in keep])


def with_title(df: DataFrame, media_dim: DataFrame, name: str = "media_title") -> DataFrame:
    """Add the media title. ``df`` is at most one row per media and day, so no key is hot.

    ``media_dim`` is the history, or the stored latest dimension, which is not ranked again.
    """
    titles = latest_dim(narrow_dim(media_dim, "title"), "media_id")
    titles = titles.select("media_id", F.col("title").alias(name))
    return df.join(titles, "media_id", "left")


def unknown_media(fact: DataFrame, media_dim: DataFrame) -> DataFrame:
    """Media ids of the fact that have no dimension row.

    Both sides are reduced to distinct ids before they meet, so a hot media id is one row.
    """
    used = fact.select("media_id").distinct()
    known = media_dim.select("media_id").distinct()
    return used.join(known, "media_id", "left_anti")
