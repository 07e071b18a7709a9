"""One row per key, chosen the same way every time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


# What makes a dimension row the latest, first column first.
STAMPS = ("dt", "event_date", "updated_at", "last_active", "created_at", "first_seen")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """Keep per key the row that is last by ``newest``, nulls being oldest.

    A hash of the whole row settles what the columns leave open, so two runs agree. The rank
    filter lets Spark drop all but one row per key in each task before the shuffle; a key with
    very many copies therefore never meets in one task. Null keys form one group.
    """
    order = [F.col(c).desc_nulls_last() for c in newest]
    order.append(F.xxhash64(*[F.col(c) for c in df.columns]))
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


# The day the row of a latest dimension is from; a frame with it has one row per key.
LATEST_DT = "latest_dt"


def latest_dim(dim: DataFrame, key: str) -> DataFrame:
    """A dimension kept per (key, dt) reduced to one row per key, its last day.

    A stored latest dimension is one already and passes as it is, without a window or a shuffle.
    """
    if LATEST_DT in dim.columns:
        return dim
    return latest_per_key(dim, [key], [c for c in STAMPS if c in dim.columns])


def latest_snapshot(fact: DataFrame) -> DataFrame:
    """Only the last day's counters per media and visitor.

    For feeds whose counters are running totals: summing every day's copy would count them again
    and again.
    """
    return latest_per_key(fact, ["media_id", "visitor_id"], ["dt"])
