"""What a feed's counters mean: counts of the day, or totals that run on from day to day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .dedup import latest_snapshot

# daily: each day's row counts that day alone. latest: rows are running totals, the last one counts.
# increments: rows are running totals, and what each adds to the one before counts on its own day.
COUNTERS = ("daily", "latest", "increments")
# What a total below the one before means: the counter began again, or it was set right.
FALLS = ("reset", "correction")

KEYS = ("media_id", "visitor_id")
TOTALS = ("load_count", "play_count")


def running_increments(
    fact: DataFrame,
    falls: str = "reset",
    idle: bool = True,
    keys: Sequence[str] = KEYS,
    totals: Sequence[str] = TOTALS,
) -> DataFrame:
    """``fact`` with each running total replaced by what it adds to the last one before it.

    The first total of a key adds itself. A total below the one before began again at zero and adds
    itself (``reset``), or takes back what was too much (``correction``). A missing total adds
    nothing and leaves the one before standing; days without a row go to the next row. The order of
    the rows does not matter, ``dt`` does; of several rows of a key and day, which silver does not
    have, the larger totals come later. ``idle=False`` leaves out rows that add nothing.

    One shuffle by the keys, and a window whose rows are the days of one key.
    """
    if falls not in FALLS:
        raise ValueError(f"falls must be one of {FALLS}, not {falls!r}")
    days = Window.partitionBy(*keys).orderBy("dt", *totals)
    earlier = days.rowsBetween(Window.unboundedPreceding, -1)
    added = {}
    for name in totals:
        now, before = F.col(name), F.last(name, ignorenulls=True).over(earlier)
        gain = now - F.coalesce(before, F.lit(0))
        added[name] = F.when(now < before, now).otherwise(gain) if falls == "reset" else gain
    out = fact.withColumns(added)
    if idle:
        return out
    return out.where(F.greatest(*[F.coalesce(F.abs(c), F.lit(0)) for c in totals]) > 0)


def counted(fact: DataFrame, counters: str = "daily") -> DataFrame:
    """The rows of a fact that count, with what they count for, in one of three ``COUNTERS``."""
    if counters not in COUNTERS:
        raise ValueError(f"counters must be one of {COUNTERS}, not {counters!r}")
    if counters == "latest":
        return latest_snapshot(fact)
    return running_increments(fact, idle=False) if counters == "increments" else fact
