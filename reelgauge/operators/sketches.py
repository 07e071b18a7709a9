"""Distinct visitors of any range and media selection from sketches stored per day."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Logarithm of the registers of a sketch: 4,096 bytes at most, less for few visitors.
REGISTERS = 12
SKETCH = "visitors_sketch"


def visitor_sketches(dated_fact: DataFrame, registers: int = REGISTERS) -> DataFrame:
    """One sketch of its visitors per media and event date; rows without a visitor add nothing.

    A sketch is combined in each task before the shuffle, however hot a media is.
    """
    return dated_fact.groupBy("media_id", "event_date").agg(
        F.hll_sketch_agg("visitor_id", registers).alias(SKETCH)
    )


def visitors_of(sketches: DataFrame, *by: str | Column) -> DataFrame:
    """``by`` and ``visitors``: about how many distinct visitors the sketches of a group hold
    together. A visitor of several days or media counts once; no group gives 0 for no sketch."""
    together = F.hll_sketch_estimate(F.hll_union_agg(SKETCH))
    return sketches.groupBy(*by).agg(F.coalesce(together, F.lit(0)).alias("visitors"))


def relative_error(registers: int = REGISTERS, deviations: int = 3) -> float:
    """The part of the true number by which an estimate is off, at that many deviations."""
    return deviations * 1.04 / math.sqrt(2**registers)
