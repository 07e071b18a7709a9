"""Casts that never raise, and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(value: Column) -> Column:
    return value.try_cast("double")


def to_long(text: Column) -> Column:
    """Text to bigint, exactly; a decimal or exponent spelling is cut to its whole part.

    A cast that fails raises and is caught inside Spark, which costs many times what looking at
    the text does; so each cast is only tried on text it can be expected to read.
    """
    text = F.trim(text)
    whole = F.when(text.rlike("^[+-]?[0-9]{1,19}$"), text.try_cast("bigint"))
    cut = F.when(text.rlike("[0-9]"), text.try_cast("decimal(38,10)").try_cast("bigint"))
    return F.coalesce(whole, cut)


def number(value: Column) -> Column:
    """As double; unreadable and NaN values are null."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def number_or_zero(value: Column, as_type: str = "double") -> Column:
    """Unreadable, missing and NaN values count as 0."""
    return F.coalesce(number(value), F.lit(0.0)).cast(as_type)


def zero_long(value: Column) -> Column:
    return F.coalesce(value, F.lit(0)).cast("bigint")


def coalesce_text(*columns: str) -> Column:
    """First non-null of the columns, each as text."""
    return F.coalesce(*[F.col(c).cast("string") for c in columns])


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    """100 * part / whole as double, 0 where whole is 0 or missing; rounds half up."""
    ratio = F.try_divide(F.lit(100.0) * part, whole.cast("double"))
    if digits is not None:
        ratio = F.round(ratio, digits)
    return F.coalesce(ratio, F.lit(0.0))


def per_head(total: Column, heads: Column, digits: int = 2) -> Column:
    """total / heads rounded, 0 where there is nobody."""
    ratio = F.try_divide(total.cast("double"), heads.cast("double"))
    return F.coalesce(F.round(ratio, digits), F.lit(0.0))
