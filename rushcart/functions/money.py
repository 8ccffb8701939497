"""Exact sums: decimals add up to the same total in whatever order rows arrive."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def line_revenue(price: str, discount: str) -> Column:
    """A price and a discount of two decimals each have a product of four.

    Its error as a double is far below the fifth, so one cast gives it exactly.
    """
    return (F.col(price) * (1 - F.col(discount))).cast("decimal(18,4)")


def fine(value: Column | str) -> Column:
    """A measurement as a whole number of its billionth parts, so that sums don't depend on order.

    A double of up to 9 * 10^9 has no finer digits that a clock could have measured.
    """
    value = F.col(value) if isinstance(value, str) else value
    return F.floor(value * 1e9 + 0.5).cast("decimal(20,0)")


def coarse(total: Column) -> Column:
    """A sum of :func:`fine` parts as a measurement again."""
    return total.cast("double") / 1e9


def whole(value: Column | str) -> Column:
    """A quantity as a decimal of four digits, for sums that don't depend on order."""
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(28,4)")


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Null instead of an error where the whole is 0."""
    part = F.col(part) if isinstance(part, str) else part
    whole = F.col(whole) if isinstance(whole, str) else whole
    return F.try_divide(part.cast("double"), whole.cast("double"))
