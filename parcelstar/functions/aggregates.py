"""Sums and means that can be merged over several grouping steps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(c: Column, exact: bool = False) -> Column:
    """Sum of a column.

    `exact` adds in fixed point with four decimals, so the result does not depend on
    the order in which partial sums meet; the default adds doubles.
    """
    return F.sum(c.cast("decimal(18,4)")) if exact else F.sum(c)


def mean(sum_: Column, count: Column) -> Column:
    """Mean from a sum and a count; NULL over no rows."""
    return sum_.cast("double") / F.nullif(count, F.lit(0))


def percent_change(old: Column, new: Column) -> Column:
    return F.round((new - old) / F.nullif(old, F.lit(0.0)) * 100, 2)
