"""Strict date parsing: text that does not fit the format gives NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def plain_date(c: Column) -> Column:
    return F.try_to_date(c, "yyyy-MM-dd")


def iso_instant_date(c: Column) -> Column:
    """Date of `2024-01-15T00:00:00.000Z`."""
    return F.to_date(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")))
