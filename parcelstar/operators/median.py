"""Median per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelstar.operators.ordering import PLACE, RUN, join_heads, rows_before, sorted_runs
from parcelstar.session import write_through

#: Distinct values up to which a sort by group replaces the sort into runs. Both give the
#: same value; only the plan differs.
SMALL_VALUES = 1_000_000


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Written table of the rows per group and distinct value (NULL included), as `_n`."""
    return write_through(
        df.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n")), "value-counts"
    )


def median_of_counts(
    counts: DataFrame,
    groups: list[str],
    value: str,
    name: str = "median",
    small_values: int = SMALL_VALUES,
) -> DataFrame:
    """Exact, interpolated median of each group as a double, from its value counts.

    The middle values are picked by position. Few distinct values are sorted by group;
    many are range-sorted into runs, so no task holds a whole group.
    """
    known = counts.where(F.col(value).isNotNull())
    if known.count() <= small_values:
        ordered = Window.partitionBy(*groups).orderBy(value)
        ends = known.withColumns(
            {
                "_end": F.sum("_n").over(ordered),
                "_total": F.sum("_n").over(Window.partitionBy(*groups)),
            }
        )
    else:
        ends = _ends_by_runs(known, groups, value)
    return _middle(ends, groups, value, name)


def median_by(
    df: DataFrame,
    groups: list[str],
    value: str,
    name: str = "median",
    small_values: int = SMALL_VALUES,
) -> DataFrame:
    """Exact, interpolated median of the non-NULL values of each group."""
    return median_of_counts(value_counts(df, groups, value), groups, value, name, small_values)


def _ends_by_runs(counts: DataFrame, groups: list[str], value: str) -> DataFrame:
    """Position after each value in its group, and the group's rows."""
    runs = sorted_runs(counts, [*groups, value])
    heads = runs.groupBy(RUN, *groups).agg(F.sum("_n").alias("_rows"))
    heads = heads.select(
        RUN,
        *groups,
        rows_before(heads, groups, "_rows").alias("_before"),
        F.sum("_rows").over(Window.partitionBy(*groups)).alias("_total"),
    )
    in_run = Window.partitionBy(RUN, *groups).orderBy(PLACE)
    return join_heads(runs, heads, groups).withColumn(
        "_end", F.col("_before") + F.sum("_n").over(in_run)
    )


def _middle(ends: DataFrame, groups: list[str], value: str, name: str) -> DataFrame:
    def covers(position: Column) -> Column:
        return (position >= F.col("_end") - F.col("_n")) & (position < F.col("_end"))

    low = F.floor((F.col("_total") - 1) / 2)
    high = F.floor(F.col("_total") / 2)
    picked = ends.where(covers(low) | covers(high))
    # Halves are added, so that the largest doubles do not overflow.
    number = F.col(value).cast("double")
    lower, upper = F.max(F.when(covers(low), number)), F.max(F.when(covers(high), number))
    return picked.groupBy(*groups).agg(
        F.when(lower == upper, lower).otherwise(lower / 2 + upper / 2).alias(name)
    )


def approx_median_by(
    df: DataFrame, groups: list[str], value: str, name: str = "median", accuracy: int = 10_000
) -> DataFrame:
    """Opt-in estimate in one pass, with relative rank error 1/accuracy."""
    return df.groupBy(*groups).agg(
        F.percentile_approx(value, 0.5, accuracy).cast("double").alias(name)
    )
