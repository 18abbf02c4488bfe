"""First look at a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField


def drop_empty(df: DataFrame, columns: list[str]) -> DataFrame:
    """Drop the rows in which all of `columns` are NULL."""
    return df.dropna(how="all", subset=columns)


def null_counts(df: DataFrame) -> DataFrame:
    """Rows and NULLs of every column, from one pass."""
    return _per_column(
        df, lambda f: {"null_count": F.count_if(F.col(f"`{f.name}`").isNull())}
    )


def profile(df: DataFrame) -> DataFrame:
    """Type, rows, NULLs, estimated distinct values, least and greatest value by column."""
    def measures(field: StructField) -> dict[str, Column]:
        c = F.col(f"`{field.name}`")
        return {
            "null_count": F.count_if(c.isNull()),
            "approx_distinct": F.approx_count_distinct(c),
            "min_value": F.min(c).cast("string"),
            "max_value": F.max(c).cast("string"),
        }

    return _per_column(df, measures)


def _per_column(df: DataFrame, measures: Callable[[StructField], dict[str, Column]]) -> DataFrame:
    """One row per column with the rows and what `measures` gives for it, from one pass."""
    by_field = [measures(field) for field in df.schema]
    row = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[v.alias(f"{i}_{m}") for i, own in enumerate(by_field) for m, v in own.items()],
    )
    entries = [
        F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("column_type"),
            F.col("row_count"),
            *[F.col(f"{i}_{m}").alias(m) for m in by_field[i]],
        )
        for i, field in enumerate(df.schema)
    ]
    return row.select(F.inline(F.array(*entries)))
