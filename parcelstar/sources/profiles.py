"""Profiles of a growing table: what each batch adds is stored, and merged when it is read.

A batch leaves counts, extremes and two sketches per column, of its distinct values and, for
numbers, of their quantiles. Sketches merge without a look at the rows, so a profile of all
batches reads a row per batch and column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    LongType,
    NumericType,
    StringType,
    StructField,
)

from parcelstar.operators.profiling import _per_column
from parcelstar.schemas import conform, literal_frame, struct
from parcelstar.sources.paths import finished_folders

#: Size of the sketches: distinct values to about 1.6 %, ranks to about half a percent.
DISTINCT_LOG, QUANTILE_K = 12, 800

_PARTIAL = struct(
    column_name=StringType(), column_type=StringType(), row_count=LongType(),
    null_count=LongType(), low=DoubleType(), high=DoubleType(), low_text=StringType(),
    high_text=StringType(), distinct=BinaryType(), quantiles=BinaryType(),
)


def _measures(field: StructField) -> dict[str, Column]:
    c = F.col(f"`{field.name}`")
    number = isinstance(field.dataType, NumericType)
    value = c.cast("double") if number else F.lit(None).cast("double")
    text = F.lit(None).cast("string") if number else c.cast("string")
    # An empty sketch, so that a column of NULLs can be merged as well.
    quantiles = F.kll_sketch_agg_double(value, QUANTILE_K) if number else F.max(F.lit(None).cast("binary"))
    return {
        "null_count": F.count_if(c.isNull()),
        "low": F.min(value),
        "high": F.max(value),
        "low_text": F.min(text),
        "high_text": F.max(text),
        "distinct": F.hll_sketch_agg(c.cast("string"), DISTINCT_LOG),
        "quantiles": quantiles,
    }


def partial_profile(df: DataFrame) -> DataFrame:
    """A row per column of a batch, from one pass; to be merged with those of other batches."""
    return conform(_per_column(df, _measures), _PARTIAL)


def merged_profile(partials: DataFrame, at: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One profile from partial ones.

    column_name, column_type, row_count, null_count, approx_distinct, min_value and max_value as
    text, and for numbers `quantiles`: the values at these ranks, NULL for a column without any.
    """
    merged = partials.groupBy("column_name", "column_type").agg(
        F.sum("row_count").alias("row_count"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("approx_distinct"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.min("low_text").alias("low_text"),
        F.max("high_text").alias("high_text"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )
    ranks = F.array(*map(F.lit, at))
    known = F.col("low").isNotNull()
    return merged.select(
        "column_name",
        "column_type",
        "row_count",
        "null_count",
        "approx_distinct",
        F.coalesce(F.col("low").cast("string"), "low_text").alias("min_value"),
        F.coalesce(F.col("high").cast("string"), "high_text").alias("max_value"),
        F.when(known, F.kll_sketch_get_quantile_double("quantiles", ranks)).alias("quantiles"),
    )


@dataclass(frozen=True)
class Profiles:
    """Partial profiles by batch, a folder each; a batch that comes again replaces its own."""

    spark: SparkSession
    root: str

    def add(self, batch: str, rows: DataFrame) -> None:
        partial_profile(rows).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/batch={batch}")

    def partials(self) -> DataFrame:
        done, _ = finished_folders(self.spark, self.root, "batch")
        if not done:
            return literal_frame(self.spark, [], _PARTIAL)
        return self.spark.read.schema(_PARTIAL).parquet(*done)

    def profile(self, at: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
        """The profile of all finished batches."""
        return merged_profile(self.partials(), at)
