"""Staging zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from parcelstar.schemas import conform, literal_frame
from parcelstar.sources.paths import path_exists, staged


def write_staged(
    tables: dict[str, DataFrame], staging_root: str, source: str, execution_date: str
) -> dict[str, int]:
    """Replace the staged tables of one feed and date; returns the rows written of each."""
    counts = {}
    for name, df in tables.items():
        path = staged(staging_root, source, execution_date, name)
        df.write.mode("overwrite").parquet(path)
        # A count without columns reads the Parquet footers only.
        counts[name] = df.sparkSession.read.schema(df.schema).parquet(path).count()
    return counts


def read_staged(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A staged table by case-insensitive column name, cast to `schema`; empty if absent."""
    if not path_exists(spark, path):
        return literal_frame(spark, [], schema)
    return conform(spark.read.parquet(path), schema)
