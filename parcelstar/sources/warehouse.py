"""Warehouse tables as Parquet folders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstar import schemas
from parcelstar.operators.dimensions import dim_property_type
from parcelstar.schemas import conform, literal_frame
from parcelstar.sources.paths import drop_folders, partition_values, path_exists

SCHEMAS = {
    "dim_location": schemas.DIM_LOCATION,
    "fact_listings": schemas.FACT_LISTINGS,
    "fact_market_stats": schemas.FACT_MARKET_STATS,
    "pipeline_metadata": schemas.PIPELINE_METADATA,
    "data_quality_log": schemas.DATA_QUALITY_LOG,
    "quality_partials": schemas.QUALITY_PARTIALS,
}

# Queries filter facts by source; a batch has a folder of its own.
PARTITIONS = {
    "fact_listings": ["source", "batch_id"],
    "fact_market_stats": ["source", "batch_id"],
}


@dataclass(frozen=True)
class Warehouse:
    """One writer, append only."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        if name == "dim_property_type":
            return dim_property_type(self.spark)
        schema = SCHEMAS[name]
        if not path_exists(self.spark, self.path(name)):
            return literal_frame(self.spark, [], schema)
        return self.spark.read.schema(schema).parquet(self.path(name)).select(*schema.names)

    def loaded_batches(self, name: str) -> DataFrame:
        """Batch ids of a fact whose load has been audited as a success; one row per batch."""
        done = (F.col("table_name") == name) & (F.col("status") == "SUCCESS")
        return (
            self.table("pipeline_metadata")
            .where(done & F.col("fact_batch_id").isNotNull())
            .select(F.col("fact_batch_id").alias("batch_id"))
            .distinct()
        )

    def batch_folders(self, name: str) -> set[str]:
        """The batches a fact table has rows of, from its folders; NULL has one, too."""
        return set(partition_values(self.spark, f"{self.path(name)}/source=*", "batch_id"))

    def discard_unfinished(self, name: str, new: DataFrame) -> list[str]:
        """Delete what an unfinished load left of the batches that are about to load.

        `new` holds the rows of batches without a SUCCESS row, as the batch guard gives them.
        """
        folders = f"{self.path(name)}/source=*"
        if not self.batch_folders(name):
            return []
        rows = new.select("batch_id").distinct().collect()  # a staged table's batches
        batches = {r[0] for r in rows if r[0] is not None}
        return drop_folders(self.spark, folders, "batch_id", batches)

    def append(self, name: str, df: DataFrame) -> None:
        rows = conform(df, SCHEMAS[name])
        (
            rows.write.mode("append")
            .partitionBy(*PARTITIONS.get(name, []))
            .parquet(self.path(name))
        )
