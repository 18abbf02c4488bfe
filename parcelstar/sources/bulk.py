"""Bulk feed: CSV in, raw zone by state out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parcelstar.constants import BULK_SOURCE
from parcelstar.operators.facts import AUDIT_COLUMNS, audit
from parcelstar.runs import new_batch_id, today, utc_now
from parcelstar.schemas import BULK, conform, literal_frame
from parcelstar.sources.paths import landed_paths, path_exists, raw_bulk

RAW_BULK = StructType(
    [*BULK.fields, *[StructField(c, StringType()) for c in AUDIT_COLUMNS]]
)


def read_bulk_csv(
    spark: SparkSession, path: str, limit: int | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """The CSV with its header checked and every column typed; `limit` for a first look.

    A value that does not fit its type stops the read; `mode="PERMISSIVE"` makes it NULL.
    """
    rows = (
        spark.read.schema(BULK)
        .options(header=True, enforceSchema=False, mode=mode)
        .csv(path)
    )
    return rows if limit is None else rows.limit(limit)


def read_raw_bulk(spark: SparkSession, path: str) -> DataFrame:
    """All Parquet files under one date of the raw zone; of drops only the finished ones."""
    drops = landed_paths(spark, path)
    if not drops:
        return literal_frame(spark, [], RAW_BULK)
    reader = spark.read if drops == [path] else spark.read.option("basePath", path)
    return conform(reader.parquet(*drops), RAW_BULK)


def write_by_state(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per state; `state` stays in the files, rows without one get their own.

    The rebalance gathers a state's rows in few files, and the adaptive plan splits a
    large state over several tasks.
    """
    (
        df.withColumn("state_part", F.col("state"))
        .hint("rebalance", "state_part")
        .write.mode(mode)
        .partitionBy("state_part")
        .parquet(path)
    )


def land_bulk(
    spark: SparkSession,
    csv_path: str,
    raw_root: str,
    execution_date: str | None = None,
    batch_id: str | None = None,
    ingested_at: str | None = None,
) -> dict:
    """Land the CSV for one date, unless a finished landing of it is there already.

    The landing has a folder of its own (`drop=whole`) beside those of streams, whose rows
    stay.

    The date is today's, the batch id a fresh one and the time now, unless given.
    """
    execution_date = execution_date or today()
    batch_id = batch_id or new_batch_id()
    ingested_at = ingested_at or utc_now().isoformat()
    path = raw_bulk(raw_root, execution_date)
    own = f"{path}/drop=whole"
    if path_exists(spark, f"{own}/_SUCCESS"):
        return {"status": "skipped", "path": path}
    rows = read_bulk_csv(spark, csv_path)
    write_by_state(audit(rows, BULK_SOURCE, batch_id, ingested_at), own)
    landed = (
        spark.read.parquet(own)
        .groupBy("state_part")
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.count(F.lit(1)).alias("states"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        .first()
    )
    return {
        "status": "success",
        "source": BULK_SOURCE,
        "batch_id": batch_id,
        "execution_date": execution_date,
        "path": path,
        "records_count": landed["rows"],
        "chunks_written": landed["states"],
    }
