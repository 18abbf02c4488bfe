"""Land new files of a drop folder; the stream's checkpoint remembers the old ones."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelstar.constants import BULK_SOURCE
from parcelstar.functions.text import known_state
from parcelstar.operators.facts import audit
from parcelstar.schemas import BULK, PAGE
from parcelstar.sources.api import by_state, envelopes, write_envelopes
from parcelstar.sources.bulk import write_by_state
from parcelstar.sources.paths import STREAM_DROP, raw_api_listings, raw_bulk


def stream_bulk_csv(
    spark: SparkSession, drop_folder: str, max_files: int | None = None
) -> DataFrame:
    """Stream of the CSV files that arrive in a folder."""
    reader = (
        spark.readStream.schema(BULK).options(header=True, enforceSchema=False, mode="FAILFAST")
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.csv(drop_folder)


def stream_pages(
    spark: SparkSession, drop_folder: str, max_files: int | None = None
) -> DataFrame:
    """Stream of the fetched API pages that arrive in a folder, as JSON lines."""
    reader = spark.readStream.schema(PAGE).option("mode", "FAILFAST")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(drop_folder)


def drop_name(checkpoint: str, number: int) -> str:
    """Folder of a micro-batch: it is told apart by its checkpoint and its number."""
    identity = hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]
    return f"{STREAM_DROP}{identity}-{number}"


def _land(files: DataFrame, checkpoint: str, write: Callable[[DataFrame, int], None]) -> None:
    """Run the stream over what arrived since the last call, then stop."""
    query = (
        files.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def land_new_files(
    files: DataFrame,
    raw_root: str,
    execution_date: str,
    checkpoint: str,
    batch_id: str,
    ingested_at: str,
) -> None:
    """Land the bulk listings that arrived since the last call.

    A micro-batch may run twice after a failure; each one overwrites a folder of its own,
    named by checkpoint and number, so the second run replaces the first and no other.
    """
    root = raw_bulk(raw_root, execution_date)

    def write(rows: DataFrame, number: int) -> None:
        write_by_state(audit(rows, BULK_SOURCE, batch_id, ingested_at), f"{root}/{drop_name(checkpoint, number)}")

    _land(files, checkpoint, write)


def land_new_pages(
    pages: DataFrame,
    raw_root: str,
    execution_date: str,
    checkpoint: str,
    batch_id: str,
    ingested_at: str,
) -> None:
    """Land the API pages that arrived since the last call, as envelopes."""
    root = raw_api_listings(raw_root, execution_date)

    def write(rows: DataFrame, number: int) -> None:
        named = rows.withColumn("state", known_state(F.col("state")))
        landed = by_state(envelopes(named, execution_date, batch_id, ingested_at))
        write_envelopes(landed, f"{root}/{drop_name(checkpoint, number)}", "overwrite")

    _land(pages, checkpoint, write)
