"""API feed: pages of listings and market documents, as JSON envelopes."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelstar.constants import API_ENDPOINT, API_SOURCE
from parcelstar.functions.text import known_state
from parcelstar.runs import new_batch_id, today, utc_now
from parcelstar.schemas import ENVELOPE, LISTING, MARKET, PAGE, literal_frame
from parcelstar.sources.paths import (
    NULL_FOLDER,
    STREAM_DROP,
    delete_folders,
    finished_folders,
    landed_paths,
    partition_values,
    path_exists,
    raw_api_listings,
)


def read_envelopes(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed envelopes, one JSON document a line; `multi_line` for pretty-printed files.

    Of a folder of drops only finished ones are read.
    """
    drops = landed_paths(spark, path)
    if not drops:
        return literal_frame(spark, [], ENVELOPE)
    reader = spark.read.schema(ENVELOPE).options(multiLine=multi_line, mode="FAILFAST")
    if drops != [path]:
        reader = reader.option("basePath", path)
    return reader.json(drops).select(*ENVELOPE.fieldNames())


def envelope_records(envelopes: DataFrame) -> DataFrame:
    """The listings of all envelopes."""
    return envelopes.select(F.explode("records").alias("r")).select("r.*")


def read_api_listings(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return envelope_records(read_envelopes(spark, path, multi_line))


def read_market(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Market documents; none when the folder is missing."""
    if not path_exists(spark, path):
        return literal_frame(spark, [], MARKET)
    return (
        spark.read.schema(MARKET).options(multiLine=multi_line, mode="FAILFAST").json(path)
    )


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages: state name, offset, total_count, records."""
    return spark.read.schema(PAGE).option("mode", "FAILFAST").json(path)


def envelopes(
    pages: DataFrame, execution_date: str, batch_id: str, ingested_at: str
) -> DataFrame:
    """One envelope per page, so a state of any size never sits in one row."""
    return pages.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(ingested_at).alias("ingested_at"),
        F.lit(API_SOURCE).alias("source"),
        F.lit(API_ENDPOINT).alias("endpoint"),
        "state",
        F.lit(execution_date).alias("execution_date"),
        "offset",
        "total_count",
        F.size("records").cast("bigint").alias("record_count"),
        F.col("records").cast(ENVELOPE["records"].dataType).alias("records"),
    )


def write_envelopes(df: DataFrame, path: str, mode: str, compression: str | None = None) -> None:
    """One folder per state; a large state is split over several tasks.

    As plain text the field names alone take more room than all values.
    """
    df.write.mode(mode).partitionBy("state_part").json(path, compression=compression)


def by_state(df: DataFrame) -> DataFrame:
    return df.withColumn("state_part", F.col("state")).hint("rebalance", "state_part")


def land_api_pages(
    pages: DataFrame,
    raw_root: str,
    execution_date: str | None = None,
    batch_id: str | None = None,
    ingested_at: str | None = None,
    known_states: bool = True,
    states: list[str] | None = None,
    gathered: bool = False,
    compression: str | None = None,
) -> dict:
    """Land the pages of the states that are not landed for this date yet.

    `states` are the requested ones: only these land, an empty list raises, and the summary
    tells which were skipped as landed before and which had no page. A page whose state is
    not a full state name fails the write, so nothing lands. Each landing has a folder of
    its own (`drop`), and states that a stream landed count as landed. A landing that broke off
    counts for nothing and is removed; that of a stream is left to its restart. The date is
    today's, the batch id a fresh one and the time now, unless given. Pages that lie `gathered`
    by state, as `ordering.pages` gives them, are written where they are. The files are plain
    text unless a `compression` is given, which readers need not be told.
    """
    if states is not None and not states:
        raise ValueError("no states requested")
    execution_date = execution_date or today()
    batch_id = batch_id or new_batch_id()
    ingested_at = ingested_at or utc_now().isoformat()
    spark = pages.sparkSession
    path = raw_api_listings(raw_root, execution_date)
    if known_states:
        pages = pages.withColumn("state", known_state(F.col("state")))
    done, broken = finished_folders(spark, path, "drop")
    delete_folders(spark, [f for f in broken if STREAM_DROP not in f])
    landed = {state for folder in done for state in partition_values(spark, folder, "state_part")}
    if states is not None:
        pages = pages.where(F.col("state").isin(states))
    # Pages without a state land in a folder too.
    folder = F.coalesce("state", F.lit(NULL_FOLDER))
    new = envelopes(
        pages.where(~folder.isin(sorted(landed))), execution_date, batch_id, ingested_at
    )
    seen = Observation()
    placed = new.withColumn("state_part", F.col("state")) if gathered else by_state(new)
    watched = placed.observe(
        seen,
        F.collect_set("state").alias("states"),
        F.sum("record_count").alias("records"),
    )
    write_envelopes(watched, f"{path}/drop={batch_id}-{uuid4().hex}", "errorifexists", compression)
    figures = seen.get
    requested = {
        "states_skipped": sorted(set(states) & landed),
        "states_absent": sorted(set(states) - landed - set(figures.get("states") or [])),
    } if states is not None else {}
    return {
        "batch_id": batch_id,
        "execution_date": execution_date,
        "ingested_at": ingested_at,
        "path": path,
        "states_processed": len(figures.get("states") or []),
        "records_count": figures.get("records") or 0,
        **requested,
    }


def shape_listing(df: DataFrame) -> DataFrame:
    """Listings with exactly the contract's fields, absent ones NULL."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in LISTING
        ]
    )
