"""Staging zone to warehouse: merge, remap, guard, audit, checks."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parcelstar import schemas
from parcelstar.constants import API_SOURCE, BULK_SOURCE
from parcelstar.operators.dimensions import new_locations
from parcelstar.operators.joins import (
    batch_guard,
    cross_bridge,
    fits_broadcast,
    location_bridge,
)
from parcelstar.operators.quality import (
    COVERED,
    merged_checks,
    partial_checks,
    partial_location_checks,
)
from parcelstar.runs import new_batch_id, today, utc_now
from parcelstar.session import write_through
from parcelstar.sources.paths import NULL_FOLDER, staged
from parcelstar.sources.staged import read_staged
from parcelstar.sources.warehouse import Warehouse

# Staged fact tables in load order: feed, staged table, its schema, warehouse id column.
FACT_LOADS = [
    (BULK_SOURCE, "fact_listings", schemas.STAGED_BULK_FACT, "listing_id"),
    (API_SOURCE, "fact_listings", schemas.STAGED_API_FACT, "listing_id"),
    (API_SOURCE, "fact_market_stats", schemas.STAGED_MARKET_STATS, "stat_id"),
]


def read_staged_locations(
    spark: SparkSession, staging_root: str, execution_date: str
) -> DataFrame:
    """Staged locations of both feeds, each with its feed."""
    feeds = [
        read_staged(
            spark, staged(staging_root, source, execution_date, "dim_location"),
            schemas.DIM_LOCATION,
        ).withColumn("source", F.lit(source))
        for source in (BULK_SOURCE, API_SOURCE)
    ]
    return feeds[0].unionByName(feeds[1])


def append_new_locations(warehouse: Warehouse, staged_locations: DataFrame) -> int:
    """Merge: add the staged locations the dimension lacks; returns how many."""
    # Written first: the append must not change what the rows are computed from.
    added = write_through(
        new_locations(staged_locations, warehouse.table("dim_location")), "new-locations"
    )
    count = added.count()
    if count:
        warehouse.append("dim_location", added)
    return count


def last_id(warehouse: Warehouse, table: str, id_column: str) -> int:
    """Highest generated id of a fact table.

    The load audit knows it. Only after a failed load, which may have written rows
    without an audit row, is the fact itself scanned.
    """
    done = (F.col("table_name") == table) & (F.col("status") == "SUCCESS")
    audit = (
        warehouse.table("pipeline_metadata")
        .agg(
            F.max(F.when(done, F.col("max_id"))).alias("top"),
            F.max(F.when(done, F.col("load_id"))).alias("done"),
            F.max(F.when(F.col("status") == "FAILED", F.col("load_id"))).alias("failed"),
        )
        .first()
    )
    top = audit["top"] or 0
    if (audit["failed"] or 0) > (audit["done"] or 0):
        scanned = warehouse.table(table).agg(F.max(id_column).alias("top")).first()["top"]
        top = max(top, scanned or 0)
    return top


def append_fact(
    warehouse: Warehouse,
    table: str,
    id_column: str,
    staged_fact: DataFrame,
    bridge: DataFrame,
    start: int,
    scope_by_source: bool = True,
    fits: bool | None = None,
) -> dict:
    """Append the staged rows of batches not loaded yet, with warehouse location ids.

    A batch counts as loaded once its audit says so; what an unfinished load left of it is
    removed first. Ids come after `start`, in steps of 2^33 from task to task, so a row is
    written once and a task that runs again gives it the same id. Rows whose location the
    bridge lacks are dropped and counted.
    """
    new = batch_guard(staged_fact, warehouse.loaded_batches(table))
    warehouse.discard_unfinished(table, new)
    seen, written = Observation(), Observation()
    located = cross_bridge(new, bridge, scope_by_source, seen, fits)
    rows = located.withColumn(id_column, F.monotonically_increasing_id() + (start + 1))
    warehouse.append(table, rows.observe(written, F.max(id_column).alias("top")))
    figures = seen.get
    return {
        "row_count": figures.get("kept") or 0,
        "dropped_rows": figures.get("dropped") or 0,
        "max_id": written.get.get("top") or start,
        "fact_batch_id": figures.get("batch_id"),
    }


def append_metadata(
    warehouse: Warehouse,
    batch_id: str,
    started: datetime,
    entries: list[dict],
    status: str = "SUCCESS",
) -> None:
    """One audit row per loaded table."""
    top = warehouse.table("pipeline_metadata").agg(F.max("load_id").alias("top")).first()["top"]
    ended = utc_now()
    rows = [
        {
            "load_id": (top or 0) + i,
            "batch_id": batch_id,
            "load_started_at": started,
            "load_ended_at": ended,
            "status": status,
            **entry,
        }
        for i, entry in enumerate(entries, start=1)
    ]
    names = schemas.PIPELINE_METADATA.names
    frame = schemas.literal_frame(
        warehouse.spark,
        [tuple(row.get(name) for name in names) for row in rows],
        schemas.PIPELINE_METADATA,
    )
    warehouse.append("pipeline_metadata", frame)


def checked_quality(warehouse: Warehouse, extended: bool = False) -> DataFrame:
    """The checks over the whole warehouse, from stored partial results.

    Only batches that have none yet are read, and locations added since; their partial results
    are stored. Rows of batches that no load has finished are counted each time anew.
    """
    dim, types = warehouse.table("dim_location"), warehouse.table("dim_property_type")
    top = dim.agg(F.max("location_id")).first()[0] or 0
    stored = warehouse.table("quality_partials")
    covered = stored.where(F.col("check_name") == COVERED)
    known = covered.groupBy("table_name", "batch_id").agg(F.max("top").alias("top")).collect()  # a row per batch
    new, passing = [], []
    for name in ("fact_listings", "fact_market_stats"):
        seen = {r["batch_id"] for r in known if r["table_name"] == name}
        done = {r["batch_id"] for r in warehouse.loaded_batches(name).collect()}
        folders = warehouse.batch_folders(name)
        fact = warehouse.table(name)
        for batches, into in (((folders & done) - seen, new), (folders - done - seen, passing)):
            if batches:
                own = F.coalesce("batch_id", F.lit(NULL_FOLDER)).isin(sorted(batches))
                into.append(partial_checks(name, fact.where(own), dim, types, top))
    after = max((r["top"] for r in known if r["table_name"] == "dim_location"), default=0)
    if top > after:
        new.append(partial_location_checks(dim, after, top))
    if new:
        warehouse.append("quality_partials", reduce(DataFrame.unionByName, new))
    partials = reduce(DataFrame.unionByName, passing, warehouse.table("quality_partials"))
    return merged_checks(partials, dim, extended)


def log_quality(warehouse: Warehouse, batch_id: str, extended: bool = False) -> list[dict]:
    """Check the warehouse and append the results to the log."""
    checks = checked_quality(warehouse, extended)
    results = [row.asDict() for row in checks.collect()]  # one row per check
    top = warehouse.table("data_quality_log").agg(F.max("check_id").alias("top")).first()["top"]
    now = utc_now()
    rows = [
        ((top or 0) + i, batch_id, r["name"], r["sql"], r["value"], r["passed"], now)
        for i, r in enumerate(results, start=1)
    ]
    frame = schemas.literal_frame(warehouse.spark, rows, schemas.DATA_QUALITY_LOG)
    warehouse.append("data_quality_log", frame)
    return [{k: r[k] for k in ("name", "value", "passed")} for r in results]


def load(
    spark: SparkSession,
    staging_root: str,
    warehouse_root: str,
    execution_date: str | None = None,
    scope_by_source: bool = True,
    extended_checks: bool = False,
) -> dict:
    """Load one date of the staging zone and return a summary.

    The dimension is written before the facts, and the facts before the audit. A failed
    check does not undo the load; see `assert_quality` for the gate. A failure leaves one
    FAILED audit row and is raised again.
    """
    execution_date = execution_date or today()
    warehouse = Warehouse(spark, warehouse_root)
    batch_id = new_batch_id()
    started = utc_now()
    try:
        locations = read_staged_locations(spark, staging_root, execution_date)
        added = append_new_locations(warehouse, locations)
        entries = [{"source": "all", "table_name": "dim_location", "row_count": added}]
        top_ids: dict[str, int] = {}
        # Every fact crosses it: written once.
        bridge = write_through(
            location_bridge(locations, warehouse.table("dim_location")), "bridge"
        )
        fits = fits_broadcast(bridge)
        for source, table, schema, id_column in FACT_LOADS:
            fact = read_staged(spark, staged(staging_root, source, execution_date, table), schema)
            if table not in top_ids:
                top_ids[table] = last_id(warehouse, table, id_column)
            figures = append_fact(
                warehouse, table, id_column, fact, bridge, top_ids[table], scope_by_source, fits
            )
            top_ids[table] = figures["max_id"]
            entries.append({"source": source, "table_name": table, **figures})
        append_metadata(warehouse, batch_id, started, entries)
        checks = log_quality(warehouse, batch_id, extended_checks)
    except Exception:
        failed = {"source": "all", "table_name": "pipeline", "row_count": 0}
        append_metadata(warehouse, batch_id, started, [failed], status="FAILED")
        raise
    loaded = {
        "dim_location": added,
        **{f"{e['table_name']}_{e['source']}": e["row_count"] for e in entries[1:3]},
        "fact_market_stats": entries[3]["row_count"],
    }
    return {
        "execution_date": execution_date,
        "batch_id": batch_id,
        "rows_loaded": loaded,
        "ingested_at": utc_now().isoformat(),
        "quality_checks_result": checks,
    }
