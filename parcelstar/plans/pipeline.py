"""The whole pipeline for one date."""

from __future__ import annotations

from pyspark.sql import SparkSession

from parcelstar.constants import API_SOURCE, BULK_SOURCE
from parcelstar.plans.load import load
from parcelstar.runs import new_batch_id, today, utc_now
from parcelstar.plans.transform import stage_api, stage_bulk
from parcelstar.sources.api import land_api_pages, read_pages
from parcelstar.sources.bulk import land_bulk


def gate(summary: dict) -> None:
    """Raise when the load's checks failed, naming them."""
    failed = [c["name"] for c in summary["quality_checks_result"] if not c["passed"]]
    if failed:
        raise ValueError(f"{len(failed)} quality check(s) failed: {failed}")


def run_pipeline(
    spark: SparkSession,
    csv_path: str,
    pages_path: str,
    raw_root: str,
    staging_root: str,
    warehouse_root: str,
    execution_date: str | None = None,
    zip_mode: str = "canonical",
    dedupe: bool = False,
    states: list[str] | None = None,
) -> dict:
    """Land both feeds, stage them, load them, then pass the quality gate.

    Batch ids follow from feed and date, so running a date again adds nothing.
    """
    execution_date = execution_date or today()
    now = utc_now().isoformat()
    bulk_batch = new_batch_id(BULK_SOURCE, execution_date)
    api_batch = new_batch_id(API_SOURCE, execution_date)
    land_bulk(spark, csv_path, raw_root, execution_date, bulk_batch, now)
    land_api_pages(
        read_pages(spark, pages_path), raw_root, execution_date, api_batch, now, states=states
    )
    stage_bulk(spark, raw_root, staging_root, execution_date, bulk_batch, zip_mode, dedupe)
    stage_api(spark, raw_root, staging_root, execution_date, api_batch, dedupe=dedupe)
    summary = load(spark, staging_root, warehouse_root, execution_date)
    gate(summary)
    return summary
