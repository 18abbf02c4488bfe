"""Completeness of landed pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstar.constants import PAGE_SIZE


def reconcile_pages(landed: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Per state: pages, records, expected total, missing pages, gaps and completeness.

    `landed` has state, offset, record_count and total_count, one row per landed page; a
    page landed twice counts once. Whether a page's predecessor landed is found by
    grouping pages with their successors' offsets, so no state is gathered in one task.
    """
    step = F.lit(page_size)
    slots = landed.select(
        "state",
        F.inline(
            F.array(
                F.struct(
                    F.col("offset").alias("offset"),
                    F.col("record_count").alias("record_count"),
                    F.col("total_count").alias("total_count"),
                    F.lit(False).alias("follows"),
                ),
                F.struct(
                    (F.col("offset") + step).alias("offset"),
                    F.lit(None).cast("bigint").alias("record_count"),
                    F.lit(None).cast("bigint").alias("total_count"),
                    F.lit(True).alias("follows"),
                ),
            )
        ),
    )
    pages = (
        slots.groupBy("state", "offset")
        .agg(
            F.max("record_count").alias("record_count"),
            F.max("total_count").alias("total_count"),
            F.max("follows").alias("follows"),
        )
        .where(F.col("record_count").isNotNull())
    )
    last = F.max_by("record_count", "offset")
    span = F.max("offset") / step + 1
    per_state = pages.groupBy("state").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("record_count").alias("records"),
        F.max("total_count").alias("expected_total"),
        (span.cast("bigint") - F.count(F.lit(1))).alias("missing_pages"),
        F.count_if((F.col("offset") > 0) & ~F.col("follows")).alias("gaps"),
        (last < step).alias("ended_short"),
    )
    whole = F.coalesce(F.col("records") >= F.col("expected_total"), F.col("ended_short"))
    return per_state.withColumn("complete", (F.col("missing_pages") == 0) & whole)


def landing_totals(landed: DataFrame) -> DataFrame:
    """States processed and records landed."""
    return landed.agg(
        F.count_distinct("state").alias("states_processed"),
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("records_count"),
    )
