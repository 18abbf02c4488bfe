"""Positions in a global order without gathering the rows in one task.

The rows are range-sorted into runs and written once; a row's position is its place in
its run plus the rows of the runs before it. Only one count per run (and group) is
handled apart from the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelstar.operators.joins import fits_broadcast
from parcelstar.session import write_through

RUN, PLACE = "_run", "_place"
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def sorted_runs(df: DataFrame, order: list[str]) -> DataFrame:
    """`df` with the number of its sorted run and its place, from 0, in that run."""
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    return write_through(
        numbered.select(
            *df.columns,
            F.shiftright("_id", _ROW_BITS).cast("int").alias(RUN),
            F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(PLACE),
        ),
        "runs",
        compression="zstd",
    )


def rows_before(heads: DataFrame, groups: list[str], amount: str) -> Column:
    """Total of `amount` in the earlier runs of the same group, over one row per run."""
    window = (
        Window.partitionBy(*groups or [F.lit(0)])
        .orderBy(RUN)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return F.coalesce(F.sum(heads[amount]).over(window), F.lit(0))


def join_heads(runs: DataFrame, heads: DataFrame, groups: list[str]) -> DataFrame:
    """Attach the per-run (and group) figures to the rows; NULL groups match.

    There is a head per run and per change of group. Measured few, they are broadcast and
    the rows stay where they are; otherwise no key holds more rows than a run.
    """
    keys = [RUN, *groups]
    renamed = write_through(
        heads.withColumnsRenamed({k: f"_head{k}" for k in keys}), "heads"
    )
    if fits_broadcast(renamed):
        renamed = F.broadcast(renamed)
    match = reduce(
        Column.__and__, [F.col(k).eqNullSafe(F.col(f"_head{k}")) for k in keys]
    )
    return runs.join(renamed, match).drop(*[f"_head{k}" for k in keys])


def dense_keys(df: DataFrame, order: list[str], key: str, start: int = 1) -> DataFrame:
    """Number the rows start, start+1, ... in sort order (NULLs first).

    `order` must tell all rows apart for the numbering to be repeatable.
    """
    runs = sorted_runs(df, order)
    heads = runs.groupBy(RUN).agg(F.count(F.lit(1)).alias("_rows"))
    heads = heads.select(RUN, rows_before(heads, [], "_rows").alias("_before"))
    # One row per run: at most spark.sql.shuffle.partitions rows.
    return runs.join(F.broadcast(heads), RUN).select(
        (F.col("_before") + F.col(PLACE) + start).alias(key), *df.columns
    )


def numbered(df: DataFrame, key: str, start: int = 1) -> DataFrame:
    """Number the rows start, start+1, ... in any order, without a shuffle.

    The rows are written once with their place in their task; the numbers follow from the
    rows of the tasks before.
    """
    rows = write_through(
        df.withColumn("_id", F.monotonically_increasing_id()).select(
            *df.columns,
            F.shiftright("_id", _ROW_BITS).cast("int").alias(RUN),
            F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias(PLACE),
        ),
        "numbered",
    )
    heads = rows.groupBy(RUN).agg(F.count(F.lit(1)).alias("_rows"))
    heads = heads.select(RUN, rows_before(heads, [], "_rows").alias("_before"))
    # One row per task.
    return rows.join(F.broadcast(heads), RUN).select(
        (F.col("_before") + F.col(PLACE) + start).alias(key), *df.columns
    )


def group_positions(
    df: DataFrame, groups: list[str], order: list[str], name: str = "position"
) -> DataFrame:
    """Place of each row, from 0, in its group's sort order.

    A hot group spreads over as many runs as its size asks for.
    """
    runs = sorted_runs(df, [*groups, *order])
    heads = runs.groupBy(RUN, *groups).agg(
        F.min(PLACE).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    heads = heads.select(
        RUN, *groups, "_first", rows_before(heads, groups, "_rows").alias("_before")
    )
    return join_heads(runs, heads, groups).select(
        *df.columns, (F.col(PLACE) - F.col("_first") + F.col("_before")).alias(name)
    )


def pages(
    df: DataFrame, groups: list[str], order: list[str], size: int, records: str = "records"
) -> DataFrame:
    """Cut each group into pages of at most `size` rows, one array per page.

    Gives the groups, `offset` (place of the page's first row) and the array of the
    remaining columns in order. A task has pages of few groups, a large group's lie in many.
    """
    rest = [c for c in df.columns if c not in groups]
    placed = group_positions(df, groups, order, "_at")
    page = (F.floor(F.col("_at") / size) * size).alias("offset")
    slots = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.pmod(F.floor(F.col("_at") / size), F.lit(slots)).alias("_share")
    # Grouped as it lies: no later shuffle has to gather the groups.
    spread = placed.select("*", page, share).repartition(*groups, "_share")
    listed = F.array_sort(F.collect_list(F.struct("_at", F.struct(*rest).alias("row"))))
    return spread.groupBy(*groups, "_share", "offset").agg(
        F.transform(listed, lambda item: item["row"]).alias(records)
    ).drop("_share")
