"""Joins of a large table with a lookup, key remapping and guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    MapType,
    StringType,
    StructField,
    StructType,
)

from parcelstar.constants import LOCATION_KEY
from parcelstar.session import write_through

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 << 20


def fits_broadcast(
    lookup: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> bool:
    """Measure a lookup, columns of every type: is it few rows and few bytes?"""
    widths = [_width(field) for field in lookup.schema]
    varying = reduce(Column.__add__, [w for w in widths if not isinstance(w, int)], F.lit(0))
    size = lookup.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(varying.cast("bigint")), F.lit(0)).alias("bytes"),
    ).first()
    fixed = sum(w for w in widths if isinstance(w, int))
    return size["rows"] <= max_rows and size["bytes"] + size["rows"] * fixed <= max_bytes


def _width(field: StructField) -> int | Column:
    """Bytes of a value: fixed, or the length of texts, and of nested values as JSON."""
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(field.dataType, (StructType, ArrayType, MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return 8


def hot_keys(large: DataFrame, on: list[str], slots: int) -> DataFrame:
    """Written table of the keys with more rows than a mean partition, and their salts.

    A key of n mean partitions gets 2 n salts, rounded up, so that two that meet by chance do
    not make a large partition. There are fewer such keys than partitions.
    """
    counts = write_through(
        large.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")), "key-counts"
    )
    share = max(1.0, (counts.agg(F.sum("_rows")).first()[0] or 0) / slots)
    hot = counts.where(F.col("_rows") > share)
    salts = F.least(F.ceil(2 * F.col("_rows") / share), F.lit(slots)).cast("int")
    return write_through(hot.select(*on, salts.alias("_salts")), "hot-keys")


def salted_join(large: DataFrame, lookup: DataFrame, on: list[str], how: str) -> DataFrame:
    """Shuffle join in which a hot key spreads over as many tasks as its rows ask for.

    The adaptive plan splits skewed partitions of two plain sides by itself; this join is
    for lookups whose output goes on to be grouped or written, where it does not.
    Only the lookup's rows of hot keys are copied, once per salt. Rows with a NULL key
    match nothing and are spread too. The salt depends on the row and its input partition
    only, so a task that runs again sends each row to the same place.
    """
    slots = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(large, on, slots))  # fewer rows than partitions
    no_key = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    draw = F.xxhash64(*large.columns) + F.spark_partition_id()
    salts = F.when(no_key, F.lit(slots)).otherwise(F.coalesce("_salts", F.lit(1)))
    salted = large.join(hot, on, "left").withColumn("_salt", F.pmod(draw, salts).cast("int"))
    every = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    copies = lookup.join(hot, on, "left").withColumn("_salt", F.explode(every))
    return (
        salted.drop("_salts").join(copies.drop("_salts"), [*on, "_salt"], how).drop("_salt")
    )


def lookup_join(
    large: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    fits: bool | None = None,
) -> DataFrame:
    """Join a large table with a lookup on equal columns (inner, left, semi or anti).

    A lookup of measured small size is broadcast, so the large side is not shuffled
    and hot keys do not matter; a larger one goes through the salted join. `fits` is the
    answer for a lookup that has been measured before.
    """
    if fits_broadcast(lookup, max_rows) if fits is None else fits:
        return large.join(F.broadcast(lookup), on, how)
    return salted_join(large, lookup, on, how)


def batch_guard(new: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of `new` whose batch_id is not in `existing` yet; a NULL batch passes.

    There are far fewer batches than rows, so the plan is left to Catalyst.
    """
    return new.join(existing.select("batch_id").distinct(), "batch_id", "left_anti")


def location_bridge(staged_locations: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Which warehouse location each feed's staged location_id stands for."""
    return staged_locations.join(
        dim_location.withColumnRenamed("location_id", "_warehouse_id"), LOCATION_KEY
    ).select("source", "location_id", "_warehouse_id")


def cross_bridge(
    fact: DataFrame,
    bridge: DataFrame,
    scope_by_source: bool = True,
    seen: Observation | None = None,
    fits: bool | None = None,
) -> DataFrame:
    """Replace a staged location_id by the warehouse one.

    Both feeds number their locations from 1, so the staged id is only unique together
    with `source`. `scope_by_source=False` matches on the id alone, which repeats a fact
    for every feed that uses its id. Facts without a location in the bridge are dropped;
    `seen` observes how many were kept and dropped, and a batch id; `fits` tells whether
    the bridge may be broadcast, if that has been measured.
    """
    key = ["source", "location_id"] if scope_by_source else ["location_id"]
    joined = lookup_join(fact, bridge.select(*key, "_warehouse_id"), key, "left", fits=fits)
    located = F.col("_warehouse_id").isNotNull()
    if seen is not None:
        joined = joined.observe(
            seen,
            F.count_if(located).alias("kept"),
            F.count_if(~located).alias("dropped"),
            F.max("batch_id").alias("batch_id"),
        )
    joined = joined.where(located)
    return joined.withColumn("location_id", F.col("_warehouse_id")).select(fact.columns)


def remap_location(
    fact: DataFrame,
    staged_locations: DataFrame,
    dim_location: DataFrame,
    scope_by_source: bool = True,
) -> DataFrame:
    """Give a staged fact the warehouse's location ids, found by natural key."""
    return cross_bridge(fact, location_bridge(staged_locations, dim_location), scope_by_source)


def orphans(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Fact rows per key value that the dimension lacks, NULL keys included."""
    counts = fact.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.join(dim.select(key), key, "left_anti")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where(F.col("row_count") > 1)
    )
