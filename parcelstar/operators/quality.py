"""Data-quality checks and their gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from parcelstar.constants import LOCATION_KEY
from parcelstar.operators.joins import duplicate_keys
from parcelstar.schemas import FACT_LISTINGS, TEXT_LIMITS

# The names of the checks.
CHECK_SQL = {
    "null_price_fact_listings":
        "SELECT count_if(price IS NULL) FROM fact_listings",
    "orphan_fk_location_fact_listings":
        "SELECT count(*) FROM fact_listings f LEFT ANTI JOIN dim_location USING (location_id)",
    "orphan_fk_location_fact_market_stats":
        "SELECT count(*) FROM fact_market_stats f LEFT ANTI JOIN dim_location USING (location_id)",
    "null_location_fields_dim_location":
        "SELECT count_if(city IS NULL OR state IS NULL OR zip_code IS NULL) FROM dim_location",
    "orphan_fk_property_type_fact_listings":
        "SELECT count(*) FROM fact_listings f"
        " LEFT ANTI JOIN dim_property_type USING (property_type_id)",
    "duplicate_natural_key_dim_location":
        "SELECT count(*) FROM (SELECT 1 FROM dim_location"
        " GROUP BY city, state, zip_code HAVING count(*) > 1)",
    "state_code_dim_location":
        "SELECT count_if(length(state) <= 2) FROM dim_location",
    "text_too_long_fact_listings":
        "SELECT count(*) FROM fact_listings WHERE "
        + " OR ".join(
            f"length({f.name}) > {TEXT_LIMITS[f.name]}"
            for f in FACT_LISTINGS
            if f.name in TEXT_LIMITS
        ),
}


# The checks that always run; the others come with `extended`.
BASIC_CHECKS = list(CHECK_SQL)[:4]


def _stacked(row: DataFrame, names: list[str]) -> DataFrame:
    """One row of named counts to one row per count."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(n).alias("name"),
                F.coalesce(F.col(n), F.lit(0)).cast("bigint").alias("value"),
            )
            for n in names
        ]
    )
    return row.select(F.inline(pairs))


def _count_where(condition: Column) -> Column:
    return F.sum(F.when(condition, F.col("_rows")))


def text_too_long(df: DataFrame) -> Column:
    """Does any text column of a row exceed its declared length?"""
    tests = [
        F.length(f.name) > TEXT_LIMITS[f.name]
        for f in df.schema
        if isinstance(f.dataType, StringType) and f.name in TEXT_LIMITS
    ]
    return reduce(Column.__or__, [F.coalesce(t, F.lit(False)) for t in tests])


def quality_checks(
    fact_listings: DataFrame,
    fact_market_stats: DataFrame,
    dim_location: DataFrame,
    dim_property_type: DataFrame | None = None,
    batch_id: str | None = None,
    extended: bool = False,
    max_allowed: int = 0,
) -> DataFrame:
    """Each check's name, sql, value and whether it passed.

    Every fact table is read once: it is counted per foreign key first, and the counts,
    not the rows, meet the dimensions. Checks cover the whole tables unless `batch_id`
    narrows the facts. `extended` adds checks on property types, duplicate and short
    names and text lengths.
    """
    if batch_id is not None:
        fact_listings = fact_listings.where(F.col("batch_id") == batch_id)
        fact_market_stats = fact_market_stats.where(F.col("batch_id") == batch_id)

    known_location = dim_location.select("location_id", F.lit(True).alias("_location")).distinct()
    keys = ["location_id", "property_type_id"] if extended else ["location_id"]
    figures = {
        "_rows": F.count(F.lit(1)),
        "_no_price": F.count_if(F.col("price").isNull()),
    }
    if extended:
        figures["_too_long"] = F.count_if(text_too_long(fact_listings))
    listings = (
        fact_listings.groupBy(*keys)
        .agg(*[c.alias(n) for n, c in figures.items()])
        .join(known_location, "location_id", "left")
    )
    listing_values = {
        "null_price_fact_listings": F.sum("_no_price"),
        "orphan_fk_location_fact_listings": _count_where(F.col("_location").isNull()),
    }
    if extended:
        known_type = dim_property_type.select("property_type_id", F.lit(True).alias("_type"))
        listings = listings.join(F.broadcast(known_type), "property_type_id", "left")
        listing_values |= {
            "orphan_fk_property_type_fact_listings": _count_where(F.col("_type").isNull()),
            "text_too_long_fact_listings": F.sum("_too_long"),
        }

    market = (
        fact_market_stats.groupBy("location_id")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .join(known_location, "location_id", "left")
    )
    incomplete = reduce(Column.__or__, [F.col(c).isNull() for c in LOCATION_KEY])
    location_values = {"null_location_fields_dim_location": F.count_if(incomplete)}
    if extended:
        location_values["state_code_dim_location"] = F.count_if(F.length("state") <= 2)

    parts = [
        (listings, listing_values),
        (
            market,
            {"orphan_fk_location_fact_market_stats": _count_where(F.col("_location").isNull())},
        ),
        (dim_location, location_values),
    ]
    if extended:
        parts.append(
            (
                duplicate_keys(dim_location, LOCATION_KEY),
                {"duplicate_natural_key_dim_location": F.count(F.lit(1))},
            )
        )
    values = reduce(
        DataFrame.unionByName,
        [
            _stacked(frame.agg(*[c.alias(n) for n, c in named.items()]), list(named))
            for frame, named in parts
        ],
    )
    return _judged(values, max_allowed)


def _judged(values: DataFrame, max_allowed: int) -> DataFrame:
    sql = F.create_map(*[F.lit(x) for pair in CHECK_SQL.items() for x in pair])
    return values.select(
        "name",
        sql[F.col("name")].alias("sql"),
        "value",
        (F.col("value") <= max_allowed).alias("passed"),
    )


PARTIAL = ["table_name", "batch_id", "check_name", "key", "value", "top"]
#: Marks a batch as counted; its value is the batch's rows.
COVERED = "rows"


def _partial_rows(counted: DataFrame, table: str, entries: list[tuple[str, Column | None, Column]]) -> DataFrame:
    """Rows (batch, check, key, value) of groups that have been counted, summed."""
    listed = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                (F.lit(None) if key is None else key).cast("bigint").alias("key"),
                F.coalesce(value, F.lit(0)).cast("bigint").alias("value"),
            )
            for name, key, value in entries
        ]
    )
    rows = counted.select("batch_id", F.inline(listed))
    summed = rows.groupBy("batch_id", "check_name", "key").agg(F.sum("value").alias("value"))
    kept = summed.where((F.col("value") > 0) | (F.col("check_name") == COVERED))
    return kept.select(F.lit(table).alias("table_name"), "*")


def partial_checks(
    table: str, fact: DataFrame, dim_location: DataFrame, dim_property_type: DataFrame, top: int
) -> DataFrame:
    """What the checks of a fact table count, by batch: partial results that can be added up.

    Orphans are counted by their key. `top` is the last id of the dimension they were looked up
    in: as it only grows, an orphan's key up to `top` stays one.
    """
    known = dim_location.select("location_id", F.lit(True).alias("_location")).distinct()
    rows, lost = F.col("_rows"), F.col("_location").isNull()
    orphans = (f"orphan_fk_location_{table}", F.col("location_id"), F.when(lost, rows))
    if table == "fact_listings":
        counted = fact.groupBy("batch_id", "location_id", "property_type_id").agg(
            F.count(F.lit(1)).alias("_rows"),
            F.count_if(F.col("price").isNull()).alias("_no_price"),
            F.count_if(text_too_long(fact)).alias("_too_long"),
        )
        types = dim_property_type.select("property_type_id", F.lit(True).alias("_type"))
        counted = counted.join(known, "location_id", "left").join(F.broadcast(types), "property_type_id", "left")
        entries = [
            (COVERED, None, rows),
            ("null_price_fact_listings", None, F.col("_no_price")),
            orphans,
            ("orphan_fk_property_type_fact_listings", None, F.when(F.col("_type").isNull(), rows)),
            ("text_too_long_fact_listings", None, F.col("_too_long")),
        ]
    else:
        counted = fact.groupBy("batch_id", "location_id").agg(F.count(F.lit(1)).alias("_rows"))
        counted = counted.join(known, "location_id", "left")
        entries = [(COVERED, None, rows), orphans]
    return _partial_rows(counted, table, entries).withColumn("top", F.lit(top).cast("bigint")).select(*PARTIAL)


def partial_location_checks(dim_location: DataFrame, after: int, top: int) -> DataFrame:
    """What the checks of the dimension count among the locations after an id."""
    added = dim_location.where(F.col("location_id") > after).withColumn("batch_id", F.lit(None).cast("string"))
    incomplete = reduce(Column.__or__, [F.col(c).isNull() for c in LOCATION_KEY])
    counted = added.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(incomplete).alias("_incomplete"),
        F.count_if(F.length("state") <= 2).alias("_short"),
    )
    entries = [
        (COVERED, None, F.col("_rows")),
        ("null_location_fields_dim_location", None, F.col("_incomplete")),
        ("state_code_dim_location", None, F.col("_short")),
    ]
    rows = _partial_rows(counted, "dim_location", entries)
    return rows.withColumn("top", F.lit(top).cast("bigint")).select(*PARTIAL)


def merged_checks(
    partials: DataFrame, dim_location: DataFrame, extended: bool = False, max_allowed: int = 0
) -> DataFrame:
    """The checks' results from partial ones, as `quality_checks` gives them over whole tables.

    Only orphans whose key the dimension did not have room for are looked up again.
    """
    orphan = F.col("check_name").startswith("orphan_fk_location")
    open_ = orphan & (F.col("key") > F.col("top"))
    again = partials.where(open_).join(
        dim_location.select(F.col("location_id").alias("key")), "key", "left_anti"
    )
    counted = partials.where(~F.coalesce(open_, F.lit(False))).unionByName(again.select(*PARTIAL))
    if extended:
        twice = duplicate_keys(dim_location, LOCATION_KEY).agg(F.count(F.lit(1)).alias("value"))
        counted = counted.select("check_name", "value").unionByName(
            twice.select(F.lit("duplicate_natural_key_dim_location").alias("check_name"), "value")
        )
    names = list(CHECK_SQL) if extended else BASIC_CHECKS
    row = counted.agg(
        *[F.sum(F.when(F.col("check_name") == n, F.col("value"))).alias(n) for n in names]
    )
    return _judged(_stacked(row, names), max_allowed)


def assert_quality(checks: DataFrame) -> None:
    """Raise when a check failed, naming the failed ones."""
    failed = [row["name"] for row in checks.where(~F.col("passed")).select("name").collect()]
    if failed:
        raise ValueError(f"{len(failed)} quality check(s) failed: {sorted(failed)}")
