"""Schemas of the raw feeds, the staged files and the warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_STR, _DBL, _INT, _LONG, _DATE, _TS = (
    StringType(), DoubleType(), IntegerType(), LongType(), DateType(), TimestampType(),
)


def struct(**fields: DataType) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


# ---- raw feeds

BULK = struct(
    brokered_by=_DBL, status=_STR, price=_DBL, bed=_DBL, bath=_DBL, acre_lot=_DBL,
    street=_DBL, city=_STR, state=_STR, zip_code=_DBL, house_size=_DBL, prev_sold_date=_STR,
)

LISTING = struct(
    id=_STR, addressLine1=_STR, city=_STR, state=_STR, zipCode=_STR,
    latitude=_DBL, longitude=_DBL, propertyType=_STR, price=_DBL, status=_STR,
    bedrooms=_DBL, bathrooms=_DBL, squareFootage=_DBL, lotSize=_DBL,
    daysOnMarket=_INT, listedDate=_STR,
)

ENVELOPE = struct(
    batch_id=_STR, ingested_at=_STR, source=_STR, endpoint=_STR, state=_STR,
    execution_date=_STR, offset=_LONG, total_count=_LONG, record_count=_LONG,
    records=ArrayType(LISTING),
)

PAGE = StructType([ENVELOPE[c] for c in ("state", "offset", "total_count", "records")])

MARKET_ENTRY = struct(
    date=_STR, medianPrice=_DBL, medianPricePerSquareFoot=_DBL, medianDaysOnMarket=_DBL,
    totalListings=_INT, newListings=_INT,
)

MARKET = struct(zipCode=_STR, saleData=struct(history=MapType(_STR, MARKET_ENTRY)))

# Market documents with their breakdowns, and property records.

MARKET_STATISTICS = struct(
    averagePrice=_DBL, medianPrice=_DBL, minPrice=_DBL, maxPrice=_DBL, averageDaysOnMarket=_DBL,
    newListings=_INT, totalListings=_INT,
)

FULL_MARKET = struct(
    zipCode=_STR,
    saleData=StructType(
        [
            StructField("lastUpdatedDate", _STR),
            *MARKET_STATISTICS.fields,
            *struct(
                dataByPropertyType=ArrayType(
                    StructType([StructField("propertyType", _STR), *MARKET_STATISTICS.fields])
                ),
                dataByBedrooms=ArrayType(
                    StructType([StructField("bedrooms", _INT), *MARKET_STATISTICS.fields])
                ),
                history=MapType(_STR, MARKET_STATISTICS),
            ).fields,
        ]
    ),
)

PROPERTY = struct(
    id=_STR, addressLine1=_STR, city=_STR, state=_STR, zipCode=_STR, county=_STR,
    latitude=_DBL, longitude=_DBL, propertyType=_STR, bedrooms=_DBL, bathrooms=_DBL,
    squareFootage=_DBL, lotSize=_DBL, yearBuilt=_INT, lastSaleDate=_STR, lastSalePrice=_DBL,
    hoa=struct(fee=_DBL),
    features=struct(cooling=BooleanType(), garage=BooleanType(), pool=BooleanType()),
    taxAssessments=MapType(_STR, struct(value=_DBL, land=_DBL, improvements=_DBL)),
    propertyTaxes=MapType(_STR, struct(total=_DBL)),
    history=MapType(_STR, struct(event=_STR, date=_STR, price=_DBL)),
    ownerOccupied=BooleanType(),
)

# ---- dimensions

DIM_LOCATION = struct(location_id=_LONG, city=_STR, state=_STR, zip_code=_STR)

DIM_PROPERTY_TYPE = struct(property_type_id=_LONG, property_type=_STR)

# ---- staged facts

STAGED_BULK_FACT = struct(
    location_id=_LONG, property_type_id=_LONG, status=_STR, price=_DBL, bed=_DBL, bath=_DBL,
    acre_lot=_DBL, house_size=_DBL, prev_sold_date=_DATE, brokered_by=_STR,
    source=_STR, batch_id=_STR, ingested_at=_TS,
)

STAGED_API_FACT = struct(
    location_id=_LONG, property_type_id=_LONG, rentcast_id=_STR, address=_STR, price=_DBL,
    status=_STR, bedrooms=_DBL, bathrooms=_DBL, square_footage=_DBL, lot_size=_DBL,
    latitude=_DBL, longitude=_DBL, days_on_market=_INT, listed_date=_DATE,
    source=_STR, batch_id=_STR, ingested_at=_TS,
)

STAGED_MARKET_STATS = struct(
    location_id=_LONG, snapshot_date=_DATE, median_listing_price=_DBL,
    median_price_per_sqft=_DBL, median_days_on_market=_DBL, total_listings=_INT,
    new_listings=_INT, source=_STR, batch_id=_STR, ingested_at=_TS,
)

# ---- warehouse tables

FACT_LISTINGS = struct(
    listing_id=_LONG, location_id=_LONG, property_type_id=_LONG,
    price=_DBL, status=_STR, source=_STR, batch_id=_STR, ingested_at=_TS,
    bed=_DBL, bath=_DBL, acre_lot=_DBL, house_size=_DBL, prev_sold_date=_DATE, brokered_by=_STR,
    rentcast_id=_STR, address=_STR, bedrooms=_DBL, bathrooms=_DBL, square_footage=_DBL,
    lot_size=_DBL, latitude=_DBL, longitude=_DBL, days_on_market=_INT, listed_date=_DATE,
)

FACT_MARKET_STATS = struct(
    stat_id=_LONG, location_id=_LONG, snapshot_date=_DATE, median_listing_price=_DBL,
    median_price_per_sqft=_DBL, median_days_on_market=_DBL, total_listings=_INT,
    new_listings=_INT, source=_STR, batch_id=_STR, ingested_at=_TS,
)

# `fact_batch_id`, `dropped_rows` and `max_id` extend the load audit: which batch the rows
# came from, how many staged rows had no location, and the highest generated id.
PIPELINE_METADATA = struct(
    load_id=_LONG, batch_id=_STR, source=_STR, table_name=_STR, row_count=_LONG,
    load_started_at=_TS, load_ended_at=_TS, status=_STR,
    fact_batch_id=_STR, dropped_rows=_LONG, max_id=_LONG,
)

DATA_QUALITY_LOG = struct(
    check_id=_LONG, batch_id=_STR, check_name=_STR, check_sql=_STR, result_value=_LONG,
    passed=BooleanType(), checked_at=_TS,
)

# What the checks counted, by batch; see `operators.quality.partial_checks`.
QUALITY_PARTIALS = struct(
    table_name=_STR, batch_id=_STR, check_name=_STR, key=_LONG, value=_LONG, top=_LONG,
)

# Longest text each warehouse column may hold.
TEXT_LIMITS = {
    "city": 100, "state": 50, "zip_code": 10, "property_type": 50,
    "status": 50, "source": 20, "batch_id": 100, "brokered_by": 200,
    "rentcast_id": 100, "address": 200,
}


def literal_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few given rows as a frame Catalyst sees as a local table; also for no rows."""
    if not rows:
        nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return spark.range(0, 0, 1, 1).select(*nothing)
    entries = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema)])
        for row in rows
    ]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*entries)))


def number_text(c: Column) -> Column:
    """A double as text; whole numbers without the fraction (7.0 -> '7')."""
    whole = c.try_cast("bigint")
    return F.when(whole.cast("double") == c, whole.cast("string")).otherwise(c.cast("string"))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select `schema`'s columns by case-insensitive name, cast to its types.

    Columns the frame lacks become NULL, columns the schema lacks are dropped.
    """
    present = {name.lower(): name for name in df.columns}

    def column(field: StructField) -> Column:
        name = present.get(field.name.lower())
        if name is None:
            value = F.lit(None).cast(field.dataType)
        elif df.schema[name].dataType == _DBL and field.dataType == _STR:
            value = number_text(F.col(f"`{name}`"))
        else:
            value = F.col(f"`{name}`").cast(field.dataType)
        return value.alias(field.name)

    return df.select([column(field) for field in schema])
