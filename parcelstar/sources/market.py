"""Market months landed by key: the latest statement on each zip code and month stays.

Documents arrive in any order, more than once and late. Each says something about many
months; a month of a zip code keeps the entry of the document updated last. That is the
greatest of all entries seen, so any order of files and any repetition give one state. Only
months in which an entry changed are rewritten.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from parcelstar.schemas import MARKET_STATISTICS
from parcelstar.session import write_through
from parcelstar.sources.generations import PART, Generations

MONTH = r"^\d{4}-\d{2}$"
_KEY = ["zip_code", "month"]
STATE = StructType(
    [
        StructField("zip_code", StringType()),
        StructField("month", StringType()),
        StructField("updated_at", TimestampType()),
        StructField("entry", MARKET_STATISTICS),
    ]
)


@dataclass(frozen=True)
class MarketMonths:
    """One writer at a time; a partition per month."""

    spark: SparkSession
    root: str

    @property
    def _table(self) -> Generations:
        return Generations(self.spark, self.root, STATE)

    def months(self) -> DataFrame:
        """zip_code, month, updated_at and the entry, a row per zip code and month."""
        return self._table.read()

    def land(self, documents: DataFrame) -> dict:
        """Take in documents; returns how many entries are new or changed, and the months of these.

        Entries without a zip code or with a key that is no month are left out. A document
        without a readable lastUpdatedDate is older than any other; of entries of one time the
        greatest stays.
        """
        updated = F.try_to_timestamp(
            F.col("saleData.lastUpdatedDate"), F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        )
        said = documents.select(
            F.col("zipCode").alias("zip_code"),
            updated.alias("updated_at"),
            F.explode("saleData.history").alias("month", "entry"),
        ).where(F.col("zip_code").isNotNull() & F.col("month").rlike(MONTH))
        new = write_through(_latest(said.select(*STATE.names)), "market-months")
        asked = {r[0] for r in new.select("month").distinct().collect()}  # months
        table = self._table
        old = table.read(asked)
        known = old.select(*_KEY, F.struct("updated_at", "entry").alias("_old"))
        # NULL times come first in the order of structs, as they should.
        changes = new.join(known, _KEY, "left").where(
            F.col("_old").isNull() | (F.struct("updated_at", "entry") > F.col("_old"))
        )
        changes = write_through(changes.select(*STATE.names), "market-changes")
        counts = {r["month"]: r["count"] for r in changes.groupBy("month").count().collect()}
        if counts:
            merged = _latest(table.read(set(counts)).unionByName(changes))
            table.replace(merged.withColumn(PART, F.col("month")), set(counts))
        return {"entries": sum(counts.values()), "months": sorted(counts)}


def _latest(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy(*_KEY)
        .agg(F.max(F.struct("updated_at", "entry")).alias("_row"))
        .select(*_KEY, "_row.*")
    )
