"""Parquet tables whose partitions are replaced as a whole, without a moment of half a table.

A write puts the partitions it touches into a folder of its own, a generation, and then commits
by writing the map of all partitions to the generation that holds them. Readers follow the
last committed map; what a broken write left is not in it and the next one overwrites it.
Partitions that a write does not touch stay where they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from parcelstar.schemas import conform, literal_frame, struct
from parcelstar.sources.paths import finished_folders, partition_values

#: Column of the partition a row belongs to, as text, in the rows given to `replace`.
PART = "_part"
_MAP = struct(part=StringType(), generation=LongType())


@dataclass(frozen=True)
class Generations:
    """One writer at a time."""

    spark: SparkSession
    root: str
    schema: StructType

    def number(self) -> int:
        """The last committed generation; 0 before the first."""
        done, _ = finished_folders(self.spark, f"{self.root}/map", "generation")
        return max((int(folder.rsplit("=", 1)[1]) for folder in done), default=0)

    def holders(self) -> dict[str, int]:
        """For each partition that has rows the generation that holds it: a row per partition."""
        number = self.number()
        if not number:
            return {}
        rows = self.spark.read.schema(_MAP).parquet(f"{self.root}/map/generation={number}").collect()
        return {r["part"]: r["generation"] for r in rows}

    def _folder(self, part: str, generation: int) -> str:
        # As the writer names it; parts are plain words and numbers.
        return f"{self.root}/data/generation={generation}/{PART}={part}"

    def read(self, parts: set[str] | None = None) -> DataFrame:
        """The rows of all partitions, or of these only; no other folder is read."""
        folders = [
            self._folder(part, generation)
            for part, generation in sorted(self.holders().items())
            if parts is None or part in parts
        ]
        if not folders:
            return literal_frame(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders).select(*self.schema.names)

    def replace(self, rows: DataFrame, touched: set[str], gathered: bool = False) -> int:
        """Put `rows`, with their partition in `_part`, in the place of the touched partitions.

        A touched partition without rows is empty from then on. Rows of other partitions are an
        error of the caller. `gathered` rows lie with those of their partition and stay there.
        """
        holders = self.holders()
        number = self.number() + 1
        data = f"{self.root}/data/generation={number}"
        shaped = conform(rows, StructType([*self.schema.fields, *struct(**{PART: StringType()}).fields]))
        # A large partition is split over several tasks.
        placed = shaped if gathered else shaped.hint("rebalance", PART)
        placed.write.mode("overwrite").partitionBy(PART).parquet(data)
        written = set(partition_values(self.spark, data, PART))
        held = {p: g for p, g in holders.items() if p not in touched} | dict.fromkeys(written, number)
        table = literal_frame(self.spark, sorted(held.items()), _MAP)
        table.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/map/generation={number}")
        return number


def part_of(keys: list[str], parts: int) -> Column:
    """The partition of a key: one of so many, by its hash."""
    return F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("string")
