"""Tables that keep the former versions of their rows (slowly changing, type 2).

A load brings each key's rows of the snapshot and its open version together in one shuffle,
which also gathers the partitions of the open versions, so nothing is joined or moved again.
Versions that changed are closed at the load's date and new ones opened; partitions without a
change are not rewritten, and a load without any leaves the table as it was.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from parcelstar.schemas import conform, literal_frame, struct
from parcelstar.session import write_through
from parcelstar.sources.generations import PART, Generations, part_of
from parcelstar.sources.paths import path_exists

_OPENED = struct(valid_from=DateType())
_CLOSED = struct(valid_from=DateType(), valid_to=DateType())


@dataclass(frozen=True)
class VersionedTable:
    """Versions of rows by key. `schema` has the keys and the attributes.

    A version is valid from valid_from up to, not including, valid_to, which is NULL while it
    is open. Open versions lie in `parts` partitions by the hash of their key; closed ones are
    only added, a folder per load.
    """

    spark: SparkSession
    root: str
    schema: StructType
    keys: list[str]
    parts: int = 64

    @property
    def _attributes(self) -> list[str]:
        return [n for n in self.schema.names if n not in self.keys]

    @property
    def _open(self) -> Generations:
        return Generations(
            self.spark, f"{self.root}/open", StructType([*self.schema.fields, *_OPENED.fields])
        )

    def _closed_path(self, generation: int) -> str:
        return f"{self.root}/closed/generation={generation}"

    def open_versions(self) -> DataFrame:
        return self._open.read().select(*self.schema.names, "valid_from")

    def history(self) -> DataFrame:
        """All versions, closed and open."""
        names = [*self.schema.names, "valid_from", "valid_to"]
        last = self._open.number()
        folders = [self._closed_path(n) for n in range(1, last + 1)]
        folders = [f for f in folders if path_exists(self.spark, f)]
        schema = StructType([*self.schema.fields, *_CLOSED.fields])
        if folders:
            closed = self.spark.read.schema(schema).parquet(*folders)
        else:
            closed = literal_frame(self.spark, [], schema)
        still = self.open_versions().withColumn("valid_to", F.lit(None).cast("date"))
        return closed.select(*names).unionByName(still.select(*names))

    def as_of(self, date: str) -> DataFrame:
        """The rows as they were on a date; files of loads up to then are skipped by valid_to."""
        day = F.lit(date).cast("date")
        valid = (F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (F.col("valid_to") > day))
        return self.history().where(valid).select(*self.schema.names)

    def _compared(self, rows: DataFrame, complete: bool) -> DataFrame:
        """Written table of a row per key: its partition, what a load makes of it and its versions.

        `_kind` is new, changed, gone or NULL; `_old` is the open version, `_new` the greatest row
        of the snapshot if a version begins. A partition's keys lie in few tasks.
        """
        full = reduce(Column.__and__, [F.col(k).isNotNull() for k in self.keys])
        attributes = F.struct(*self._attributes)
        version = F.struct(*self._attributes, "valid_from")
        old = self._open.read().select(*self.keys, version.alias("_old"))
        told = conform(rows, self.schema).where(full).select(*self.keys, attributes.alias("_new"))
        both = told.unionByName(old, allowMissingColumns=True)
        slots = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        share = F.pmod(F.xxhash64(F.lit(1), *self.keys), F.lit(-(-4 * slots // self.parts)))
        placed = both.withColumns({PART: part_of(self.keys, self.parts), "_share": share})
        # Grouped as it lies: the partition and its share follow from the key.
        single = placed.repartition(PART, "_share").groupBy(PART, "_share", *self.keys)
        met = single.agg(F.max("_new").alias("_new"), F.max("_old").alias("_old"))
        known = F.struct(*[F.col("_old")[a].alias(a) for a in self._attributes])
        kind = (
            F.when(F.col("_old").isNull(), "new")
            .when(F.col("_new").isNull(), "gone" if complete else None)
            .when(~F.col("_new").eqNullSafe(known), "changed")
        )
        begins = F.when(F.col("_kind").isin("new", "changed"), F.col("_new"))
        return write_through(
            met.withColumn("_kind", kind).select(PART, *self.keys, "_kind", begins.alias("_new"), "_old"), "compared"
        )

    def load(self, rows: DataFrame, date: str, complete: bool = True) -> dict:
        """Take in a snapshot of a date, and return how many versions opened and closed.

        `complete` means that the snapshot has all rows there are: versions of other keys are
        closed. Otherwise they stay open. Rows without a full key are left out. A load of the
        date of the last change replaces what that opened, without a version of no length; a
        load of an earlier date is refused. Repeating a load changes nothing.
        """
        opened = self._open
        day = F.lit(date).cast("date")
        late = opened.read().where(F.col("valid_from") > day).limit(1).count()
        if late:
            raise ValueError(f"versions later than {date} are open")
        compared = self._compared(rows, complete)
        figures = {
            (r["_kind"], r[PART]): r["n"]
            for r in compared.where(F.col("_kind").isNotNull())
            .groupBy("_kind", PART).agg(F.count(F.lit(1)).alias("n")).collect()
        }  # three rows per partition at most
        counts = {k: sum(n for (kind, _), n in figures.items() if kind == k) for k in ("new", "changed", "gone")}
        touched = {part for _, part in figures}
        if touched:
            ends = F.coalesce(F.col("_kind").isin("changed", "gone"), F.lit(False))
            over = compared.where(ends & (F.col("_old.valid_from") < day)).select(*self.keys, "_old.*")
            closed = over.withColumn("valid_to", day).select(*self.schema.names, *_CLOSED.names)
            # Closed first: both count from the commit of the open ones on.
            closed.write.mode("overwrite").parquet(self._closed_path(opened.number() + 1))
            starts = F.col("_new").withField("valid_from", day)
            stays = F.when(F.col("_kind").isNull(), F.col("_old"))
            rewritten = compared.where(F.col(PART).isin(sorted(touched)) & ~F.col("_kind").eqNullSafe("gone"))
            version = F.when(F.col("_new").isNotNull(), starts).otherwise(stays)
            opened.replace(
                rewritten.withColumn("_version", version).select(*self.keys, "_version.*", PART), touched, gathered=True
            )
        return {
            "opened": counts["new"] + counts["changed"],
            "closed": counts["changed"] + counts["gone"],
            "parts_rewritten": len(touched),
        }
