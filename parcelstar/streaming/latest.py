"""The latest market snapshot of each zip code, kept up to date by a stream.

Each task reduces what it reads to one row per zip code; a state per zip code then passes on
only rows that are later than the last one. What it passes on is merged into a table by the
same order, so a micro-batch that runs again, or a row that comes after its state has expired,
changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from parcelstar.schemas import DIM_LOCATION, FACT_MARKET_STATS
from parcelstar.session import write_through
from parcelstar.sources.generations import PART, Generations, part_of

#: What decides between two snapshots of a zip code, in this order; NULL is earliest.
ORDER = ["snapshot_date", "ingested_at", "stat_id", "location_id"]
SNAPSHOT = StructType(
    [
        *[DIM_LOCATION[c] for c in ("zip_code", "state", "city")],
        *[f for f in FACT_MARKET_STATS if f.name not in ("source", "batch_id")],
    ]
)
_STATE = StructType([FACT_MARKET_STATS[c] for c in ORDER])


def _rank(values: tuple) -> tuple:
    """Sorts as the order says, whatever is missing."""
    return tuple((not pd.isna(v), 0 if pd.isna(v) else v) for v in values)


def latest_of(frame: pd.DataFrame) -> pd.DataFrame:
    """The latest row of each zip code of a frame."""
    ordered = frame.sort_values(ORDER, na_position="first", kind="stable")
    return ordered.drop_duplicates("zip_code", keep="last")


def _partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield latest_of(frame)


def stream_snapshots(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Stream of the Parquet files of located market rows that arrive in a folder."""
    reader = spark.readStream.schema(SNAPSHOT)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def improvements(snapshots: DataFrame, expire_ms: int | None = None) -> DataFrame:
    """Rows later than any seen for their zip code.

    With `expire_ms` a zip code that had no rows for so long is forgotten; the stream then runs
    batches without rows, too, and does not end by itself.
    """

    def improve(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        before = _rank(state.get) if state.exists else None
        best = None
        for frame in frames:
            last = latest_of(frame)
            if best is None or _rank(tuple(last[ORDER].iloc[0])) > _rank(tuple(best[ORDER].iloc[0])):
                best = last
        values = tuple(best[ORDER].iloc[0])
        if before is None or _rank(values) > before:
            plain = [None if pd.isna(v) else v for v in values]
            state.update(tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in plain))
            yield best
        if expire_ms is not None:
            state.setTimeoutDuration(expire_ms)

    rows = snapshots.where(F.col("zip_code").isNotNull()).mapInPandas(_partial, SNAPSHOT)
    timeout = GroupStateTimeout.NoTimeout if expire_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return rows.groupBy("zip_code").applyInPandasWithState(improve, SNAPSHOT, _STATE, "append", timeout)


class LatestSnapshots:
    """The table of latest snapshots, partitioned by the hash of the zip code."""

    def __init__(self, spark: SparkSession, root: str, parts: int = 16) -> None:
        self.parts = parts
        self._table = Generations(spark, root, SNAPSHOT)

    def read(self) -> DataFrame:
        return self._table.read()

    def merge(self, rows: DataFrame) -> None:
        """Take in rows; the latest of each zip code stays, in any order of calls."""
        part = part_of(["zip_code"], self.parts)
        touched = {r[0] for r in rows.select(part).distinct().collect()}  # at most `parts`
        if not touched:
            return
        every = self._table.read(touched).unionByName(rows.select(*SNAPSHOT.names))
        rank = F.struct(*ORDER)  # NULLs are least
        one = every.groupBy("zip_code").agg(F.max_by(F.struct(*SNAPSHOT.names), rank).alias("_row"))
        kept = one.select("_row.*").withColumn(PART, part)
        self._table.replace(kept, touched)


def _into(table: LatestSnapshots, rows: DataFrame, checkpoint: str) -> DataStreamWriter:
    def merge(batch: DataFrame, number: int) -> None:
        # Written first: the state is worked out once.
        table.merge(write_through(batch, "latest"))

    return (
        rows.writeStream.foreachBatch(merge)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )


def keep_latest(snapshots: DataFrame, table: LatestSnapshots, checkpoint: str) -> None:
    """Run the stream over what arrived since the last call, then stop."""
    writer = _into(table, improvements(snapshots), checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


def start_latest(
    snapshots: DataFrame,
    table: LatestSnapshots,
    checkpoint: str,
    expire_ms: int = 30 * 86_400_000,
    every: str = "1 minute",
) -> StreamingQuery:
    """Start the stream; it runs until it is stopped, and forgets zip codes unseen for long.

    A checkpoint belongs to one of the two ways to run.
    """
    writer = _into(table, improvements(snapshots, expire_ms), checkpoint)
    return writer.trigger(processingTime=every).start()
