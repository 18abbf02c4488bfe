"""Sharding by sampled splitters, law `bytes`: shards of nearly equal size.

Records are ordered by the hash of their text, so equal texts lie side by side. A
size-weighted sample of the keys gives quantile splitters, which cut the keys into many
ranges of about equal bytes. Every range is then measured over all records. A range above
twice its share is subdivided: a key that fills a share alone becomes a range of its own,
and what is left is cut evenly. A key larger than a shard, a text with very many copies, is
also cut by document id. Whole ranges go to the shard with the least bytes so far, largest
first, which keeps a text's copies together and the shards within one range of each other.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelstar.operators.ordering import group_positions
from parcelstar.session import write_through

SHARDS = 16
#: Ranges per shard, and draws of the sample per range: the driver holds that many numbers.
RANGES, DRAWS = 64, 16
PIECES = 1 << 20
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def _ranges(splitters: list[int], heavy: dict[int, int]):
    """Column function (key, id hash) -> number of the range, pieces of heavy keys apart.

    Range i holds the keys from splitter i - 1 up to below splitter i. Each heavy key is a
    range by itself and its pieces are numbered on from PIECES * (range + 1).
    """
    bounds = np.array(splitters, dtype=np.int64)
    keys = np.array(sorted(heavy), dtype=np.int64)
    pieces = np.array([heavy[k] for k in sorted(heavy)], dtype=np.int64)

    @F.pandas_udf("long")
    def number(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for key, ident in batches:
            values = key.to_numpy()
            at = np.searchsorted(bounds, values, side="right").astype(np.int64)
            if len(keys):
                place = np.minimum(np.searchsorted(keys, values), len(keys) - 1)
                own = keys[place] == values
                piece = ident.to_numpy().astype(np.uint64) % pieces[place].astype(np.uint64)
                at = np.where(own, PIECES * (place + 1) + piece.astype(np.int64), at)
            yield pd.Series(at)

    return number


def _sample(records: DataFrame, total: int, draws: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys drawn in proportion to size, sorted, with the bytes each stands for.

    Whether a record is drawn follows from its hash, so a repeated task draws the same. At
    most about 2 * draws records come to the driver.
    """
    step = max(1.0, total / draws)
    chance = F.pmod(F.xxhash64("key", "ident", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    rows = (
        records.where(chance * step < F.col("size"))
        .select("key", F.greatest(F.col("size").cast("double"), F.lit(step)).alias("weight"))
        .toPandas()
        .sort_values("key")
    )
    return rows["key"].to_numpy(), rows["weight"].to_numpy()


def _quantiles(keys: np.ndarray, weights: np.ndarray, ranges: int) -> list[int]:
    if not len(keys):
        return []
    passed = np.cumsum(weights)
    wanted = passed[-1] * np.arange(1, ranges) / ranges
    return sorted({int(k) for k in keys[np.minimum(np.searchsorted(passed, wanted), len(keys) - 1)]})


def _subdivided(
    records: DataFrame, splitters: list[int], share: float, shard: float
) -> tuple[list[int], dict[int, int]]:
    """Splitters and heavy keys (with their pieces) after overfull ranges were cut."""
    # Keys that fill a share: no more than there are shares.
    heavy = {
        r["key"]: max(1, math.ceil(r["bytes"] / share)) if r["bytes"] > shard else 1
        for r in records.groupBy("key")
        .agg(F.sum("size").alias("bytes"))
        .where(F.col("bytes") > share)
        .collect()
    }
    number = _ranges(splitters, heavy)
    sizes = (
        records.groupBy(number("key", "ident").alias("range"))
        .agg(F.sum("size").alias("bytes"))
        .where((F.col("range") < PIECES) & (F.col("bytes") > 2 * share))
        .collect()
    )
    bounds = [LOW, *splitters, HIGH]
    more = []
    for r in sizes:
        low, high = bounds[r["range"]], bounds[r["range"] + 1]
        parts = math.ceil(r["bytes"] / share)
        more += [low + (high - low) * i // parts for i in range(1, parts)]
    return sorted({*splitters, *more}), heavy


def assign_shards(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """Ranges to shards: largest first, each to the shard with the least bytes."""
    loads = [(0, s) for s in range(shards)]
    assigned = {}
    for number in sorted(sizes, key=lambda n: (-sizes[n], n)):
        load, shard = heapq.heappop(loads)
        assigned[number] = shard
        heapq.heappush(loads, (load + sizes[number], shard))
    return assigned


def text_size(text: Column) -> Column:
    """UTF-8 bytes plus 1; a null text has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def shard_numbers(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """A row per document row: doc_id, size, text_crc32, key, shard.

    Null and empty texts have size 1 and lie together, as all equal texts do. Rows without
    id and repeated rows are sharded one by one. An empty table has no rows.
    """
    records = write_through(
        documents.select(
            "doc_id",
            text_size(F.col("text")).alias("size"),
            F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
            F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("key"),
            F.abs(F.shiftright(F.xxhash64("doc_id"), 1)).alias("ident"),
        ),
        "shard-records",
    )
    total = records.agg(F.sum("size")).collect()[0][0] or 0
    ranges = shards * RANGES
    share = max(1.0, total / ranges)
    keys, weights = _sample(records, total, ranges * DRAWS)
    splitters, heavy = _subdivided(
        records, _quantiles(keys, weights, ranges), share, max(1.0, total / shards)
    )
    numbered = records.withColumn("range", _ranges(splitters, heavy)("key", "ident"))
    sizes = numbered.groupBy("range").agg(F.sum("size").alias("bytes")).collect()  # one per range
    chosen = assign_shards({r["range"]: r["bytes"] for r in sizes}, shards)
    if not chosen:
        return numbered.select(
            "doc_id", "size", "text_crc32", "key", F.lit(0).alias("shard")
        )
    names = np.array(sorted(chosen), dtype=np.int64)
    targets = np.array([chosen[n] for n in sorted(chosen)], dtype=np.int32)

    @F.pandas_udf("int")
    def shard_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for number in batches:
            yield pd.Series(targets[np.searchsorted(names, number.to_numpy())])

    return numbered.select(
        "doc_id", "size", "text_crc32", "key", shard_of("range").alias("shard")
    )


def write_sharded(documents: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write whole documents below `path`, a folder `shard=n` each, in the order of keys."""
    numbers = shard_numbers(documents, shards).select("doc_id", "key", "shard").distinct()
    key = F.xxhash64(F.coalesce(documents["text"], F.lit("")))
    (
        documents.join(
            numbers, documents["doc_id"].eqNullSafe(numbers["doc_id"]) & (key == numbers["key"])
        )
        .repartitionByRange(numbers["shard"], numbers["key"])
        .sortWithinPartitions(numbers["shard"], numbers["key"])
        .select(*[documents[c] for c in documents.columns if c != "shard"], numbers["shard"])
        .write.partitionBy("shard")
        .parquet(path)
    )


def op8_sharding(documents: DataFrame) -> DataFrame:
    numbered = shard_numbers(documents, SHARDS)
    return group_positions(numbered, ["shard"], ["key", "doc_id"], "slot").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
