"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelstar.session import write_through


def _stars(edges: DataFrame) -> DataFrame:
    """One round: every node's larger neighbours, then its smaller ones, go to its least."""
    both = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = (
        both.where("v > u")
        .join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u != v")
        .distinct()
    )
    lower = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    first = lower.groupBy("u").agg(F.min("v").alias("m"))
    small = lower.join(first, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return (
        small.where("u != v")
        .union(first.select("u", "m"))
        .distinct()
        .select(F.col("v").alias("a"), F.col("u").alias("b"))
    )


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component` (least node) of every node in the links (a, b).

    Each round is written to the shared folder, so no lineage grows and a lost executor
    costs one round. Only a count and a checksum per round come to the driver. Rounds end
    when the links no longer change, that is, when each node hangs on its component's least.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(
            df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a")))
            .collect()[0]
        )

    current = write_through(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .where("a != b")
        .distinct(),
        "links",
    )
    before = state(current)
    while before[0]:
        following = write_through(_stars(current), "links")
        after = state(following)
        if after == before:
            break
        current, before = following, after
    return current.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        current.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    )
