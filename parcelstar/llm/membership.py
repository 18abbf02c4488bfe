"""Which rows may be among some keys, by a bitmap of fixed size.

A join of whole documents with a few keys would shuffle every text. The bitmap tells most
documents that cannot be among the keys where they are read; only the others are joined.
It has 4 million bits, whatever the number of keys: with very many keys it rules out less,
and the join does more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of 64 bits; the broadcast table has a row each at most, one megabyte.
WORDS = 1 << 16


def _word(hashed: Column) -> Column:
    return F.shiftright(hashed, 6).bitwiseAND(F.lit(WORDS - 1))


def _bit(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit(63)).cast("int")


def split_by_membership(
    rows: DataFrame, column: str, keys: DataFrame, key: str
) -> tuple[DataFrame, DataFrame]:
    """`rows` that may have one of the keys in `column`, and those that surely have none.

    A null is a key like any other.
    """
    hashed = F.xxhash64(keys[key])
    marks = F.broadcast(
        keys.groupBy(_word(hashed).alias("_word")).agg(
            F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), _bit(hashed))).alias("_marks")
        )
    )
    own = F.xxhash64(rows[column])
    joined = rows.join(marks, _word(own) == marks["_word"], "left")
    shifted = F.call_function("shiftrightunsigned", marks["_marks"], _bit(own))
    set_bit = shifted.bitwiseAND(F.lit(1))
    maybe = F.coalesce(set_bit == 1, F.lit(False))
    columns = [rows[c] for c in rows.columns]
    return joined.where(maybe).select(*columns), joined.where(~maybe).select(*columns)
