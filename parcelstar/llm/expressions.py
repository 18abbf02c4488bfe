"""Column helpers shared by the operators that stay in built-in functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once per row.

    The optimizer copies a projected column into the place that uses it, also into the
    body of a loop over an array; a bound value is not copied.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, UPPER, UPPER.lower())


def words_between(text: Column, separators: str) -> Column:
    """The non-empty pieces between runs of separators; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def following(values: Column, step: int) -> Column:
    """The values from `step` places on."""
    return F.slice(values, F.lit(step + 1), F.size(values))


def paired(values: Column, step: int, combine: Callable[[Column, Column], Column]) -> Column:
    """Each value combined with the one `step` places on; beyond the end with a null."""
    return let(values, lambda v: F.zip_with(v, following(v, step), combine))


def window_hashes(hashes: Column, k: int) -> Column:
    """Hash of each window of `k` values, by doubling; the last k - 1 have no meaning.

    Two windows get the same hash if and (but for 64-bit collisions) only if their
    values are the same in order.
    """
    width = 1
    while width < k:
        step = min(width, k - width)
        hashes = paired(hashes, step, lambda a, b: F.xxhash64(a, b))
        width += step
    return hashes


def window_minima(values: Column, w: int) -> Column:
    """Least of each window of `w` values, by doubling; the last w - 1 are partial."""
    width = 1
    while width < w:
        step = min(width, w - width)
        values = paired(values, step, lambda a, b: F.least(a, b))
        width += step
    return values


def covered(starts_ends: Column) -> Column:
    """Places covered by spans [first, last], given as an array of structs (first, last)."""
    state = F.struct(F.lit(-1).alias("until"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        F.sort_array(starts_ends),
        state,
        lambda s, x: F.struct(
            F.greatest(s["until"], x["last"]).alias("until"),
            (
                s["total"]
                + F.greatest(x["last"] - F.greatest(s["until"], x["first"] - 1), F.lit(0))
            ).alias("total"),
        ),
        lambda s: s["total"],
    )
