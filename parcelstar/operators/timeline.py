"""Rows along the order of their key: neighbours, last known values, versions, values at a time.

The rows are range-sorted into runs, so a key of any size spreads over as many runs as its rows
ask for. Within a run a window does the work; what a run hands on to the next is one row per
run: its first and last key and what is known of the last one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelstar.operators.ordering import PLACE, RUN, sorted_runs


def _key(keys: list[str]) -> Column:
    return F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])


def _in_run(keys: list[str]):
    return Window.partitionBy(RUN, *keys).orderBy(PLACE)


def _edges(runs: DataFrame, keys: list[str], value: Column) -> DataFrame:
    """A row per run: its first and last key with the value of the row there, and the last
    value in it that is not NULL, if it belongs to the last key."""
    row = F.struct(_key(keys).alias("key"), value.alias("value"))
    known = value.isNotNull()
    edges = runs.groupBy(RUN).agg(
        F.min_by(row, PLACE).alias("first"),
        F.max_by(row, PLACE).alias("last"),
        F.max_by(F.when(known, row), F.when(known, F.col(PLACE))).alias("_known"),
    )
    same = F.col("_known.key").eqNullSafe(F.col("last.key"))
    return edges.withColumn("known", F.when(same, F.col("_known.value"))).drop("_known")


def _joined(runs: DataFrame, given: DataFrame, keys: list[str]) -> DataFrame:
    """Attach `given` (of, key, handed) to the rows of the key in the run."""
    match = (F.col(RUN) == F.col("_of")) & _key(keys).eqNullSafe(F.col("_key"))
    # One row per run: at most spark.sql.shuffle.partitions rows.
    return runs.join(F.broadcast(given), match, "left").drop("_of", "_key")


def carried(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """The last value that is not NULL at or before each row in its key's order."""
    runs = sorted_runs(df, [*keys, *order])
    edges = _edges(runs, keys, F.col(value))
    # At the same run, what it takes for its first key comes before what it gives for its last.
    takes = edges.select(
        RUN, F.lit(0).alias("gives"), F.col("first.key").alias("key"), F.lit(None).alias("known")
    )
    gives = edges.select(RUN, F.lit(1).alias("gives"), F.col("last.key").alias("key"), "known")
    before = Window.partitionBy("key").orderBy(RUN, "gives").rowsBetween(Window.unboundedPreceding, -1)
    handed = (
        takes.unionByName(gives)
        .withColumn("_handed", F.last("known", ignorenulls=True).over(before))
        .where(F.col("gives") == 0)
        .select(F.col(RUN).alias("_of"), F.col("key").alias("_key"), "_handed")
    )
    so_far = _in_run(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = F.last(value, ignorenulls=True).over(so_far)
    rows = _joined(runs.withColumn("_own", own), handed, keys)
    return rows.select(*df.columns, F.coalesce("_own", "_handed").alias(name))


def neighbours(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: Column,
    previous: str | None = None,
    following: str | None = None,
) -> DataFrame:
    """`value` of the row before and after each row in its key's order, NULL at the ends.

    `order` must tell the rows of a key apart for the result to be repeatable.
    """
    runs = sorted_runs(df, [*keys, *order])
    edges = _edges(runs, keys, value)
    every = Window.partitionBy(F.lit(0)).orderBy(RUN)  # a row per run
    before, after = F.lag("last").over(every), F.lead("first").over(every)
    handed = edges.select(
        RUN, F.col("first.key").alias("head"), F.col("last.key").alias("tail"),
        before.alias("before"), after.alias("after"),
    )
    rows = runs
    if previous:
        same = F.col("before.key").eqNullSafe(F.col("head"))
        given = handed.select(
            F.col(RUN).alias("_of"), F.col("head").alias("_key"),
            F.when(same, F.col("before.value")).alias("_before"),
        )
        rows = rows.withColumns(
            {
                previous: F.lag(value).over(_in_run(keys)),
                "_starts": F.row_number().over(_in_run(keys)) == 1,
            }
        )
        own = F.when(F.col("_starts"), F.col("_before")).otherwise(F.col(previous))
        rows = _joined(rows, given, keys).withColumn(previous, own).drop("_before", "_starts")
    if following:
        same = F.col("after.key").eqNullSafe(F.col("tail"))
        given = handed.select(
            F.col(RUN).alias("_of"), F.col("tail").alias("_key"),
            F.when(same, F.col("after.value")).alias("_after"),
        )
        backwards = Window.partitionBy(RUN, *keys).orderBy(F.desc(PLACE))
        rows = rows.withColumns(
            {
                following: F.lead(value).over(_in_run(keys)),
                "_ends": F.row_number().over(backwards) == 1,
            }
        )
        own = F.when(F.col("_ends"), F.col("_after")).otherwise(F.col(following))
        rows = _joined(rows, given, keys).withColumn(following, own).drop("_after", "_ends")
    return rows.select(*df.columns, *[n for n in (previous, following) if n])


def versions(df: DataFrame, keys: list[str], since: str, attributes: list[str]) -> DataFrame:
    """A dated series as versions: the keys, the attributes, valid_from and valid_to.

    A version begins at a date with other attributes than the date before had and is valid up
    to, not including, the next one's; the last one's valid_to is NULL. Of several rows of a
    key and date the greatest attributes count. Rows without a date are left out; a NULL key
    is a key like any other.
    """
    dated = df.where(F.col(since).isNotNull())
    row = F.struct(*attributes)
    single = dated.groupBy(*keys, since).agg(F.max(row).alias("_row"))
    # A struct, so that a first row is told from one that follows NULLs.
    seen = neighbours(single, keys, [since], F.struct("_row"), previous="_last")
    starts = seen.where(~F.col("_last").eqNullSafe(F.struct("_row"))).drop("_last")
    spans = neighbours(starts, keys, [since], F.col(since), following="valid_to")
    return spans.select(*keys, "_row.*", F.col(since).alias("valid_from"), "valid_to")


def value_at(
    rows: DataFrame,
    history: DataFrame,
    keys: list[str],
    at: str,
    since: str,
    values: list[str],
) -> DataFrame:
    """`rows` with the `values` that `history` knew for their key at the time `at`.

    That is the history row of the key with the latest `since` not after `at`; of several with
    one time the one with the greatest values. Rows without such a row, without time or with a
    NULL in their key get NULLs. Both sides are merged into one sorted union in which the last
    known value is carried forward, so no row meets more than one history row, and a hot key
    spreads over runs.
    """
    def known(df: DataFrame, names: list[str]) -> Column:
        return reduce(Column.__and__, [F.col(n).isNotNull() for n in names])

    names = [f"_k{i}" for i in range(len(keys))]
    told = history.where(known(history, [*keys, since]))
    told = told.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.col(since).alias("_time"),
        F.lit(0).alias("_side"),
        F.struct(*values).alias("_told"),
        F.lit(None).cast(rows.select(F.struct("*").alias("r")).schema["r"].dataType).alias("_row"),
    )
    asked = rows.where(known(rows, [*keys, at])).select(
        *[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)],
        F.col(at).cast(told.schema["_time"].dataType).alias("_time"),
        F.lit(1).alias("_side"),
        F.lit(None).cast(told.schema["_told"].dataType).alias("_told"),
        F.struct("*").alias("_row"),
    )
    # Rows of one key and time may be many; a draw lets them spread over runs.
    text = "map<" in told.schema["_row"].dataType.simpleString()  # maps cannot be hashed
    draw = F.xxhash64(F.to_json("_row") if text else F.col("_row"))
    both = told.unionByName(asked).withColumn("_draw", draw)
    merged = carried(both, names, ["_time", "_side", "_told", "_draw"], "_told", "_found")
    found = merged.where(F.col("_side") == 1).select("_row.*", "_found.*")
    nothing = [
        F.lit(None).cast(history.schema[v].dataType).alias(v) for v in values
    ]
    return found.unionByName(rows.where(~known(rows, [*keys, at])).select("*", *nothing))
