"""The nearest comparable listings of each listing, by a grid of cells of several sizes.

Listings of one kind at one place are one point; its first ids are all that can be asked of it.
A level halves the search radius; its cells are about as wide as its radius, so all points
within the radius of a point lie in its own cell and those around it. A point begins at the
level at which about as many points as it asks for share its cell, and is done when it finds
enough within that level's radius; otherwise it goes on some levels up, until the whole
radius. In dense places the cells are thus small, in sparse ones large, and the pairs looked at
grow with the points, not with their square. Only pairs within the level's radius are sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelstar.operators.joins import lookup_join
from parcelstar.operators.ordering import PLACE, RUN, sorted_runs
from parcelstar.session import write_through

EARTH_MILES = 3958.8
#: Bits by which a level's cells are halved, the finest level, and the levels that a point goes
#: up which has not found enough.
STEP, FINEST, UP = 1, 10, 2
BITS = STEP * FINEST
#: Distances are compared to a millionth of a mile, about a sixteenth of an inch.
PLACES = 6
_POINT = ["_kind", "_lat", "_lon"]


def distance_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance of two places given in degrees."""
    north = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
    east = F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    level = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    return 2 * EARTH_MILES * F.asin(F.sqrt(north + level * east))


class Grid:
    """Cells for a search radius. Level l has cells for radius / 2^l."""

    def __init__(self, radius: float) -> None:
        self.radius = radius
        self.angle = math.degrees(radius / EARTH_MILES)
        self.height = 1.0001 * self.angle  # of the largest cells, in degrees

    def reached(self, level: Column) -> Column:
        """The radius of a level, in miles."""
        return F.lit(self.radius) * F.pow(F.lit(2.0), F.lit(-STEP) * level)

    def band(self, row: Column) -> Column:
        """Of the largest cells, from a row of the finest."""
        return F.floor(row / (1 << BITS))

    def _reach(self, lat: Column, level: Column | int) -> Column:
        """Degrees of longitude that a level's radius spans at a latitude, and a little more."""
        part = F.pow(F.lit(2.0), F.lit(-STEP) * level)
        ratio = F.sin(F.radians(F.lit(self.angle) * part)) / F.cos(F.radians(lat))
        return 1.0001 * F.degrees(F.asin(F.least(ratio, F.lit(1.0))))

    def _width(self, band: Column) -> Column:
        """Of the largest cells of a band, in degrees: enough for its latitude farthest out."""
        farthest = F.greatest(F.abs(band), F.abs(band + 1)) * self.height
        return self._reach(F.least(farthest, F.lit(89.0)), 0)

    def row(self, lat: Column) -> Column:
        """Place from south to north, in the finest cells."""
        return F.floor(lat / (self.height / (1 << BITS)))

    def column(self, lon: Column, band: Column) -> Column:
        """Place from west to east, in the finest cells of a band."""
        return F.floor(lon / (self._width(band) / (1 << BITS)))

    def around(self, lat: Column, lon: Column, level: Column) -> Column:
        """The cells (band, row, col) of a level that a level's radius around a place meets."""
        shift = (F.lit(BITS) - F.lit(STEP) * level).cast("int")
        size = self.height / (1 << BITS) * F.pow(F.lit(2.0), shift)
        own, reach = F.floor(lat / size), self._reach(lat, level)

        def of_row(row: Column) -> Column:
            band = F.floor(row / F.pow(F.lit(2.0), F.lit(STEP) * level))
            width = self._width(band) / (1 << BITS) * F.pow(F.lit(2.0), shift)
            columns = F.sequence(F.floor((lon - reach) / width), F.floor((lon + reach) / width))
            return F.transform(
                columns, lambda c: F.struct(band.alias("band"), row.alias("row"), c.alias("col"))
            )

        rows = F.array(own - 1, own, own + 1)
        return F.flatten(F.transform(rows, of_row))


def _interleaved(row: Column, col: Column) -> Column:
    """The bits of a point's place in its largest cell, those of row and column by turns."""
    code = F.lit(0).cast("bigint")
    for i in range(BITS):
        for place, c in ((2 * i + 1, row), (2 * i, col)):
            bit = F.shiftright(c, i).bitwiseAND(F.lit(1).cast("bigint"))
            code = code.bitwiseOR(F.shiftleft(bit, place))
    return code


def _common_level(other: str) -> Column:
    """The finest level at which a point and another one share a cell; 0 if none."""
    far = F.greatest(
        F.col(f"{other}._row").bitwiseXOR(F.col("_row")), F.col(f"{other}._col").bitwiseXOR(F.col("_col"))
    )
    bits = F.ceil(F.log2(F.abs(far).cast("double") + 1))
    same = (F.col(f"{other}._kind") == F.col("_kind")) & (F.col(f"{other}._band") == F.col("_band"))
    level = F.floor((BITS - bits) / STEP)
    return F.when(same, F.greatest(level, F.lit(0))).otherwise(0)


def _points(listings: DataFrame, grid: Grid, k: int) -> DataFrame:
    """Written table: a row per place and kind with its first k + 1 listings and its level."""
    first = Window.partitionBy(*_POINT).orderBy("_id")
    # The limit is applied in each task before the shuffle.
    some = listings.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k + 1)
    points = some.groupBy(*_POINT).agg(
        F.array_sort(F.collect_list(F.struct("_id", "_value"))).alias("_listed")
    )
    row = grid.row(F.col("_lat"))
    band = grid.band(row)
    placed = points.withColumns(
        {"_band": band, "_row": row, "_col": grid.column(F.col("_lon"), band)}
    )
    low = F.lit((1 << BITS) - 1).cast("bigint")
    code = _interleaved(F.col("_row").bitwiseAND(low), F.col("_col").bitwiseAND(low))
    cell = {"_row0": F.shiftright("_row", BITS), "_col0": F.shiftright("_col", BITS), "_code": code}
    runs = sorted_runs(placed.withColumns(cell), ["_kind", "_row0", "_col0", "_code"])
    in_run = Window.partitionBy(RUN).orderBy(PLACE)
    own = F.struct("_kind", "_band", "_row", "_col")
    # At the ends of a run the level is a guess too coarse, which costs some pairs only.
    near = runs.withColumns({"_before": F.lag(own, k).over(in_run), "_after": F.lead(own, k).over(in_run)})
    level = F.greatest(F.coalesce(_common_level("_before"), F.lit(0)), F.coalesce(_common_level("_after"), F.lit(0)))
    return write_through(
        near.select(*_POINT, "_listed", "_band", "_row", "_col", level.cast("int").alias("_level")), "points"
    )


def _found(points: DataFrame, todo: DataFrame, grid: Grid, k: int) -> DataFrame:
    """For each point of `todo` at its level the nearest k + 1 listings in the cells around."""
    asked = todo.select(
        "_kind",
        "_level",
        F.col("_lat").alias("_from_lat"),
        F.col("_lon").alias("_from_lon"),
        F.explode(grid.around(F.col("_lat"), F.col("_lon"), F.col("_level"))).alias("_cell"),
    ).select("_kind", "_level", "_from_lat", "_from_lon", "_cell.*")
    levels = [r[0] for r in todo.select("_level").distinct().collect()]  # at most FINEST + 1
    shift = (F.lit(BITS) - F.lit(STEP) * F.col("_level")).cast("int")

    def coarser(c: str) -> Column:
        return F.call_function("shiftright", F.col(c), shift)

    there = points.withColumn("_level", F.explode(F.array(*map(F.lit, levels))))
    there = there.select(
        "_kind", "_level", F.col("_band").alias("band"), coarser("_row").alias("row"),
        coarser("_col").alias("col"), "_lat", "_lon", "_listed",
    )
    met = lookup_join(there, asked, ["_kind", "_level", "band", "row", "col"], "inner")
    miles = distance_miles(F.col("_from_lat"), F.col("_from_lon"), F.col("_lat"), F.col("_lon"))
    # What lies farther is found again at the level that reaches it.
    near = met.withColumn("_miles", F.round(miles, PLACES)).where(F.col("_miles") <= grid.reached(F.col("_level")))
    near = near.select(
        "_kind", F.col("_from_lat").alias("_lat"), F.col("_from_lon").alias("_lon"), "_level", "_miles", "_listed"
    )
    # The first listings of the first k + 1 points are before all of a later point's.
    order = Window.partitionBy(*_POINT).orderBy("_miles", F.col("_listed")[0]["_id"])
    best = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    grouped = best.groupBy(*_POINT, "_level").agg(F.collect_list(F.struct("_miles", "_listed")).alias("_of"))

    def listed(point: Column) -> Column:
        return F.transform(
            point["_listed"],
            lambda one: F.struct(point["_miles"].alias("_miles"), one["_id"].alias("_id"), one["_value"].alias("_value")),
        )

    every = F.array_sort(F.flatten(F.transform("_of", listed)))
    return grouped.select(*_POINT, "_level", F.slice(every, 1, k + 1).alias("_near"))


def nearest(
    listings: DataFrame, key: str, kind: str, value: str, k: int = 5, radius: float = 5.0
) -> DataFrame:
    """A row per listing with `comparables`: the k nearest others of its kind within `radius` miles.

    `comparables` is an array of (distance, id, value) by distance, rounded to PLACES, then by id.
    Listings have latitude and longitude; one without id, kind or coordinates has no comparables
    and is none. Rows that repeat an id are others to each other only if their id differs.
    Longitudes do not wrap around. An empty table gives none.
    """
    grid = Grid(radius)
    needed = [key, kind, "latitude", "longitude"]
    located = listings.dropna(subset=needed).select(
        F.col(key).alias("_id"), F.col(kind).alias("_kind"), F.col(value).alias("_value"),
        F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"),
    ).distinct()
    located = write_through(located, "located")
    points = _points(located, grid, k)
    todo, done = points.select(*_POINT, "_level"), []
    while True:
        found = write_through(_found(points, todo, grid, k), "found")
        reached = grid.reached(F.col("_level")) - 10.0**-PLACES
        last = F.try_element_at("_near", F.lit(k + 1))["_miles"]
        over = (F.col("_level") == 0) | F.coalesce(last < reached, F.lit(False))
        done.append(found.where(over).select(*_POINT, "_near"))
        todo = found.where(~over).select(*_POINT, F.greatest(F.col("_level") - UP, F.lit(0)).alias("_level"))
        if todo.isEmpty():
            break
    of_points = done[0]
    for more in done[1:]:
        of_points = of_points.unionByName(more)
    others = F.slice(F.filter("_near", lambda n: n["_id"] != F.col("_id")), 1, k)
    shaped = F.transform(
        others,
        lambda n: F.struct(n["_miles"].alias("distance"), n["_id"].alias("id"), n["_value"].alias("value")),
    )
    answered = lookup_join(located, write_through(of_points, "nearest"), _POINT, "inner")
    return answered.select(F.col("_id").alias(key), shaped.alias("comparables"))


def comparables(
    listings: DataFrame, key: str, kind: str, value: str, k: int = 5, radius: float = 5.0
) -> DataFrame:
    """A row per listing and comparable: key, rank from 1, comparable_id, distance and value."""
    rows = nearest(listings, key, kind, value, k, radius)
    return rows.select(key, F.posexplode("comparables").alias("_at", "_one")).select(
        key,
        (F.col("_at") + 1).alias("rank"),
        F.col("_one.id").alias("comparable_id"),
        F.col("_one.distance").alias("distance"),
        F.col("_one.value").alias(value),
    )


def valuations(
    listings: DataFrame, key: str, kind: str, value: str, k: int = 5, radius: float = 5.0
) -> DataFrame:
    """A row per listing with comparables that have a value: estimate, range and their number.

    The estimate is the mean of their values, the range their least and greatest.
    """
    rows = nearest(listings, key, kind, value, k, radius)
    values = F.filter(F.transform("comparables", lambda c: c["value"]), lambda v: v.isNotNull())
    known = rows.select(key, values.alias("_values")).where(F.size("_values") > 0)
    summed = F.aggregate("_values", F.lit(0.0), lambda total, v: total + v)
    return known.select(
        key,
        F.size("_values").alias("comparable_count"),
        (summed / F.size("_values")).alias("estimate"),
        F.array_min("_values").alias("range_low"),
        F.array_max("_values").alias("range_high"),
    )
