"""Distances and joins by distance, as column expressions and equi-joins."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from shelfsight import config
from shelfsight.session import stage

MAX_LATITUDE = 85.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(F.radians(lon2 - lon1) / 2), 2
    )
    return 2 * config.EARTH_RADIUS_M * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def decay_weight(distance: Column, sigma: Column, kernel: str = config.SPATIAL.kernel) -> Column:
    """Pull of something at a distance: 1 at 0, falling with ``sigma``; 0 without a distance or scale."""
    if kernel == "exponential":
        weight = F.exp(-F.try_divide(distance, sigma))
    elif kernel == "gaussian":
        weight = F.exp(-F.try_divide(distance * distance, 2 * sigma * sigma))
    else:
        raise ValueError(f"unknown kernel {kernel!r}")
    known = distance.isNotNull() & (F.abs(distance) < F.lit(float("inf"))) & (sigma > 0)
    return F.when(known, weight).otherwise(0.0)


def _row_height(radius_m: float) -> float:
    return math.degrees(radius_m / config.EARTH_RADIUS_M)


def _row(lat: Column, radius_m: float) -> Column:
    return F.floor(lat / _row_height(radius_m)).cast("long")


def _cell(row: Column, lon: Column, radius_m: float) -> Column:
    """Cell along a grid row. The width fits the row: it is the widest span of
    longitude two points within the radius can have, one of them in this row."""
    top = F.radians((F.greatest(F.abs(row), F.abs(row + 1)) + 1) * _row_height(radius_m))
    span = F.lit(math.sin(radius_m / (2 * config.EARTH_RADIUS_M))) / F.cos(top)
    return F.floor(lon / F.degrees(2 * F.asin(F.least(span, F.lit(1.0))))).cast("long")


def _checked(lat: Column) -> Column:
    message = F.lit(f"latitude beyond {MAX_LATITUDE} degrees in a distance join")
    return F.when(F.abs(lat) <= MAX_LATITUDE, lat).otherwise(F.raise_error(message).cast("double"))


def _met(df: DataFrame) -> DataFrame:
    """``df`` to be joined by sorting both sides on the key.

    The planner sizes a side by its file, not by the rows an ``explode`` makes of
    it: left alone it collects a repeated side on the driver to broadcast it.
    """
    return df.hint("merge")


def _hot_cells(a: DataFrame, b: DataFrame, most_pairs: int) -> DataFrame:
    """The cells with too many candidates for one task, and into how many lines and rows of parts they are cut."""
    left = a.groupBy(F.col("_ca").alias("_ha"), F.col("_co").alias("_ho")).agg(F.count("*").alias("_nl"))
    right = b.groupBy(F.col("_ra").alias("_ha"), F.col("_ro").alias("_ho")).agg(F.count("*").alias("_nr"))
    both = left.join(_met(right), ["_ha", "_ho"]).where(F.col("_nl").cast("double") * F.col("_nr") > most_pairs)
    parts = F.col("_nl").cast("double") * F.col("_nr") / most_pairs
    # As a written table it has a known size, mostly none: it is broadcast and the rows stay in place.
    cut = both.withColumn("_lines", F.least(F.ceil(F.sqrt(parts * F.col("_nl") / F.col("_nr"))), F.col("_nl")))
    return stage(cut.select("_ha", "_ho", "_lines", F.ceil(parts / F.col("_lines")).alias("_rows")), "hot_cells")


def _dealt(df: DataFrame, hot: DataFrame, row: str, column: str, position: Sequence[str], own: str, other: str, side: str) -> DataFrame:
    """Rows with their line in a hot cell, repeated for each line of the other side; one line elsewhere."""
    joined = df.join(hot, (F.col(row) == F.col("_ha")) & (F.col(column) == F.col("_ho")), "left")
    line = F.coalesce(F.pmod(F.xxhash64(*position), F.col(own)), F.lit(0))
    others = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col(other), F.lit(1)).cast("long") - 1)
    return joined.withColumn(f"{side}_own", line).withColumn(f"{side}_other", F.explode(others)).drop("_ha", "_ho", "_lines", "_rows")


def radius_join(
    left: DataFrame,
    right: DataFrame,
    radius_m: float,
    left_position: Sequence[str] = ("latitude", "longitude"),
    right_position: Sequence[str] = ("lat", "lon"),
    most_pairs: int = 4_000_000,
) -> DataFrame:
    """Pairs no further apart than the radius, with ``distance_m``.

    Both sides get a grid cell, ``right`` also the eight cells around its own,
    and an equi-join on the cell finds the candidates. Each pair meets once, as
    only ``right`` is repeated: give the smaller side there. Rows without a
    position have no partner. Callers collapse equal positions first (see
    :func:`places`), so a crowd at one spot is a single row here.

    The rows of each cell are counted first. A cell with more than ``most_pairs``
    candidates is cut into a square of parts: a row is dealt to a line of it by
    its position and repeated along that line, so each part is a task's work.

    Poles and the antimeridian are out of scope.
    """
    if radius_m <= 0:
        raise ValueError("the radius must be positive")
    (llat, llon), (rlat, rlon) = left_position, right_position
    a = left.where(F.col(llat).isNotNull() & F.col(llon).isNotNull())
    a = a.withColumn("_ca", _row(_checked(F.col(llat)), radius_m))
    a = a.withColumn("_co", _cell(F.col("_ca"), F.col(llon), radius_m))
    b = right.where(F.col(rlat).isNotNull() & F.col(rlon).isNotNull())
    own_row = _row(_checked(F.col(rlat)), radius_m)
    b = b.select("*", F.explode(F.array(own_row - 1, own_row, own_row + 1)).alias("_ra"))
    b = b.withColumn("_own", _cell(F.col("_ra"), F.col(rlon), radius_m))
    b = b.select("*", F.explode(F.array(F.col("_own") - 1, F.col("_own"), F.col("_own") + 1)).alias("_ro")).drop("_own")
    hot = _hot_cells(a, b, most_pairs)
    a, b = _dealt(a, hot, "_ca", "_co", left_position, "_lines", "_rows", "_l"), _dealt(b, hot, "_ra", "_ro", right_position, "_rows", "_lines", "_r")
    same = [F.col(x) == F.col(y) for x, y in (("_ca", "_ra"), ("_co", "_ro"), ("_l_own", "_r_other"), ("_l_other", "_r_own"))]
    pairs = a.join(_met(b), reduce(lambda x, y: x & y, same))
    distance = haversine_m(F.col(llat), F.col(llon), F.col(rlat), F.col(rlon))
    return (
        pairs.withColumn("distance_m", distance)
        .where(F.col("distance_m") <= radius_m)
        .drop("_ca", "_co", "_ra", "_ro", "_l_own", "_l_other", "_r_own", "_r_other")
    )


def places(df: DataFrame, lat: str, lon: str, *more: str, count: str = "n") -> DataFrame:
    """Distinct positions with the number of rows at each."""
    located = df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    return located.groupBy(lat, lon, *more).agg(F.count("*").alias(count))


# Beyond this many halvings cells are below a millimetre: what is in them is compared directly.
_DEEPEST = 24


def _bands(spots: DataFrame, lat: str, lon: str, n: str, height: float) -> DataFrame:
    """``lat, lon, n`` and the position in cells of the top level, whole numbers being the cell's corner.

    Cells of a row are as wide as its middle asks for to be square. Halving a
    cell doubles both numbers, so the cell of any level is a floor of them.
    """
    y = F.col(lat) / height
    placed = spots.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(lat, lon, n, y.alias("_y"))
    return placed.withColumn("_x", F.col(lon) / _band_width(F.floor("_y"), height))


def _band_width(top_row: Column, height: float) -> Column:
    return F.lit(height) / F.greatest(F.cos(F.radians((top_row + 0.5) * height)), F.lit(0.05))


def _cells(placed: DataFrame, n: str, level: int, suffix: str) -> DataFrame:
    """The occupied cells of a level: row, column, positions and rows in it."""
    row, column = (F.floor(F.col(c) * float(1 << level)).cast("long").alias(f"{k}{suffix}") for c, k in (("_y", "_r"), ("_x", "_c")))
    return placed.groupBy(row, column).agg(F.count("*").alias(f"_k{suffix}"), F.sum(n).alias(f"_n{suffix}"))


def _middle(level: int, height: float, suffix: str) -> tuple[Column, Column, Column]:
    """Latitude and longitude of a cell's middle, and how far from it a point of the cell can be."""
    row, column, scale = F.col(f"_r{suffix}"), F.col(f"_c{suffix}"), float(1 << level)
    high, width = height / scale, _band_width(F.shiftright(row, level), height) / scale
    low = F.radians(F.least(F.abs(row), F.abs(row + 1)) * high)
    half = F.hypot(F.lit(math.radians(high) / 2), F.cos(low) * F.radians(width) / 2)
    return (row + 0.5) * high, (column + 0.5) * width, 2 * config.EARTH_RADIUS_M * F.asin(F.least(half / 2, F.lit(1.0)))


def _undecided(pairs: DataFrame, level: int, height: float, radius_m: float) -> DataFrame:
    """Pairs of cells that are not out of reach, with ``_inside`` where all of both is within the radius."""
    lat1, lon1, reach1 = _middle(level, height, "1")
    lat2, lon2, reach2 = _middle(level, height, "2")
    kept = [f"_{k}{side}" for side in "12" for k in "rckn"]
    measured = pairs.select(*kept, haversine_m(lat1, lon1, lat2, lon2).alias("_d"), (reach1 + reach2).alias("_s"))
    inside = F.col("_d") + F.col("_s") <= radius_m * (1 - 1e-9)
    return measured.where(F.col("_d") - F.col("_s") <= radius_m * (1 + 1e-9)).select(*kept, inside.alias("_inside"))


def refine(placed: DataFrame, n: str, height: float, radius_m: float, direct: int) -> tuple[DataFrame, DataFrame]:
    """(whole, rim): pairs of cells wholly within the radius, and pairs left to compare position by position.

    Both name a level and the cells. A quadtree is walked from two sides at
    once, a level per round: a pair of cells within the radius counts as a whole,
    one out of reach is dropped, and one at the rim goes on with the halves of
    both cells, until no more than ``direct`` pairs of positions are in it.
    """
    top = [_cells(placed, n, 0, side) for side in "12"]
    sited = [c.withColumns(dict(zip((f"_lat{k}", f"_lon{k}"), _middle(0, height, k)[:2]))) for c, k in zip(top, "12")]
    widest = radius_m + 3 * config.EARTH_RADIUS_M * math.radians(height)
    pairs = radius_join(sited[0], sited[1], widest, ("_lat1", "_lon1"), ("_lat2", "_lon2"))
    whole, rim = [], []
    for level in range(_DEEPEST + 1):
        near = stage(_undecided(pairs, level, height, radius_m), "near_cells")
        named = [F.lit(level).alias("_level"), "_r1", "_c1", "_r2", "_c2", "_n2"]
        few = F.col("_k1") * F.col("_k2") <= (direct if level < _DEEPEST else 1 << 62)
        whole.append(near.where("_inside").select(*named))
        rim.append(near.where(~F.col("_inside") & few).select(*named))
        open_ = near.where(~F.col("_inside") & ~few).select("_r1", "_c1", "_r2", "_c2")
        if open_.isEmpty():
            break
        halves = []
        for side in "12":
            cells = _cells(placed, n, level + 1, side)
            parent = [F.shiftright(f"_{k}{side}", 1).alias(f"_p{k}") for k in "rc"]
            halves.append(cells.select("*", *parent).withColumnsRenamed({"_pr": f"_pr{side}", "_pc": f"_pc{side}"}))
        pairs = open_.withColumnsRenamed({f"_{k}{side}": f"_p{k}{side}" for side in "12" for k in "rc"})
        pairs = pairs.join(_met(halves[0]), ["_pr1", "_pc1"]).join(_met(halves[1]), ["_pr2", "_pc2"])
    return reduce(DataFrame.unionByName, whole), reduce(DataFrame.unionByName, rim)


def counts_within(spots: DataFrame, lat: str, lon: str, n: str, radius_m: float, direct: int = 1024) -> DataFrame:
    """``lat, lon, within``: rows (``n`` of them per spot) within the radius of each spot, itself included.

    Distinct spots are expected (see :func:`places`). Cells that lie within the
    radius as a whole are counted, not paired; only positions in cells at the rim
    of each other's circle are compared, in cells that get smaller where positions
    are dense. In an area of a given size the comparisons grow with the power 1.5
    of the positions, where listing pairs grows with the square.
    """
    if radius_m <= 0:
        raise ValueError("the radius must be positive")
    height = _row_height(radius_m) / 2
    placed = stage(_bands(spots, lat, lon, n, height), "spots")
    whole, rim = refine(placed, n, height, radius_m, direct)
    deep = rim.unionByName(whole).agg(F.max("_level")).first()[0] or 0
    cells = F.array(
        *[
            F.struct(
                F.lit(level).alias("_level"),
                F.floor(F.col("_y") * float(1 << level)).cast("long").alias("_r"),
                F.floor(F.col("_x") * float(1 << level)).cast("long").alias("_c"),
            )
            for level in range(deep + 1)
        ]
    )
    keyed = placed.select(lat, lon, n, F.inline(cells))
    here = keyed.withColumnsRenamed({"_r": "_r1", "_c": "_c1"})
    there = keyed.withColumnsRenamed({"_r": "_r2", "_c": "_c2", lat: "_lat2", lon: "_lon2", n: "_there"})
    counted = whole.groupBy("_level", "_r1", "_c1").agg(F.sum("_n2").alias("_part"))
    counted = here.join(_met(counted), ["_level", "_r1", "_c1"]).select(lat, lon, "_part")
    distance = haversine_m(F.col(lat), F.col(lon), F.col("_lat2"), F.col("_lon2"))
    compared = here.join(_met(rim.drop("_n2")), ["_level", "_r1", "_c1"]).join(_met(there), ["_level", "_r2", "_c2"]).where(distance <= radius_m)
    compared = compared.groupBy(lat, lon).agg(F.sum("_there").alias("_part"))
    return counted.unionByName(compared).groupBy(lat, lon).agg(F.sum("_part").alias("within"))
