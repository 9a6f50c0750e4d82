"""Counts of pairs of places within a radius, without listing the pairs.

Places stand as points on the unit sphere, where straight distance grows with great-circle distance and no date line or pole is in the way.
They are counted in cubic cells.  A pair of cells that lies wholly within the radius counts at once, by the product of its places; one wholly
beyond it counts nothing; only the others are taken apart into the cells of half the width.  Pairs of places are compared one by one only
where the smallest cells, or cells of few places, still straddle the radius.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.functions import geometry as geo
from placeweave.session import stored

HALVINGS = 6  # from cells as wide as the radius to the smallest
FEW = 64  # pairs of places that are compared rather than taken apart further
SAFE = 1e-9  # margin for rounding; what lies closer to the radius is compared exactly
AXES = "xyz"


def _on_sphere(places: DataFrame, width: float) -> DataFrame:
    """Places with the numbers of their smallest cells; those without a coordinate lie nowhere."""
    lon, lat = F.radians("lon"), F.radians("lat")
    point = {"x": F.cos(lat) * F.cos(lon), "y": F.cos(lat) * F.sin(lon), "z": F.sin(lat)}
    return places.filter(F.col("lon").isNotNull() & F.col("lat").isNotNull()).select(
        "kind", "lon", "lat", F.col("quantity").cast("long").alias("quantity"), *[F.floor(c / width).alias(a) for a, c in point.items()])


def _cells(places: DataFrame, level: int, side: str, *by: str) -> DataFrame:
    """Occupied cells of a level: ``{side}x`` … , the cell around each (``{side}px`` …), its places and what they stand for."""
    numbers = [F.shiftright(a, HALVINGS - level).alias(f"{side}{a}") for a in AXES]
    counted = places.groupBy(*numbers, *[F.col(c).alias(f"{side}_{c}") for c in by]).agg(
        F.count(F.lit(1)).alias(f"{side}n"), F.sum("quantity").alias(f"{side}q"))
    return counted.withColumns({f"{side}p{a}": F.shiftright(f"{side}{a}", 1) for a in AXES})


def _apart(width: float) -> Column:
    """Distance of the centres of a pair of cells."""
    return F.lit(width) * F.sqrt(sum((F.pow(F.col(f"l{a}") - F.col(f"r{a}"), F.lit(2)) for a in AXES), F.lit(0.0)))


def _same_cell(side: str, own: str = "") -> list[str]:
    return [f"{side}{own}{a}" for a in AXES]


def _first_pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Pairs of neighbouring cells as wide as the radius: no others hold a pair within it."""
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    around = _cells(left, 0, "l").select(*_same_cell("l"), "ln")
    for a in AXES:
        around = around.withColumn(f"step_{a}", F.explode(steps)).withColumn(f"r{a}", F.col(f"l{a}") + F.col(f"step_{a}")).drop(f"step_{a}")
    return around.join(_cells(right, 0, "r").select(*_same_cell("r"), "rn"), _same_cell("r"))


def _taken_apart(pairs: DataFrame, left: DataFrame, right: DataFrame, level: int) -> DataFrame:
    """The pairs of cells of ``level`` inside ``pairs`` of the level above."""
    parents = pairs.select(*[F.col(f"{s}{a}").alias(f"{s}p{a}") for s in "lr" for a in AXES])
    for side, places in (("l", left), ("r", right)):
        parents = parents.join(_cells(places, level, side).drop(f"{side}q"), _same_cell(side, "p"))
    return parents.select(*_same_cell("l"), "ln", *_same_cell("r"), "rn")


def pairs_within(left: DataFrame, right: DataFrame, metres: float) -> DataFrame:
    """``l_kind``, ``r_kind`` and ``dyads``: how many pairs lie at most ``metres`` apart, kind by kind.

    Both frames hold ``kind``, ``lon``, ``lat`` and ``quantity``, the observations a place stands for.
    """
    radius = 2 * math.sin(min(metres / geo.EARTH_RADIUS, math.pi) / 2)
    smallest = max(radius, 1e-7) / 2 ** HALVINGS
    left, right = (stored(_on_sphere(side, smallest), "sphere") for side in (left, right))
    pairs, found = _first_pairs(left, right), []
    for level in range(HALVINGS + 1):
        width = smallest * 2 ** (HALVINGS - level)
        spread = F.lit(width * math.sqrt(3))
        inside = _apart(width) + spread <= radius * (1 - SAFE) - SAFE * width
        near = _apart(width) - spread <= radius * (1 + SAFE) + SAFE * width
        pairs = stored(pairs.filter(near).withColumn("inside", inside), "cell-pairs")
        found.append(_products(pairs.filter("inside"), left, right, level))
        few = F.lit(True) if level == HALVINGS else F.col("ln") * F.col("rn") <= FEW
        found.append(_compared(pairs.filter(~F.col("inside") & few), left, right, level, metres))
        pairs = _taken_apart(pairs.filter(~F.col("inside") & ~few), left, right, level + 1) if level < HALVINGS else pairs
    return reduce(DataFrame.unionByName, found).groupBy("l_kind", "r_kind").agg(F.sum("dyads").alias("dyads"))


def _products(pairs: DataFrame, left: DataFrame, right: DataFrame, level: int) -> DataFrame:
    """Pairs of cells by the quantities of their kinds."""
    cells = pairs.select(*_same_cell("l"), *_same_cell("r"))
    for side, places in (("l", left), ("r", right)):
        cells = cells.join(_cells(places, level, side, "kind").select(*_same_cell(side), f"{side}_kind", f"{side}q"), _same_cell(side))
    return cells.groupBy("l_kind", "r_kind").agg(F.sum(F.col("lq") * F.col("rq")).alias("dyads"))


def _compared(pairs: DataFrame, left: DataFrame, right: DataFrame, level: int, metres: float) -> DataFrame:
    """Pairs of places of pairs of cells, by their distance."""
    places = pairs.select(*_same_cell("l"), *_same_cell("r"))
    for side, frame in (("l", left), ("r", right)):
        places = places.join(frame.select(
            *[F.shiftright(a, HALVINGS - level).alias(f"{side}{a}") for a in AXES],
            *[F.col(c).alias(f"{side}_{c}") for c in ("kind", "lon", "lat", "quantity")]), _same_cell(side))
    distance = geo.haversine(F.col("l_lon"), F.col("l_lat"), F.col("r_lon"), F.col("r_lat"))
    return places.filter(distance <= F.lit(metres)).groupBy("l_kind", "r_kind").agg(
        F.sum(F.col("l_quantity") * F.col("r_quantity")).alias("dyads"))
