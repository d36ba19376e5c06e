"""Positions of markers on a map: those that would cover each other stand on a ring around their centre."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.ranking import global_rank

# Metres of a degree of latitude; radius of a ring of two, metres more for each further marker, and at most.
DEGREE, RING, MORE, WIDEST = 111320, 20, 6, 58


def ring_layout(points: DataFrame, group: str, order: Sequence[Column], lat: str = "lat", lon: str = "lon") -> DataFrame:
    """points with shown_lat, shown_lon, offset and group_size.

    A point that is alone in its group (of connected_components()) stays. Others go on a circle around the mean of their
    group's coordinates, evenly from the west on, by `order`. A point's place in its group is its rank in the whole table
    less that of the group's first, so no group is sorted by one task."""
    ranked = global_rank(points, [F.col(group), *order], "_rank")
    sizes = points.groupBy(group).agg(F.count("*").alias("group_size"), F.avg(lat).alias("_lat"), F.avg(lon).alias("_lon"))
    firsts = ranked.groupBy(group).agg(F.min("_rank").alias("_first"))
    rows = ranked.join(sizes.join(firsts, group), group)
    n = F.col("group_size")
    angle = -F.pi() / 2 + 2 * F.pi() * (F.col("_rank") - F.col("_first")) / n
    radius = F.least(F.lit(float(WIDEST)), RING + MORE * (n - 2.0))
    north, east = F.cos(angle) * radius, F.sin(angle) * radius
    moved = n > 1
    shown_lat = F.when(moved, F.col("_lat") + north / DEGREE).otherwise(F.col(lat))
    shown_lon = F.when(moved, F.col("_lon") + east / (DEGREE * F.cos(F.radians("_lat")))).otherwise(F.col(lon))
    return rows.select(*points.columns, shown_lat.alias("shown_lat"), shown_lon.alias("shown_lon"), moved.alias("offset"), "group_size")
