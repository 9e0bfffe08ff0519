"""Geometry as arrays of doubles: rings are closed lists of [lon, lat]."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrille.constants import MILE_LAT, MILE_LON

RING = "array<array<double>>"
POLYGON = f"array<{RING}>"
MULTIPOLYGON = f"array<{POLYGON}>"


def square(lat: Column, lon: Column) -> Column:
    """The closed ring of a cell: half a mile to each side, from the south-west round to it again."""
    n, s = lat + F.lit(MILE_LAT / 2), lat - F.lit(MILE_LAT / 2)
    e, w = lon + F.lit(MILE_LON / 2), lon - F.lit(MILE_LON / 2)
    return F.array(F.array(w, s), F.array(e, s), F.array(e, n), F.array(w, n), F.array(w, s))


def ring_edges(ring: Column) -> Column:
    """Edges of a closed ring: array<struct<x1,y1,x2,y2>>."""
    return F.transform(
        F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))),
        lambda p, i: F.struct(
            p[0].alias("x1"), p[1].alias("y1"), F.get(ring, i + 1)[0].alias("x2"), F.get(ring, i + 1)[1].alias("y2")
        ),
    )


def ring_area(ring: Column) -> Column:
    """Unsigned shoelace area in square degrees, about the first vertex."""
    x0, y0 = F.get(F.get(ring, F.lit(0)), F.lit(0)), F.get(F.get(ring, F.lit(0)), F.lit(1))
    cross = lambda e: (e["x1"] - x0) * (e["y2"] - y0) - (e["x2"] - x0) * (e["y1"] - y0)
    return F.abs(F.aggregate(ring_edges(ring), F.lit(0.0), lambda acc, e: acc + cross(e))) / 2


def polygon_area(polygon: Column) -> Column:
    """The outer ring's area less that of its holes."""
    return F.aggregate(polygon, F.lit(0.0), lambda acc, r: acc + ring_area(r)) * -1 + 2 * ring_area(F.get(polygon, F.lit(0)))


def square_miles(area: Column) -> Column:
    return F.round(area / F.lit(MILE_LAT * MILE_LON), 3)


def covers(polygon: Column, x: Column, y: Column) -> Column:
    """Whether a polygon (with holes) covers a point; its border counts."""
    edges = F.flatten(F.transform(polygon, ring_edges))

    def on(e: Column) -> Column:
        level = (e["x2"] - e["x1"]) * (y - e["y1"]) == (e["y2"] - e["y1"]) * (x - e["x1"])
        return level & x.between(F.least(e["x1"], e["x2"]), F.greatest(e["x1"], e["x2"])) & y.between(
            F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
        )

    def crosses(e: Column) -> Column:
        at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
        return ((e["y1"] > y) != (e["y2"] > y)) & F.coalesce(x < at, F.lit(False))

    return F.exists(edges, on) | (F.size(F.filter(edges, crosses)) % 2 == 1)


def outer_rings(multipolygon: Column) -> Column:
    """First ring of each part."""
    return F.transform(multipolygon, lambda p: F.get(p, F.lit(0)))


def bounds(ring: Column) -> dict[str, Column]:
    """west, south, east, north of a ring."""
    xs, ys = F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
    return {"west": F.array_min(xs), "south": F.array_min(ys), "east": F.array_max(xs), "north": F.array_max(ys)}
