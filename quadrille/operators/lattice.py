"""The regular lattice of square cells, and which cells meet polygons."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.constants import DEFAULT_EXTENT, MILE_LAT, MILE_LON, ORIGIN_LAT, ORIGIN_LON
from quadrille.functions.coords import cell_id, lat_at, lon_at, miles_south, miles_west, ordinate
from quadrille.functions.geometry import square


def lattice(
    spark: SparkSession,
    extent: tuple[float, float, float, float] = DEFAULT_EXTENT,
    ns_phase: float = 0.5,
    ew_phase: float = 0.5,
) -> DataFrame:
    """Cells over an extent (south, north, west, east), padded by one cell on each side.

    Columns ks, kw (steps from the origin), lat, lon (center), chi_ordinate,
    chi_id.  With other phases than one half two cells can share an ordinate:
    the first by (ks, kw) stays.
    """
    south, north, west, east = extent
    s_lo = math.floor((ORIGIN_LAT - north) / MILE_LAT - ns_phase) - 1
    s_hi = math.ceil((ORIGIN_LAT - south) / MILE_LAT - ns_phase) + 1
    w_lo = math.floor((ORIGIN_LON - east) / MILE_LON - ew_phase) - 1
    w_hi = math.ceil((ORIGIN_LON - west) / MILE_LON - ew_phase) + 1
    cells = (
        spark.range(s_lo, s_hi + 1)
        .select(F.col("id").alias("ks"), F.explode(F.sequence(F.lit(w_lo).cast("long"), F.lit(w_hi).cast("long"))).alias("kw"))
        .withColumn("lat", lat_at(F.lit(ns_phase) + F.col("ks")))
        .withColumn("lon", lon_at(F.lit(ew_phase) + F.col("kw")))
        .withColumn("chi_ordinate", ordinate(F.col("lat"), F.col("lon")))
    )
    if (ns_phase, ew_phase) != (0.5, 0.5):
        first = F.min_by(F.struct("ks", "kw", "lat", "lon"), F.struct("ks", "kw")).alias("c")
        cells = cells.groupBy("chi_ordinate").agg(first).select("c.*", "chi_ordinate")
    return cells.withColumn("chi_id", cell_id(F.col("chi_ordinate")))


def extent_of(edges: DataFrame) -> tuple[float, float, float, float] | None:
    """(south, north, west, east) of edges x1, y1, x2, y2; None if there are none."""
    row = edges.agg(
        F.min(F.least("y1", "y2")).alias("s"),
        F.max(F.greatest("y1", "y2")).alias("n"),
        F.min(F.least("x1", "x2")).alias("w"),
        F.max(F.greatest("x1", "x2")).alias("e"),
    ).first()
    return None if row["s"] is None else (row["s"], row["n"], row["w"], row["e"])


def _segment_meets_box(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Whether the segment x1,y1-x2,y2 meets a closed box: its range of parameters inside isn't empty."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    lo, hi, inside = F.lit(0.0), F.lit(1.0), F.lit(True)
    for d, at, low, high in ((dx, F.col("x1"), west, east), (dy, F.col("y1"), south, north)):
        a, b = (low - at) / F.nullif(d, F.lit(0.0)), (high - at) / F.nullif(d, F.lit(0.0))
        lo = F.greatest(lo, F.least(a, b))  # nulls, of level segments, are skipped
        hi = F.least(hi, F.greatest(a, b))
        inside &= (d != 0) | at.between(low, high)
    return inside & (lo <= hi)


def cells_meeting(cells: DataFrame, edges: DataFrame, owner: str = "owner", ns_phase: float = 0.5, ew_phase: float = 0.5) -> DataFrame:
    """Pairs (ks, kw, owner) of lattice cells and polygons that meet; touching counts.

    ``edges`` has the polygon's owner and its edges, those of holes included.
    Edges go to the rows and cells that their boxes reach, by equi-join on the
    lattice steps.  A cell meets a polygon if an edge meets the cell, or if its
    center lies inside by parity of the crossings in its row.
    """
    s = F.struct(miles_south(F.greatest("y1", "y2")).alias("lo"), miles_south(F.least("y1", "y2")).alias("hi"))
    w = F.struct(miles_west(F.greatest("x1", "x2")).alias("lo"), miles_west(F.least("x1", "x2")).alias("hi"))
    step = lambda miles, phase, slack: F.floor(miles - F.lit(phase - 0.5) + F.lit(slack))
    rows = edges.withColumn("s", s).withColumn("w", w)
    rows = rows.withColumn("ks", F.explode(F.sequence(step(F.col("s.lo"), ns_phase, -1e-6), step(F.col("s.hi"), ns_phase, 1e-6))))
    near = rows.withColumn("kw", F.explode(F.sequence(step(F.col("w.lo"), ew_phase, -1e-6), step(F.col("w.hi"), ew_phase, 1e-6))))
    box = [F.col("lon") - F.lit(MILE_LON / 2), F.col("lat") - F.lit(MILE_LAT / 2), F.col("lon") + F.lit(MILE_LON / 2), F.col("lat") + F.lit(MILE_LAT / 2)]
    place = cells.select("ks", "kw", "lat", "lon")
    touched = near.join(place, ["ks", "kw"]).where(_segment_meets_box(*box)).select("ks", "kw", owner)

    straddles = (F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))
    at = F.col("x1") + (F.col("lat") - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.nullif(F.col("y2") - F.col("y1"), F.lit(0.0))
    inside = (
        rows.join(place, "ks")
        .where(straddles & (F.col("lon") < at))
        .groupBy("ks", "kw", owner)
        .agg((F.count("*") % 2).alias("odd"))
        .where("odd = 1")
        .select("ks", "kw", owner)
    )
    return touched.unionByName(inside).distinct()


def clip_lattice(cells: DataFrame, edges: DataFrame, ns_phase: float = 0.5, ew_phase: float = 0.5) -> DataFrame:
    """The cells that meet a boundary; none for an empty one."""
    met = cells_meeting(cells, edges.withColumn("owner", F.lit(0)), "owner", ns_phase, ew_phase)
    return cells.join(met.select("ks", "kw"), ["ks", "kw"], "left_semi")


def with_rings(cells: DataFrame) -> DataFrame:
    """Adds ``geometry``, the polygon of each square cell."""
    return cells.withColumn("geometry", F.array(square(F.col("lat"), F.col("lon"))))
