"""Whole flows: regular grids, street-aligned grids, and summaries over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.constants import DEFAULT_EXTENT, EXTEND
from quadrille.functions.coords import cell_id, center_out, ordinate
from quadrille.operators import lines, overlay, roads
from quadrille.operators.arrangement import dissolved
from quadrille.operators.lattice import clip_lattice, extent_of, lattice, with_rings
from quadrille.operators.regions import label_regions
from quadrille.sources.geojson import polygon_edges
from quadrille.sources.shared import Written


def regular_grid(
    spark: SparkSession,
    boundary: DataFrame | None = None,
    centerlines: DataFrame | None = None,
    regions: tuple[DataFrame, DataFrame] | None = None,
    dialect: str = "full",
    ns_phase: float = 0.5,
    ew_phase: float = 0.5,
) -> DataFrame:
    """Square cells over a boundary (edges x1, y1, x2, y2) or, without one, over the default extent.

    Cells are named from centerlines where these reach, else by band, and
    unnamed ones by the first of ``regions`` (regions, edges) that they meet.
    An empty boundary gives no cells.
    """
    extent = DEFAULT_EXTENT if boundary is None else extent_of(boundary)
    cells = lattice(spark, extent or DEFAULT_EXTENT, ns_phase, ew_phase)
    if boundary is not None:
        cells = clip_lattice(cells, boundary, ns_phase, ew_phase)
    named = None
    if centerlines is not None:
        named = roads.nearest_roads(cells, roads.road_records(roads.road_vertices(centerlines)))
    cells = roads.name_cells(cells, named, dialect)
    if regions is not None:
        cells = label_regions(cells, *regions)
    return with_rings(cells).withColumn("center", center_out(F.col("lat"), F.col("lon")))


def street_lines(centerlines: DataFrame, extend: int = EXTEND) -> DataFrame:
    """Every grid line: fitted, interpolated, extended."""
    spark = centerlines.sparkSession
    anchor = lines.anchors(spark)
    vertices = lines.anchor_vertices(roads.road_vertices(centerlines, skip_classes=False), anchor)
    # At most a line per anchor: fitted once, then carried as rows.
    fits = lines.fit_lines(vertices, anchor)
    fitted = lines.complete_lines(spark.createDataFrame(fits.collect(), fits.schema))
    lines.check_lines(fitted)
    return lines.extend_lines(fitted, extend)


def street_grid(boundary: DataFrame, centerlines: DataFrame, extend: int = EXTEND, close: float = 0.0, dissolve: bool = False) -> DataFrame:
    """Cells bounded by the lines of real roads, clipped to a boundary (part, polygon).

    Parts of the boundary that adjoin or overlap are one, seams are closed, and
    holes filled.  With ``close`` (the published method has CLOSE_DEGREES) gaps, inlets
    and holes narrower than twice that are closed first, which rounds inner corners.
    With ``dissolve`` a cell's geometry has no lines between its faces.
    """
    outlines = overlay.outline_parts(boundary, close=close)
    faces = overlay.overlay_faces(outlines, street_lines(centerlines, extend))
    if dissolve:
        faces = Written(faces.sparkSession, "faces").save(faces, "faces")
    cells = overlay.merge_faces(faces)
    if dissolve:
        cells = cells.drop("geometry").join(overlay.dissolve_faces(faces), "chi_ordinate")
    cells = overlay.cell_attributes(overlay.area_flags(cells))
    named = roads.nearest_roads(cells, roads.road_records(roads.road_vertices(centerlines)))
    return roads.dual_names(cells, named)


def profiles(cells: DataFrame) -> DataFrame:
    return cells.select("chi_id", "name", "chi_ordinate", "label")


def ordinate_counts(points: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(chi_ordinate, chi_id, n) of points by arithmetic alone: one scan, one aggregation with map-side combine."""
    keyed = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(ordinate(F.col(lat), F.col(lon)).alias("chi_ordinate"))
    counted = keyed.groupBy("chi_ordinate").agg(F.count("*").alias("n"))
    return counted.select("chi_ordinate", cell_id(F.col("chi_ordinate")).alias("chi_id"), "n")


def boundary_edges(boundary: DataFrame) -> DataFrame:
    """Edges of the union of a boundary's polygons (part, polygon), which may overlap and cross themselves."""
    whole = dissolved(boundary.select(F.lit(0).alias("all"), F.monotonically_increasing_id().alias("owner"), "polygon"), ["all"])
    return polygon_edges(whole, "part").drop("part")
