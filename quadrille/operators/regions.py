"""Named regions whose unnamed cells get a local grid label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.constants import OHARE, PREFIX
from quadrille.functions.coords import band, miles_south, miles_west
from quadrille.operators.arrangement import meeting
from quadrille.operators.lattice import cells_meeting
from quadrille.sources.geojson import polygon_edges


def region_label(region: Column, n_origin: Column, w_origin: Column, lat: Column, lon: Column) -> Column:
    """``{region}-{row}{column}``: rows from the region's northern band, columns from its western one."""
    row = n_origin - (band(miles_south(lat)) + 1) + 1
    column = F.char(F.lit(65) + w_origin - (band(miles_west(lon)) + 1))
    return F.concat(region, F.lit("-"), row.cast("string"), column)


def label_regions(cells: DataFrame, regions: DataFrame, edges: DataFrame) -> DataFrame:
    """``cells`` with the names and labels of the first region, by order, that meets a cell named by its ordinate.

    ``regions``: region_order, region, n_origin, w_origin; ``edges``: region_order
    and the edges of its polygon.  Lattice cells only (ks, kw).
    """
    unnamed = cells.where(F.startswith("name", F.lit(PREFIX)))
    met = cells_meeting(unnamed, edges, "region_order").groupBy("ks", "kw").agg(F.min("region_order").alias("region_order"))
    named = met.join(regions, "region_order").select("ks", "kw", "region", "n_origin", "w_origin")
    center = [F.round("lat", 6), F.round("lon", 6)]
    label = region_label(F.col("region"), F.col("n_origin"), F.col("w_origin"), *center)
    joined = cells.join(named, ["ks", "kw"], "left")
    for c in ("name", "label"):
        joined = joined.withColumn(f"__{c}", F.when(F.startswith("name", F.lit(PREFIX)) & F.col("region").isNotNull(), label).otherwise(F.col(c)))
    return joined.select(*[F.col(f"__{c}").alias(c) if c in ("name", "label") else F.col(c) for c in cells.columns])


def label_shapes(cells: DataFrame, regions: DataFrame, polygons: DataFrame) -> DataFrame:
    """As :func:`label_regions`, for cells of any shape.

    ``cells``: chi_id, lat, lon (its center), name, label, geometry (a multipolygon);
    ``polygons``: region_order and a polygon of the region.
    """
    unnamed = cells.where(F.startswith("name", F.lit(PREFIX))).select(F.col("chi_id").alias("a"), F.explode("geometry").alias("polygon"))
    met = meeting(unnamed, polygons.select(F.col("region_order").alias("b"), "polygon")).groupBy(F.col("a").alias("chi_id")).agg(F.min("b").alias("region_order"))
    label = region_label(F.col("region"), F.col("n_origin"), F.col("w_origin"), F.round("lat", 6), F.round("lon", 6))
    own = met.join(regions, "region_order").join(cells.select("chi_id", "lat", "lon"), "chi_id").select("chi_id", label.alias("own"))
    joined = cells.join(own, "chi_id", "left")
    return joined.select(*[F.coalesce("own", c).alias(c) if c in ("name", "label") else F.col(f"`{c}`") for c in cells.columns])


def airport_members(areas: DataFrame) -> DataFrame:
    """Community areas of the airport: by id (the first of two that isn't missing) or by name, with a geometry."""
    kinds = dict(areas.dtypes)

    def some(c: str) -> Column:
        missing = F.lit("") if kinds[c] == "string" else F.lit(0)
        return F.nullif(F.col(c), missing).cast("string")

    ident = F.coalesce(some("community_area_id"), some("community_area_number"), F.lit(""))
    named = F.lower(F.coalesce(F.col("name"), F.lit(""))).contains(OHARE["like"])
    return areas.where(((ident == OHARE["area_id"]) | named) & F.col("geometry").isNotNull())


def airport_region(areas: DataFrame, order: int = 1) -> tuple[DataFrame, DataFrame]:
    """(regions, edges) of the airport, as :func:`label_regions` takes them; both empty without a member.

    ``areas``: community_area_id, community_area_number, name, geometry (a
    polygon).  Members are joined side by side: an edge that two of them share
    counts for both, and so cancels out.
    """
    members = airport_members(areas)
    some = members.limit(1).select(
        F.lit(order).alias("region_order"), F.lit(OHARE["name"]).alias("region"), F.lit(OHARE["n_origin"]).alias("n_origin"), F.lit(OHARE["w_origin"]).alias("w_origin")
    )
    edges = polygon_edges(members.select(F.lit(order).alias("region_order"), F.col("geometry").alias("polygon")), "region_order")
    return some, edges
