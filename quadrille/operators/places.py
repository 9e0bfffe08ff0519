"""Places of interest by cell: ids in order, featured ids, counts by category."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrille.constants import FEATURED
from quadrille.operators.locate import cover_index, locate


def assign_places(places: DataFrame, cells: DataFrame, squares: bool = False, lat: str = "lat", lon: str = "lng") -> DataFrame:
    """Places inside a cell, with ``chi_id``: the first cell, by id, that covers them."""
    index = cover_index(cells, "chi_id", ["chi_id"])
    found = locate(places.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()), index, lat, lon, squares, inside_only=True)
    return found.withColumn("chi_id", F.col("cell.chi_id")).drop("cell")


def ranked_places(assigned: DataFrame) -> DataFrame:
    """Assigned places with ``rank`` in their cell: by category, name and id, missing as empty.

    One row per place, sorted and spilled by Spark, however many a cell has.
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    order = Window.partitionBy("chi_id").orderBy(blank("category"), blank("name"), blank("poi_id"), F.col("poi_id").asc_nulls_last())
    return assigned.withColumn("rank", F.row_number().over(order))


def category_counts(assigned: DataFrame) -> DataFrame:
    """(chi_id, category, n) for categories that are neither null nor empty."""
    return assigned.where(F.coalesce("category", F.lit("")) != "").groupBy("chi_id", "category").agg(F.count("*").alias("n"))


def summarise_places(cells: DataFrame, places: DataFrame, squares: bool = False, featured: int = FEATURED) -> DataFrame:
    """One row per cell with a geometry: chi_id, name, place_ids, featured_place_ids, counts_by_category.

    Cells without places have empty arrays and maps.  A place without an id is
    listed as null.
    """
    assigned = assign_places(places, cells, squares)
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    listed = assigned.groupBy("chi_id").agg(
        F.array_sort(F.collect_list(F.struct(blank("category").alias("c"), blank("name").alias("n"), blank("poi_id").alias("p"), "poi_id"))).alias("l")
    )
    listed = listed.select("chi_id", F.transform("l", lambda x: x["poi_id"]).alias("ids"))
    counted = category_counts(assigned).groupBy("chi_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("counts")
    )
    return (
        cells.where(F.col("geometry").isNotNull())
        .select("chi_id", "name")
        .join(listed, "chi_id", "left")
        .join(counted, "chi_id", "left")
        .select(
            "chi_id",
            "name",
            F.coalesce("ids", F.array().cast("array<string>")).alias("place_ids"),
            F.slice(F.coalesce("ids", F.array().cast("array<string>")), 1, featured).alias("featured_place_ids"),
            F.coalesce("counts", F.create_map().cast("map<string,bigint>")).alias("counts_by_category"),
        )
    )


def featured_places(assigned: DataFrame, most: int = FEATURED) -> DataFrame:
    """The first ``most`` places of each cell; the bound is applied before rows meet (group limit)."""
    return ranked_places(assigned).where(F.col("rank") <= most)
