"""Flat tables of published grids: CSV in and out, with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

V1 = "chi_ordinate string, chi_id string, name string, label string, center_lat double, center_lon double"
V2 = (
    "chi_ordinate string, chi_id string, name string, label string, name_canon string, label_canon string, "
    "center_lat double, center_lon double, area_sqmi double, edge boolean"
)


def read_grid_csv(spark: SparkSession, path: str, version: int = 1) -> DataFrame:
    """A published table; for version 2 with ``flag``, which the table leaves out."""
    found = spark.read.schema(V1 if version == 1 else V2).option("header", True).csv(path)
    return found if version == 1 else found.withColumn("flag", ~F.col("edge") & ~F.col("area_sqmi").between(0.9, 1.1))


def flat_grid(cells: DataFrame, version: int = 1) -> DataFrame:
    """The flat columns of cells: no geometry, latitude before longitude, sorted by id."""
    center = [F.round("lat", 6).alias("center_lat"), F.round("lon", 6).alias("center_lon")]
    names = ["chi_ordinate", "chi_id", "name", "label"]
    columns = [*names, *center] if version == 1 else [*names, "name_canon", "label_canon", *center, "area_sqmi", "edge"]
    return cells.select(*columns).orderBy("chi_id")


def write_grid_csv(cells: DataFrame, path: str, version: int = 1) -> None:
    flat = flat_grid(cells, version)
    if version == 2:
        flat = flat.withColumn("edge", F.when(F.col("edge"), "True").otherwise("False"))
    flat.write.option("header", True).csv(path)
