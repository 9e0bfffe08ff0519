"""The grid over streams: ordinates are column expressions, so streams need no operator of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.functions.coords import cell_id, ordinate


def windowed_counts(points: DataFrame, time: str, window: str, late: str, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(window, chi_id, n) of a stream of points; state of windows older than ``late`` is dropped."""
    keyed = points.withWatermark(time, late).withColumn("chi_id", cell_id(ordinate(F.col(lat), F.col(lon))))
    return keyed.groupBy(F.window(time, window).alias("window"), "chi_id").agg(F.count("*").alias("n"))
