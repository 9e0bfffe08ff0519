"""Coordinates, miles, bands and ordinates as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrille.constants import BAND_SLACK, MILE_LAT, MILE_LON, ORIGIN_LAT, ORIGIN_LON, PREFIX


def miles_south(lat: Column) -> Column:
    """Miles south of the origin; north is negative."""
    return (F.lit(ORIGIN_LAT) - lat) / F.lit(MILE_LAT)


def miles_west(lon: Column) -> Column:
    """Miles west of the origin; east is negative."""
    return (F.lit(ORIGIN_LON) - lon) / F.lit(MILE_LON)


def lat_at(miles: Column) -> Column:
    return F.lit(ORIGIN_LAT) - miles * F.lit(MILE_LAT)


def lon_at(miles: Column) -> Column:
    return F.lit(ORIGIN_LON) - miles * F.lit(MILE_LON)


def band(miles: Column) -> Column:
    """Whole miles from the origin on one side; null for NaN."""
    return F.floor(F.abs(F.nanvl(miles, F.lit(None).cast("double"))) + F.lit(BAND_SLACK))


def ordinate(lat: Column, lon: Column) -> Column:
    """For instance ``χ:5S3W``: bands from 1, and the sides; an exact zero is south and west."""
    s, w = miles_south(lat), miles_west(lon)
    return F.concat(
        F.lit(PREFIX),
        (band(s) + 1).cast("string"),
        F.when(s >= 0, "S").otherwise("N"),
        (band(w) + 1).cast("string"),
        F.when(w >= 0, "W").otherwise("E"),
    )


def cell_id(ord_: Column) -> Column:
    """The ordinate without its prefix."""
    return F.replace(ord_, F.lit(PREFIX), F.lit(""))


def center_out(lat: Column, lon: Column) -> Column:
    """[lon, lat] to six places."""
    return F.array(F.round(lon, 6), F.round(lat, 6))
