import math
import random
import re

import pytest
from pyspark.sql import functions as F

from quadrille import constants as C
from quadrille.functions.coords import band, cell_id, ordinate
from quadrille.functions.geometry import covers, polygon_area, square, square_miles
from quadrille.functions.names import FULL, SIMPLE, base_road_name, name_and_label, pretty_road_name, short_token


def spot(south, west):
    """The point so many miles south and west of the origin."""
    return C.ORIGIN_LAT - south * C.MILE_LAT, C.ORIGIN_LON - west * C.MILE_LON


def test_ordinates(spark):
    cases = [
        ((0, 0), "χ:1S1W"), ((0.5, -0.5), "χ:1S1E"), ((-0.5, 0.5), "χ:1N1W"), ((-0.5, -0.5), "χ:1N1E"),
        ((4.5, 2.5), "χ:5S3W"), ((1 - 1e-10, 0.5), "χ:2S1W"), ((0.99, -4.01), "χ:1S5E"),
    ]
    df = spark.createDataFrame([(i, *spot(*p)) for i, (p, _) in enumerate(cases)], "i int, lat double, lon double")
    found = {r["i"]: r["o"] for r in df.select("i", ordinate(F.col("lat"), F.col("lon")).alias("o")).collect()}
    assert [found[i] for i in range(len(cases))] == [o for _, o in cases]
    row = df.limit(1).select(cell_id(F.lit("χ:5S3W")), band(F.lit(float("nan"))), band(F.lit(-2.5)), ordinate(F.lit(None).cast("double"), F.lit(1.0))).first()
    assert tuple(row) == ("5S3W", None, 2, None)


def test_worked_names(spark):
    df = spark.createDataFrame([(*spot(4.5, 2.5),), (*spot(0.5, 0.5),), (*spot(40.5, 2.5),), (*spot(-1.5, 1.5),), (*spot(8.5, -4.5),)], "lat double, lon double")

    def of(dialect):
        name, label = name_and_label(F.col("lat"), F.col("lon"), dialect)
        return [tuple(r) for r in df.select(name, label).collect()]

    assert of(FULL) == [
        ("Damen–43rd chi", "Dam43"), ("River–Congress chi", "RivCon"), ("χ:41S3W chi", "χ:41S3W"), ("Racine–Division chi", "RacDivi"), ("Avenue L–75th chi", "L75"),
    ]
    assert of(SIMPLE)[1:] == [("χ:1S1W chi", "χ:1S1W"), ("χ:41S3W chi", "χ:41S3W"), ("Racine–Division chi", "RacDiv"), ("Avenue L–75th chi", "Ave75")]


def test_mile_roads_never_name_a_band():
    assert not {*C.MILE_ROADS_NS, *C.MILE_ROADS_EW} & {*C.AVENUES_WEST, *C.AVENUES_EAST, *C.STREETS_SOUTH, *C.STREETS_NORTH}


def test_tokens_and_road_names(spark):
    words = ["Avenue O", "Avenue O East", "43rd", "1st St", "Ashland", "Division", "Diversey", "Oak Park"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert [r[0] for r in df.select(short_token(F.col("w"))).collect()] == ["O", "Ave", "43", "1", "Ash", "Divi", "Dive", "Oak"]
    given = ["  N Damen AVE ", "Broadway", "Park Place Court", "AVE", " ave ", None, "", "Lake\tShore\tDR", "Main St.", "4th Way way"]
    want = ["n damen", "broadway", "park place", "ave", "ave", "", "", "lake\tshore", "main st.", "4th way"]
    df = spark.createDataFrame([(w,) for w in given], "w string")
    assert [r[0] for r in df.select(base_road_name(F.col("w"))).collect()] == want


def test_pretty_names_follow_title_case(spark):
    draw = random.Random(3)
    parts = ["mc", "mcd", "st", "nd", "rd", "th", "1", "43", "o", "'", "-", " ", "_", "é", "lake", "x3"]
    given = sorted({"".join(draw.choice(parts) for _ in range(draw.randint(1, 5))) for _ in range(300)})

    def brute(s):
        s = re.sub(r"(\d)(St|Nd|Rd|Th)\b", lambda m: m[1] + m[2].lower(), s.title())
        return re.sub(r"\bMc([a-z])", lambda m: "Mc" + m[1].upper(), s)

    df = spark.createDataFrame([(w,) for w in given], "w string")
    found = {r[0]: r[1] for r in df.select("w", pretty_road_name(F.col("w"))).collect()}
    assert found == {w: brute(w) for w in given}


def test_square_and_area(spark):
    lat, lon = F.lit(41.8), F.lit(-87.6)
    ring = square(lat, lon)
    hole = F.array(*[F.array(lon + dx * C.MILE_LON, lat + dy * C.MILE_LAT) for dx, dy in ((-0.25, -0.25), (0.25, -0.25), (0.25, 0.25), (-0.25, 0.25), (-0.25, -0.25))])
    row = spark.range(1).select(ring, square_miles(polygon_area(F.array(ring))), square_miles(polygon_area(F.array(ring, hole)))).first()
    assert row[0][0] == row[0][4] and len(row[0]) == 5 and row[1:] == (1.0, 0.75)


def test_covers_counts_borders_and_leaves_holes_out(spark):
    shape = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [2.0, 1.0], [0.0, 4.0], [0.0, 0.0]], [[0.5, 0.2], [1.0, 0.2], [1.0, 0.6], [0.5, 0.2]]]
    spots = [(1, 1, True), (2, 3, False), (2, 1, True), (2, 0, True), (5, 1, False), (0, 4, True), (0.9, 0.3, False), (1.0, 0.4, True), (-1, 0, False), (3, 2.5, True)]
    df = spark.createDataFrame([(float(x), float(y), w) for x, y, w in spots], "x double, y double, want boolean")
    poly = F.array(*[F.array(*[F.array(*[F.lit(v) for v in p]) for p in r]) for r in shape])
    assert df.where(covers(poly, F.col("x"), F.col("y")) != F.col("want")).collect() == []


def test_scale():
    assert math.isclose(C.MILE_LON, 0.019465858829477576) and C.MILE_LAT == pytest.approx(1 / 69)
