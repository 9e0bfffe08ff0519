"""Points, places, roads and polygons derived from the driver's tables.

The expressions use IEEE basic operations alone, so any engine gives the same
bits; the same text serves Spark and the SQL that checks it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.functions.coords import miles_south, miles_west
from quadrille.sources.geojson import polygon_edges

POINT = {
    "lat": "4.162e1 + CAST((event_id * 7919) % 10007 AS DOUBLE) / 1.0007e4 * 4.4e-1",
    "lon": "-8.795e1 + CAST((event_id * 104729) % 10009 AS DOUBLE) / 1.0009e4 * 4.5e-1",
}
CATEGORY = "CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 13 = 0 THEN '' ELSE event_type END"
PLACE_NAME = "CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(user_id % 50 AS VARCHAR(20)) END"
PLACE_LAT = f"CASE WHEN event_id % 29 = 0 THEN NULL ELSE {POINT['lat']} END"

#: Road number, street name, class.
ROADS = [
    (0, "Racine Ave", "2"), (1, "43rd St", "2"), (2, "DAMEN AVE", "3"), (3, "35th St", "2"), (4, "California Ave", "2"),
    (5, "Division St", "2"), (6, "Kostner", "4"), (7, "Armitage Ave", "2"), (8, " Laramie Avenue ", "2"), (9, "Addison St", "2"),
    (10, "State St", "2"), (11, "Madison St", "2"), (12, "Woodlawn Ave", "2"), (13, "63rd St", "3"), (14, "Jeffery Blvd", "2"),
    (15, "North Ave", "2"), (16, "Broadway", "2"), (17, "Foster Ave", "2"), (18, "Halsted St", "2"), (19, "Peterson", "2"),
    (20, "Clark St", "2"), (21, "Howard St", "2"), (22, "Foo Bar Rd", "4"), (23, "75th St", "2"), (24, "McClurg Ct", "4"),
    (25, "103rd St", "2"), (26, "O'Hare Way", "4"), (27, "Irving Park Rd", "2"), (28, "Sheridan Rd", "2"), (29, "Touhy Ave", "2"),
    (30, "Avenue L", "4"), (31, "87th St", "2"), (32, "Long Ave", None), (33, "Grand Ave", "2"), (34, "Lake Shore Dr", "1"),
    (35, "Kinzie St", "2"), (36, "Ashland Ave", "2"), (37, "Main St", "4"), (38, "North Branch", "RIV"), (39, "59th Place", "4"),
]
_T = "CAST((l_orderkey * 31 + l_linenumber * 17) % 1000 AS DOUBLE) / 1e3"
_U = "(CAST((l_orderkey * 7 + l_linenumber * 3) % 11 AS DOUBLE) / 1e1 - 5e-1)"
_R = "CAST(l_partkey % 40 AS DOUBLE)"
_RUN = f"{_T} * (4e-1 + CAST(l_partkey % 40 % 5 AS DOUBLE) * 1.5e-1)"
ROAD_LAT = f"CASE WHEN l_partkey % 2 = 0 THEN 4.164e1 + 4e-1 * {_RUN} ELSE 4.165e1 + {_R} * 9.5e-3 + {_U} * 2e-3 + {_T} * 1e-3 END"
ROAD_LON = f"CASE WHEN l_partkey % 2 = 0 THEN -8.79e1 + {_R} * 9e-3 + {_U} * 2e-3 + {_T} * 1e-3 ELSE -8.79e1 + 3.6e-1 * {_RUN} END"
ROAD_SEQ = "l_orderkey * 10 + l_linenumber"

#: Lines of a few indices by nation, the others missing.
FIT = {
    "axis": "CASE WHEN n_nationkey % 2 = 0 THEN 'ns' ELSE 'ew' END",
    "idx": "n_nationkey - n_nationkey % 2 - 11",
    "slope": "CAST(n_nationkey * 7 % 11 AS DOUBLE) * 1e-3 - 5e-3",
    "intercept": "CASE WHEN n_nationkey % 2 = 0 THEN -8.8e1 + CAST(n_nationkey AS DOUBLE) * 3e-2 ELSE 4.1e1 + CAST(n_nationkey AS DOUBLE) * 1e-2 END",
}
FITTED = "n_nationkey % 5 <> 3"
#: Area and distance of a face by supplier, some of them on the bounds of the tolerances.
FACE = {
    "face_id": "CAST(s_suppkey AS INTEGER)",
    "sqmi": "8.5e-1 + CAST(s_suppkey * 37 % 300 AS DOUBLE) / 1e3",
    "near": "CASE s_suppkey % 3 WHEN 0 THEN 1e-5 WHEN 1 THEN 5e-1 ELSE CAST(s_suppkey % 7 AS DOUBLE) / 1e5 END",
}
#: Where customers ask: within, outside, on borders, nowhere.
LOOKUP = {
    "lat": "CASE c_custkey % 7 WHEN 0 THEN 4.188197e1 WHEN 1 THEN NULL ELSE 4.1e1 + CAST(c_custkey * 7919 % 10007 AS DOUBLE) / 1.0007e4 END",
    "lon": "CASE c_custkey % 5 WHEN 0 THEN -8.762768e1 ELSE -8.8e1 + CAST(c_custkey * 104729 % 10009 AS DOUBLE) / 1.0009e4 END",
}
#: Roads by part: plain, lettered, numbered, and two whose tokens are fixed.
PART_ROAD = """CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 1 THEN 'Avenue ' || upper(left(p_name, 1)) WHEN 2 THEN CAST(p_partkey % 150 AS VARCHAR(9)) || 'th ' || p_name
ELSE CASE WHEN p_partkey % 3 = 0 THEN 'Division' ELSE 'Diversey' END END"""
#: Lines that cut the convex outline, by nation.
CUT = {"ns": (8, 0.02, "-8.8665e1 + 3e-2 * CAST(n_nationkey AS DOUBLE)"), "ew": (9, -0.015, "4.043e1 + 2.5e-2 * CAST(n_nationkey AS DOUBLE)")}

#: A concave hexagon, by offsets from a nation's corner.
HEXAGON = [(0.0, 0.0), (0.08, 0.0), (0.08, 0.07), (0.04, 0.03), (0.02, 0.07), (0.0, 0.05)]
CORNER_X = "-8.79e1 + CAST(n_nationkey % 5 AS DOUBLE) * 7e-2"
CORNER_Y = "4.165e1 + CAST((n_nationkey - n_nationkey % 5) AS DOUBLE) * 1.2e-2"

#: A concave outline over the middle of the extent, open.
CITY = [(-87.82, 41.72), (-87.61, 41.70), (-87.56, 41.79), (-87.66, 41.83), (-87.59, 41.93), (-87.70, 42.01), (-87.74, 41.90), (-87.86, 41.95)]
#: Order, name, box (south, north, west, east), bands that begin rows and columns.
REGIONS = [(1, "Loop", (41.871, 41.9001, -87.6601, -87.6001), 3, 4), (2, "Park", (41.8301, 41.8899, -87.9201, -87.6401), 9, 17)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", *[F.expr(e).alias(c) for c, e in POINT.items()])


def point_extent(spark: SparkSession, sf_dir: str) -> tuple[float, float, float, float]:
    """South, north, west, east of the points."""
    return tuple(points(spark, sf_dir).agg(F.min("lat"), F.max("lat"), F.min("lon"), F.max("lon")).first())


def seen(cells: DataFrame, sf_dir: str) -> DataFrame:
    """The cells (ks, kw) of square miles that have a point."""
    spots = points(cells.sparkSession, sf_dir).select(F.floor(miles_south(F.col("lat"))).alias("ks"), F.floor(miles_west(F.col("lon"))).alias("kw"))
    return cells.join(spots.distinct(), ["ks", "kw"], "left_semi")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("poi_id"),
        F.expr(CATEGORY).alias("category"),
        F.expr(PLACE_NAME).cast("string").alias("name"),
        F.expr(PLACE_LAT).alias("lat"),
        F.expr(POINT["lon"]).alias("lng"),
    )


def centerlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, street_name, class, points: one vertex a row."""
    named = spark.createDataFrame(ROADS, "r bigint, street_name string, class string")
    rows = table(spark, sf_dir, "lineitem").select(
        (F.col("l_partkey") % 40).alias("r"),
        F.expr(ROAD_SEQ).alias("seq"),
        F.array(F.array(F.expr(ROAD_LON), F.expr(ROAD_LAT))).alias("points"),
    )
    return rows.join(named, "r").drop("r")


def nation_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_nationkey, geometry (polygon)."""
    x, y = F.expr(CORNER_X), F.expr(CORNER_Y)
    ring = F.array(*[F.array(x + F.lit(dx), y + F.lit(dy)) for dx, dy in [*HEXAGON, HEXAGON[0]]])
    return table(spark, sf_dir, "nation").select("n_nationkey", F.array(ring).alias("geometry"))


def nation_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return polygon_edges(nation_polygons(spark, sf_dir).withColumnRenamed("geometry", "polygon"), "n_nationkey").drop("n_nationkey")


def box_ring(south: float, north: float, west: float, east: float) -> list[tuple[float, float]]:
    return [(west, south), (east, south), (east, north), (west, north)]


def ring_edges(spark: SparkSession, rings: dict[int, list[tuple[float, float]]], owner: str) -> DataFrame:
    rows = [(k, *a, *b) for k, ring in rings.items() for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)]
    return spark.createDataFrame(rows, f"{owner} int, x1 double, y1 double, x2 double, y2 double")
