"""Road records from centerline vertices, and naming of cells by the nearest roads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrille import constants as C
from quadrille.functions.coords import miles_south, miles_west, ordinate
from quadrille.functions.names import band_roads, base_road_name, name_and_label, named, pretty_road_name
from quadrille.sources.shared import Written

AVENUE, STREET = "avenue", "street"
CANONICAL, BROAD = 0, 1
#: Degrees by which coordinates are counted on the way to a median; it changes the cost and no row.
MEDIAN_STEP = 0.001
_FIRST, _LAST = -(1 << 62), 1 << 62


def road_vertices(centerlines: DataFrame, skip_classes: bool = True) -> DataFrame:
    """(base, seq, lon, lat) from centerlines seq, street_name, class, points array<array<double>>.

    Roads without a name or points are left out, and with ``skip_classes`` those
    of classes that never name a cell (a missing class is one).
    """
    roads = centerlines.withColumn("base", base_road_name(F.col("street_name"))).where(F.col("base") != "")
    if skip_classes:
        kind = F.trim(F.coalesce(F.col("class").cast("string"), F.lit("")))
        roads = roads.where(~kind.isin(*C.SKIPPED_CLASSES))
    return roads.select("base", "seq", F.explode("points").alias("p")).select(
        "base", "seq", F.col("p")[0].alias("lon"), F.col("p")[1].alias("lat")
    )


def road_spans(vertices: DataFrame) -> DataFrame:
    """One row per road: base, seq (its first), n, lat_lo, lat_hi, lon_lo, lon_hi."""
    return vertices.groupBy("base").agg(
        F.min("seq").alias("seq"),
        F.count("*").alias("n"),
        F.min("lat").alias("lat_lo"),
        F.max("lat").alias("lat_hi"),
        F.min("lon").alias("lon_lo"),
        F.max("lon").alias("lon_hi"),
    )


def road_summary(vertices: DataFrame, step: float = MEDIAN_STEP) -> DataFrame:
    """:func:`road_spans` with med_lon and med_lat: of an even number, the upper of the middle two.

    Medians are selected, not sorted for: coordinates are counted by steps of
    ``step`` degrees, ahead of the shuffle; running sums over a road's steps name the
    one with the middle, which is written, one row a road and side, and only that
    step's values are then counted and ranked.  So a road with most of all vertices
    is no one task's.  A null coordinate comes first and NaN last; a null median
    means a null in the middle.
    """
    sides = F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("v")) for a in ("lon", "lat")])
    place = F.when(F.col("v").isNull(), F.lit(_FIRST)).when(F.isnan("v"), F.lit(_LAST)).otherwise(F.floor(F.col("v") / F.lit(step)))
    values = vertices.select("base", "seq", F.inline(sides)).withColumn("step", place.cast("long"))
    steps = values.groupBy("base", "axis", "step").agg(F.count("*").alias("inside"), F.min("seq").alias("seq"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    side = Window.partitionBy("base", "axis")
    steps = steps.select(
        "base",
        "axis",
        "step",
        "inside",
        F.coalesce(F.sum("inside").over(side.orderBy("step").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("inside").over(side).alias("total"),
        *[f(c).over(side).alias(c) for f, c in ((F.min, "seq"), (F.min, "lo"), (F.max, "hi"))],
    )
    picked = steps.withColumn("middle", F.expr("total div 2 + 1")).where("before < middle and middle <= before + inside")
    # Read again, its size is known: Spark broadcasts it only if it is small.
    picked = Written(vertices.sparkSession, "medians").save(picked, "picked")
    counted = values.select("base", "axis", "step", "v").join(picked.select("base", "axis", "step"), ["base", "axis", "step"], "left_semi")
    counted = counted.groupBy("base", "axis", "step", "v").agg(F.count("*").alias("n"))
    found = picked.join(counted, ["base", "axis", "step"])
    upto = F.col("before") + F.sum("n").over(Window.partitionBy("base", "axis", "step").orderBy("v"))
    found = found.withColumn("med", F.when(upto >= F.col("middle"), F.col("v")))
    of = lambda f, c, axis: f(F.when(F.col("axis") == axis, F.col(c)))
    return found.groupBy("base").agg(
        F.min("seq").alias("seq"),
        F.max("total").alias("n"),
        *[of(f, c, axis).alias(f"{axis}_{c}") for axis in ("lat", "lon") for f, c in ((F.min, "lo"), (F.max, "hi"))],
        *[of(F.min, "med", axis).alias(f"med_{axis}") for axis in ("lon", "lat")],
    )


def upper_medians(vertices: DataFrame) -> DataFrame:
    """(base, med_lon, med_lat)."""
    return road_summary(vertices).select("base", "med_lon", "med_lat")


def canonical_names(spark: SparkSession) -> DataFrame:
    """(axis, base): the bands' roads, and for avenues the diagonals."""
    rows = [(AVENUE, n.lower()) for n in (*C.AVENUES_WEST, *C.AVENUES_EAST, *C.DIAGONALS)]
    rows += [(STREET, n.lower()) for n in (*C.STREETS_SOUTH, *C.STREETS_NORTH)]
    given = spark.createDataFrame(rows, "axis string, name string")
    return given.select("axis", base_road_name(F.col("name")).alias("base")).distinct()


def mile_names(spark: SparkSession) -> DataFrame:
    """(axis, base): roads that bound cells and never name them."""
    rows = [(AVENUE, n) for n in C.MILE_ROADS_NS] + [(STREET, n) for n in C.MILE_ROADS_EW]
    return spark.createDataFrame(rows, "axis string, name string").select("axis", base_road_name(F.col("name")).alias("base"))


def road_records(vertices: DataFrame, broad_miles: float = C.BROAD_MILES) -> DataFrame:
    """Candidates: axis, tier (0 canonical, 1 broad), seq, base, name, med, lo, hi.

    An avenue's ``med`` is a longitude and its ``lo``, ``hi`` are latitudes; a
    street's the other way round.  A road can be a candidate on both axes.
    """
    spark = vertices.sparkSession
    roads = road_summary(vertices)
    lat_span = (F.col("lat_hi") - F.col("lat_lo")) / F.lit(C.MILE_LAT)
    lon_span = (F.col("lon_hi") - F.col("lon_lo")) / F.lit(C.MILE_LON)
    roads = roads.withColumn("lat_span", lat_span).withColumn("lon_span", lon_span).withColumn("name", pretty_road_name(F.col("base")))
    through_av = (F.col("lat_span") >= F.col("lon_span")) & (F.col("lat_span") >= broad_miles)
    through_st = (F.col("lon_span") > F.col("lat_span")) & (F.col("lon_span") >= broad_miles)
    avenue = F.struct(F.lit(AVENUE).alias("axis"), F.col("med_lon").alias("med"), F.col("lat_lo").alias("lo"), F.col("lat_hi").alias("hi"), through_av.alias("through"))
    street = F.struct(F.lit(STREET).alias("axis"), F.col("med_lat").alias("med"), F.col("lon_lo").alias("lo"), F.col("lon_hi").alias("hi"), through_st.alias("through"))
    both = roads.select("seq", "base", "name", F.inline(F.array(avenue, street)))
    canonical = canonical_names(spark).withColumn("tier", F.lit(CANONICAL))
    broad = both.join(canonical, ["axis", "base"], "left_anti").where("through").join(mile_names(spark), ["axis", "base"], "left_anti")
    return (
        both.join(canonical, ["axis", "base"])
        .unionByName(broad.withColumn("tier", F.lit(BROAD)))
        .select("axis", "tier", "seq", "base", "name", "med", "lo", "hi")
    )


def nearest_roads(
    cells: DataFrame,
    records: DataFrame,
    key: str = "chi_id",
    name_miles: float = C.NAME_MILES,
    span_miles: float = C.SPAN_MILES,
    wide_miles: float = C.WIDE_MILES,
) -> DataFrame:
    """(key, avenue, street): per axis the name of the nearest road that spans the cell's center, or null.

    Within ``name_miles`` canonical roads go before broad ones; within
    ``wide_miles`` the nearest of either is taken, canonical first on a tie.
    Without a canonical road on both axes nothing is named.  Cells meet roads by
    equi-join on the mile rows or columns that a road spans.
    """
    reach = max(name_miles, wide_miles)
    avenue = F.col("axis") == AVENUE
    records = Written(cells.sparkSession, "namer").save(records, "records")
    # Whether both axes have a canonical road: one row.
    usable = records.where(F.col("tier") == CANONICAL).agg(F.count_distinct("axis").alias("axes")).where("axes = 2").select("axes")
    lo, hi = (F.col(c) + F.lit(sign * span_miles) * F.when(avenue, F.lit(C.MILE_LAT)).otherwise(F.lit(C.MILE_LON)) for c, sign in (("lo", -1), ("hi", 1)))
    row = lambda x: F.when(avenue, miles_south(x)).otherwise(miles_west(x))
    filed = (
        records.join(F.broadcast(usable), F.lit(True), "left_semi")
        .withColumn("lo", lo)
        .withColumn("hi", hi)
        .withColumn("row", F.explode(F.sequence(F.floor(row(F.col("hi")) - F.lit(1e-6)), F.floor(row(F.col("lo")) + F.lit(1e-6)))))
    )
    sides = F.array(
        F.struct(F.lit(AVENUE).alias("axis"), F.col("lon").alias("x"), F.col("lat").alias("a"), F.floor(miles_south(F.col("lat"))).alias("row")),
        F.struct(F.lit(STREET).alias("axis"), F.col("lat").alias("x"), F.col("lon").alias("a"), F.floor(miles_west(F.col("lon"))).alias("row")),
    )
    unit = F.when(avenue, F.lit(C.MILE_LON)).otherwise(F.lit(C.MILE_LAT))
    met = cells.select(key, F.inline(sides)).join(filed, ["axis", "row"]).where("lo <= a and a <= hi")
    met = met.withColumn("dist", F.abs(F.col("med") - F.col("x"))).where(F.col("dist") < F.lit(reach) * unit)
    near, wide = (F.col("dist") < F.lit(m) * unit for m in (name_miles, wide_miles))
    met = met.withColumn("rank", F.when(near, F.col("tier")).when(wide, F.lit(2))).where("rank is not null")
    place = F.struct("rank", "dist", "tier", "seq")
    best = met.groupBy(key).agg(
        F.min_by(F.when(avenue, F.col("name")), F.when(avenue, place)).alias(AVENUE),
        F.min_by(F.when(~avenue, F.col("name")), F.when(~avenue, place)).alias(STREET),
    )
    return best.select(key, AVENUE, STREET)


def name_cells(cells: DataFrame, roads: DataFrame | None = None, dialect: str = "full") -> DataFrame:
    """Adds name and label: each axis from the roads, or else from its band (library rule)."""
    av, st = band_roads(F.col("lat"), F.col("lon"), dialect)
    if roads is None:
        joined, local = cells, (F.lit(None).cast("string"), F.lit(None).cast("string"))
    else:
        joined = cells.join(roads.select("chi_id", F.col(AVENUE).alias("__av"), F.col(STREET).alias("__st")), "chi_id", "left")
        local = (F.col("__av"), F.col("__st"))
    avenue, street = (F.coalesce(F.nullif(x, F.lit("")), y) for x, y in zip(local, (av, st), strict=True))
    name, label = named(avenue, street, F.col("chi_ordinate"), dialect)
    return joined.withColumn("name", name).withColumn("label", label).drop("__av", "__st")


def dual_names(cells: DataFrame, roads: DataFrame | None = None) -> DataFrame:
    """Adds name, label (from roads if both axes have one, else canonical) and name_canon, label_canon (by bands)."""
    canon_name, canon_label = name_and_label(F.col("lat"), F.col("lon"))
    out = cells.withColumn("name_canon", canon_name).withColumn("label_canon", canon_label)
    if roads is None:
        return out.withColumn("name", F.col("name_canon")).withColumn("label", F.col("label_canon"))
    out = out.join(roads.select("chi_id", F.col(AVENUE).alias("__av"), F.col(STREET).alias("__st")), "chi_id", "left")
    both = (F.coalesce("__av", F.lit("")) != "") & (F.coalesce("__st", F.lit("")) != "")
    name, label = named(F.col("__av"), F.col("__st"), ordinate(F.col("lat"), F.col("lon")))
    return (
        out.withColumn("name", F.when(both, name).otherwise(F.col("name_canon")))
        .withColumn("label", F.when(both, label).otherwise(F.col("label_canon")))
        .drop("__av", "__st")
    )
