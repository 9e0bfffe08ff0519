"""Grid lines: straight fits to anchor roads, gaps filled, ends extended."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrille import constants as C
from quadrille.functions.coords import miles_south, miles_west

NS, EW = "ns", "ew"


def anchors(spark: SparkSession) -> DataFrame:
    """(axis, idx, base, north, south, cap): anchor roads and the runs of them that are fitted, in miles."""
    rows = [(NS, i, b, *C.FIT_WINDOWS.get(b, (None, None)), None) for i, b in C.ANCHORS_NS.items()]
    rows += [(EW, i, b, None, None, C.WEST_CAPS.get(b, C.WEST_CAP)) for i, b in C.ANCHORS_EW.items()]
    return spark.createDataFrame(rows, "axis string, idx int, base string, north double, south double, cap double")


def anchor_vertices(vertices: DataFrame, anchor: DataFrame) -> DataFrame:
    """Vertices of roads that are anchors (a semi-join)."""
    return vertices.join(anchor.select("base").distinct(), "base", "left_semi")


def fit_lines(vertices: DataFrame, anchor: DataFrame, least: int = C.FIT_LEAST) -> DataFrame:
    """(axis, idx, slope, intercept): the least-squares line of each anchor with enough vertices.

    Avenues are fitted as lon = slope * lat + intercept and streets the other
    way round.  A window or cap applies only if it leaves ``least`` vertices.
    """
    met = vertices.join(anchor, "base")
    s, w = miles_south(F.col("lat")), miles_west(F.col("lon"))
    inside = (
        (F.col("north").isNull() | (s >= F.col("north"))) & (F.col("south").isNull() | (s <= F.col("south"))) & (F.col("cap").isNull() | (w <= F.col("cap")))
    )
    # About the origin, so that the sums keep their digits.
    lat, lon = F.col("lat") - F.lit(C.ORIGIN_LAT), F.col("lon") - F.lit(C.ORIGIN_LON)
    met = met.withColumn("inside", inside).withColumn("x", F.when(F.col("axis") == NS, lat).otherwise(lon)).withColumn("y", F.when(F.col("axis") == NS, lon).otherwise(lat))
    clipped = lambda c: F.when(F.col("inside"), F.col(c))
    fits = met.groupBy("axis", "idx").agg(
        F.count("*").alias("n"),
        F.count_if("inside").alias("n_inside"),
        F.regr_slope("y", "x").alias("m_all"),
        F.regr_intercept("y", "x").alias("c_all"),
        F.regr_slope(clipped("y"), clipped("x")).alias("m_in"),
        F.regr_intercept(clipped("y"), clipped("x")).alias("c_in"),
    )
    enough = F.col("n_inside") >= least
    m, c = F.when(enough, F.col("m_in")).otherwise(F.col("m_all")), F.when(enough, F.col("c_in")).otherwise(F.col("c_all"))
    x0 = F.when(F.col("axis") == NS, F.lit(C.ORIGIN_LAT)).otherwise(F.lit(C.ORIGIN_LON))
    y0 = F.when(F.col("axis") == NS, F.lit(C.ORIGIN_LON)).otherwise(F.lit(C.ORIGIN_LAT))
    return fits.where(F.col("n") >= least).select("axis", "idx", m.alias("slope"), (c + y0 - m * x0).alias("intercept"))


def complete_lines(fits: DataFrame) -> DataFrame:
    """Every index from an axis's first anchor to its last: (axis, idx, slope, intercept, fitted).

    Missing ones are interpolated between the nearest anchors on both sides.
    """
    every = fits.groupBy("axis").agg(F.min("idx").alias("a"), F.max("idx").alias("b")).select("axis", F.explode(F.sequence("a", "b")).alias("idx"))
    at = F.when(F.col("slope").isNotNull(), F.struct("idx", "slope", "intercept"))
    below = F.last(at, True).over(Window.partitionBy("axis").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0))
    above = F.first(at, True).over(Window.partitionBy("axis").orderBy("idx").rowsBetween(0, Window.unboundedFollowing))
    filled = every.join(fits, ["axis", "idx"], "left").withColumn("b", below).withColumn("a", above)
    t = (F.col("idx") - F.col("b.idx")) / F.nullif(F.col("a.idx") - F.col("b.idx"), F.lit(0))
    out = [F.coalesce(F.col(c), F.col(f"b.{c}") + t * (F.col(f"a.{c}") - F.col(f"b.{c}"))).alias(c) for c in ("slope", "intercept")]
    return filled.select("axis", "idx", *out, F.col("slope").isNotNull().alias("fitted"))


def extend_lines(lines: DataFrame, extend: int = C.EXTEND) -> DataFrame:
    """Adds ``extend`` lines past both ends, at the spacing of the two outermost; an axis with one line is left alone."""
    ends = lines.groupBy("axis").agg(F.min("idx").alias("lo"), F.max("idx").alias("hi")).where("hi > lo")
    side = F.explode(F.array(F.struct(F.lit(-1).alias("d"), F.col("lo").alias("edge")), F.struct(F.lit(1).alias("d"), F.col("hi").alias("edge"))))
    ends = ends.select("axis", side.alias("e")).select("axis", "e.d", "e.edge")
    outer = lines.select("axis", F.col("idx").alias("edge"), F.col("slope").alias("m1"), F.col("intercept").alias("c1"))
    inner = lines.select("axis", F.col("idx").alias("next"), F.col("slope").alias("m0"), F.col("intercept").alias("c0"))
    more = (
        ends.join(outer, ["axis", "edge"])
        .withColumn("next", F.col("edge") - F.col("d"))
        .join(inner, ["axis", "next"])
        .withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(extend))))
        .select(
            "axis",
            (F.col("edge") + F.col("d") * F.col("n")).alias("idx"),
            (F.col("m1") + F.col("n") * (F.col("m1") - F.col("m0"))).alias("slope"),
            (F.col("c1") + F.col("n") * (F.col("c1") - F.col("c0"))).alias("intercept"),
        )
    )
    return lines.select("axis", "idx", "slope", "intercept").unionByName(more)


def check_lines(lines: DataFrame) -> None:
    """Raises unless both axes have two lines or more, which extending needs."""
    found = {r["axis"]: r["n"] for r in lines.groupBy("axis").agg(F.count("*").alias("n")).collect()}
    for axis in (NS, EW):
        if found.get(axis, 0) < 2:
            raise ValueError(f"axis {axis}: {found.get(axis, 0)} anchor lines; two or more are needed")
