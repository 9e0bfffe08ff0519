"""Points to cells: which cell covers a point, and which comes first.

Cells are filed under every square mile that they reach, as one short array per
square mile, sorted by the cells' order.  A point belongs to one square mile, so
a lookup is one equi-join and a search of that array: the points are neither
multiplied nor grouped, and no join compares every point with every cell.  Which
side is broadcast, if any, is left to the sizes that Spark finds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.functions.coords import miles_south, miles_west
from quadrille.functions.geometry import bounds, covers


def cover_index(cells: DataFrame, order: str, keep: Sequence[str], geometry: str = "geometry") -> DataFrame:
    """(s, w, cells): per square mile its cells as structs of order, shape and ``keep``, in order.

    ``geometry`` is a polygon, array of rings; rows without one are left out.
    """
    ring = bounds(F.get(F.col(geometry), F.lit(0)))
    slack = F.lit(1e-6)
    filed = (
        cells.where(F.col(geometry).isNotNull() & (F.size(geometry) > 0))
        .withColumns(ring)
        .withColumn("s", F.explode(F.sequence(F.floor(miles_south(F.col("north")) - slack), F.floor(miles_south(F.col("south")) + slack))))
        .withColumn("w", F.explode(F.sequence(F.floor(miles_west(F.col("east")) - slack), F.floor(miles_west(F.col("west")) + slack))))
    )
    entry = F.struct(F.col(order).alias("order"), F.struct(*keep).alias("cell"), F.col(geometry).alias("shape"), "west", "south", "east", "north")
    return filed.groupBy("s", "w").agg(F.array_sort(F.collect_list(entry)).alias("cells"))


def locate(points: DataFrame, index: DataFrame, lat: str = "lat", lon: str = "lon", squares: bool = False, inside_only: bool = False) -> DataFrame:
    """``points`` with ``cell``: the struct of the first cell that covers the point, or null.

    Borders count.  ``squares`` says that cells are boxes, whose bounds decide.
    Points without coordinates have no cell.  ``inside_only`` leaves out points
    without a cell.
    """
    x, y = F.col(lon), F.col(lat)

    def inside(c):
        box = x.between(c["west"], c["east"]) & y.between(c["south"], c["north"])
        return box if squares else box & covers(c["shape"], x, y)

    # -0.0 and nulls: a floor gives whole numbers, and null keys meet nothing.
    placed = points.withColumn("__s", F.floor(miles_south(y))).withColumn("__w", F.floor(miles_west(x)))
    filed = index.select(F.col("s").alias("__s"), F.col("w").alias("__w"), F.col("cells").alias("__cells"))
    first = F.transform(F.slice(F.filter("__cells", inside), 1, 1), lambda c: c["cell"])
    met = placed.join(filed, ["__s", "__w"], "inner" if inside_only else "left")
    # A generator, unlike a filter on the result, searches each array once.
    found = met.withColumn("cell", F.explode(first)) if inside_only else met.withColumn("cell", F.get(first, F.lit(0)))
    return found.drop("__s", "__w", "__cells")
