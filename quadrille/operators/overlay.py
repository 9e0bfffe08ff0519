"""Faces of a city outline cut by grid lines, and their merger into cells.

Each outline part is split by the N/S lines into strips and each strip by the
E/W lines.  Splitting a simple ring by a line sorts the crossings along the line
and pairs them, so every piece is connected.  Strips are independent: one task
takes one strip of one part.  The lines, a few dozen, travel with the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.constants import AREA_TOLERANCE, MILE_LAT, MILE_LON
from quadrille.functions.coords import cell_id, center_out, ordinate
from quadrille.functions.geometry import MULTIPOLYGON, bounds, polygon_area, ring_area, square_miles
from quadrille.operators.arrangement import closed, dissolved, dissolved_edges, snapped
from quadrille.operators.lines import EW, NS
from quadrille.sources.geojson import polygon_edges

EDGE_DEGREES = 1e-5
#: Pieces thinner than this are what rounding leaves of an exact cut.
SLIVER = 1e-16
#: Pairs of a point and an edge that are measured at once.
_BLOCK = 1 << 18


def split_ring(ring: np.ndarray, side: np.ndarray, along: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Open ring, signed distances and places along a line -> pieces below the line, pieces above.

    A vertex on the line counts as above, so lines may run through vertices and
    along edges.
    """
    up = side >= 0
    if up.all() or not up.any():
        return ([], [ring]) if up.all() else ([ring], [])
    n = len(ring)
    nxt = np.roll(np.arange(n), -1)
    cut = np.flatnonzero(up != up[nxt])
    t = side[cut] / (side[cut] - side[nxt[cut]])
    points = ring[cut] + t[:, None] * (ring[nxt[cut]] - ring[cut])
    places = along[cut] + t * (along[nxt[cut]] - along[cut])
    order = np.argsort(places, kind="stable")
    rank = np.empty(len(cut), int)
    rank[order] = np.arange(len(cut))
    partner = order[rank ^ 1]
    pieces: tuple[list, list] = ([], [])
    done = np.zeros(len(cut), bool)
    for first in range(len(cut)):
        if done[first]:
            continue
        above = bool(up[nxt[cut[first]]])
        piece, k = [], first
        while not done[k]:
            done[k] = True
            piece.append(points[k])
            stop = cut[(k + 1) % len(cut)]
            i = nxt[cut[k]]
            while True:
                piece.append(ring[i])
                if i == stop:
                    break
                i = nxt[i]
            k = (k + 1) % len(cut)
            piece.append(points[k])
            k = partner[k]
        pieces[above].append(np.array(piece))
    return pieces


def area(ring: np.ndarray) -> float:
    x, y = (ring - ring[0]).T
    return abs(float(x @ np.roll(y, -1) - y @ np.roll(x, -1))) / 2


def _tidy(ring: np.ndarray) -> np.ndarray:
    """Without repeated vertices."""
    return ring[np.any(ring != np.roll(ring, 1, 0), axis=1)]


def inner_point(rings: list[np.ndarray]) -> tuple[float, float]:
    """(lon, lat) in the middle of the widest section of a horizontal line at about mid-height."""
    best = (-1.0, float(rings[0][0, 0]), float(rings[0][0, 1]))
    for ring in rings:
        ys = ring[:, 1]
        middle = (ys.min() + ys.max()) / 2
        y = (ys[ys <= middle].max() + ys[ys > middle].min()) / 2 if (ys > middle).any() else middle
        a, b = ring, np.roll(ring, -1, 0)
        over = (a[:, 1] > y) != (b[:, 1] > y)
        a, b = a[over], b[over]
        xs = np.sort(a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1]))
        for lo, hi in zip(xs[::2], xs[1::2], strict=False):
            if hi - lo > best[0]:
                best = (float(hi - lo), float((lo + hi) / 2), float(y))
    return best[1], best[2]


def _near(points: np.ndarray, ring: np.ndarray) -> float:
    """Least distance of points to the edges of a ring."""
    a, d = ring, np.roll(ring, -1, 0) - ring
    length = np.maximum((d * d).sum(1), 1e-300)
    best, step = np.inf, max(1, _BLOCK // len(ring))
    for first in range(0, len(points), step):
        p = points[first : first + step, None]
        t = np.clip(((p - a) * d).sum(2) / length, 0, 1)
        best = min(best, float(np.sqrt((((a + t[..., None] * d) - p) ** 2).sum(2).min())))
        if best == 0:
            break
    return best


def boundary_distance(face: np.ndarray, outline: np.ndarray) -> float:
    """Least distance between the edges of a face and those of the outline that it was cut from."""
    best = _near(face, outline)
    if best > 0:
        # A vertex of the outline can only be nearer if it is as near to the face's box.
        reach = best + 1e-9
        close = ((outline >= face.min(0) - reach) & (outline <= face.max(0) + reach)).all(1)
        best = min(best, _near(outline[close], face))
    return best


FACE = "part bigint, strip int, lon double, lat double, area double, near double, ring array<array<double>>"


def _strip_faces(ns: list[tuple[float, float]], ew: list[tuple[float, float]]):
    def faces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                outline, *others = (np.array([list(p) for p in r], float) for r in row.rings)
                outline = _tidy(outline[:-1] if (outline[0] == outline[-1]).all() else outline)
                others = [r[:-1] for r in others]
                pieces = [outline]
                for k, want in ((row.strip - 1, 1), (row.strip, 0)):
                    if 0 <= k < len(ns):
                        m, c = ns[k]
                        pieces = [q for p in pieces for q in split_ring(p, p[:, 0] - (m * p[:, 1] + c), p[:, 1])[want]]
                for m, c in ew:
                    pieces = [q for p in pieces for side in split_ring(p, p[:, 1] - (m * p[:, 0] + c), p[:, 0]) for q in side]
                out = []
                for p in map(_tidy, pieces):
                    if len(p) < 3 or area(p) <= SLIVER:
                        continue
                    lon, lat = inner_point([p])
                    near = min(boundary_distance(p, r) for r in (outline, *others))
                    out.append((row.part, row.strip, lon, lat, area(p), near, [*p.tolist(), p[0].tolist()]))
                yield pd.DataFrame(out, columns=[f.split()[0] for f in FACE.split(", ")])

    return faces


def _close_parts(outlines: DataFrame) -> DataFrame:
    """(part, others): the rings of the parts whose boxes come near a part's own, by the squares that boxes reach."""
    box = bounds(F.col("ring"))
    reach = lambda lo, hi, mile: F.sequence(F.floor((lo - EDGE_DEGREES) / mile), F.floor((hi + EDGE_DEGREES) / mile))
    rows = outlines.select("part", F.explode(reach(box["south"], box["north"], F.lit(MILE_LAT))).alias("row"), "ring")
    squares = rows.select("part", "row", F.explode(reach(box["west"], box["east"], F.lit(MILE_LON))).alias("column"))
    near = squares.join(squares.withColumnRenamed("part", "other"), ["row", "column"]).where("part <> other").select("part", "other").distinct()
    rings = outlines.select(F.col("part").alias("other"), F.col("ring").alias("r"))
    return near.join(rings, "other").groupBy("part").agg(F.collect_list("r").alias("others"))


def overlay_faces(outlines: DataFrame, lines: DataFrame) -> DataFrame:
    """Faces of outlines (part, ring: simple, without holes) cut by lines (axis, idx, slope, intercept).

    One row per face: part, strip, lon, lat (its inner point), area in square
    degrees, near (distance to the outline of any part), ring.
    """
    given = lines.select("axis", "slope", "intercept").collect()
    mean = outlines.select(F.explode("ring").alias("p")).agg(F.avg(F.col("p")[0]).alias("x"), F.avg(F.col("p")[1]).alias("y")).first()
    at = {NS: mean["y"] or 0.0, EW: mean["x"] or 0.0}
    by = {a: sorted(((r["slope"], r["intercept"]) for r in given if r["axis"] == a), key=lambda l: l[0] * at[a] + l[1]) for a in (NS, EW)}
    parts = outlines.select("part", "ring").join(_close_parts(outlines), "part", "left")
    # One list, its own ring first: lists that are empty in all rows of a batch crash the worker's reader.
    rings = F.concat(F.array("ring"), F.coalesce("others", F.array().cast("array<array<array<double>>>")))
    strips = parts.select("part", rings.alias("rings"), F.explode(F.sequence(F.lit(0), F.lit(len(by[NS])))).alias("strip"))
    # Each task takes a strip of a part; what a strip needs of the outline it cuts itself.
    return strips.repartition("part", "strip").mapInPandas(_strip_faces(by[NS], by[EW]), FACE)


def _merge(frame: pd.DataFrame) -> pd.DataFrame:
    rings = [np.array([list(p) for p in r], float)[:-1] for r in frame["ring"]]
    order = sorted(range(len(rings)), key=lambda i: (frame["part"].iloc[i], frame["strip"].iloc[i], frame["lat"].iloc[i], frame["lon"].iloc[i]))
    lon, lat = inner_point([rings[i] for i in order])
    geometry = [[[list(map(float, p)) for p in frame["ring"].iloc[i]]] for i in order]
    return pd.DataFrame(
        [(frame["chi_ordinate"].iloc[0], lon, lat, float(frame["area"].sum()), float(frame["near"].min()), geometry)],
        columns=["chi_ordinate", "lon", "lat", "area", "near", "geometry"],
    )


def merge_faces(faces: DataFrame) -> DataFrame:
    """Faces with one ordinate become one cell: chi_ordinate, lon, lat, area, near, geometry (parts side by side).

    The ordinate is that of each face's inner point; the cell's own inner point,
    of its widest part, may lie in another band.
    """
    keyed = faces.withColumn("chi_ordinate", ordinate(F.col("lat"), F.col("lon")))
    return keyed.groupBy("chi_ordinate").applyInPandas(
        _merge, f"chi_ordinate string, lon double, lat double, area double, near double, geometry {MULTIPOLYGON}"
    )


def dissolve_faces(faces: DataFrame) -> DataFrame:
    """(chi_ordinate, geometry): the faces of each ordinate as one shape, without the lines between them.

    Faces that share a border become one part; parts that touch in a point, or not at
    all, are parts of one multipolygon, largest first.
    """
    keyed = faces.select(ordinate(F.col("lat"), F.col("lon")).alias("chi_ordinate"), F.xxhash64("part", "strip", "lon", "lat").alias("owner"), F.array("ring").alias("polygon"))
    parts = dissolved(keyed, ["chi_ordinate"]).select("chi_ordinate", polygon_area(F.col("polygon")).alias("size"), "polygon")
    sorted_parts = F.sort_array(F.collect_list(F.struct("size", "polygon")), asc=False)
    return parts.groupBy("chi_ordinate").agg(F.transform(sorted_parts, lambda p: p["polygon"]).alias("geometry"))


def area_flags(cells: DataFrame, edge_degrees: float = EDGE_DEGREES) -> DataFrame:
    """Adds area_sqmi, edge (within reach of the outline) and flag (an inner cell whose area is off)."""
    lo, hi = AREA_TOLERANCE
    out = cells.withColumn("area_sqmi", square_miles(F.col("area"))).withColumn("edge", F.col("near") <= F.lit(edge_degrees))
    return out.withColumn("flag", ~F.col("edge") & ~F.col("area_sqmi").between(lo, hi))


def cell_attributes(cells: DataFrame) -> DataFrame:
    """Adds chi_id and center."""
    return cells.withColumn("chi_id", cell_id(F.col("chi_ordinate"))).withColumn("center", center_out(F.col("lat"), F.col("lon")))


def _snapped(x: str, y: str, snap: float) -> Column:
    at = lambda c: F.round(F.col(c) / F.lit(snap)).cast("long")
    return F.struct(at(x).alias("x"), at(y).alias("y"))


def through_vertices(edges: DataFrame, owner: str, seam: float) -> DataFrame:
    """``edges`` (owner, x1, y1, x2, y2), each led through the vertices of other owners that lie within ``seam`` of it.

    Neighbours whose borders have different vertices, or a seam between them,
    have the same edges afterwards.  Edges and vertices meet by the squares,
    a hundredth of a degree wide, that an edge's box reaches.
    """
    wide = 0.01
    square = lambda c: F.floor(F.col(c) / wide)
    given = edges.withColumn("edge", F.xxhash64(owner, "x1", "y1", "x2", "y2"))
    reach = lambda a, b: F.sequence(F.floor((F.least(a, b) - seam) / wide), F.floor((F.greatest(a, b) + seam) / wide))
    filed = given.withColumn("column", F.explode(reach("x1", "x2"))).withColumn("row", F.explode(reach("y1", "y2")))
    vertices = edges.select(F.col(owner).alias("of"), F.col("x1").alias("x"), F.col("y1").alias("y")).distinct()
    vertices = vertices.withColumn("column", square("x")).withColumn("row", square("y"))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    length = dx * dx + dy * dy
    along = ((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy) / F.nullif(length, F.lit(0.0))
    off = F.abs((F.col("x") - F.col("x1")) * dy - (F.col("y") - F.col("y1")) * dx) / F.sqrt(length)
    met = filed.join(vertices, ["column", "row"]).where(F.col(owner) != F.col("of")).withColumn("t", along)
    margin = F.lit(seam) / F.sqrt(length)
    met = met.where((F.col("t") > margin) & (F.col("t") < 1 - margin) & (off <= seam))
    stops = met.groupBy("edge").agg(F.array_sort(F.collect_set(F.struct("t", "x", "y"))).alias("stops"))
    ends = lambda a, b: F.array(F.struct(F.col(a).alias("x"), F.col(b).alias("y")))
    between = F.transform(F.coalesce("stops", F.array().cast("array<struct<t:double,x:double,y:double>>")), lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y")))
    path = given.join(stops, "edge", "left").withColumn("path", F.concat(ends("x1", "y1"), between, ends("x2", "y2")))
    step = lambda i: F.struct(
        *[F.get("path", i)[c].alias(f"{c}1") for c in "xy"], *[F.get("path", i + 1)[c].alias(f"{c}2") for c in "xy"]
    )
    return path.select(owner, F.inline(F.transform(F.sequence(F.lit(0), F.size("path") - 2), step))).select(owner, "x1", "y1", "x2", "y2")


def dissolve(edges: DataFrame, snap: float = 1e-7) -> DataFrame:
    """Undirected edges of adjoining polygons that only one of them has, snapped to a grid: the outline's edges.

    Works where neighbours share vertices; :func:`through_vertices` makes them.
    """
    a, b = _snapped("x1", "y1", snap), _snapped("x2", "y2", snap)
    keyed = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), "x1", "y1", "x2", "y2").where("a <> b")
    once = keyed.groupBy("a", "b").agg(F.count("*").alias("n"), F.first(F.struct("x1", "y1", "x2", "y2")).alias("e")).where("n % 2 = 1")
    return once.select("e.*")


def outline_parts(polygons: DataFrame, seam: float = 1e-5, snap: float = 1e-9, close: float = 0.0) -> DataFrame:
    """(part, ring): the outer rings of the union of polygons (part, polygon), largest first.

    Polygons may adjoin, overlap and cross themselves; holes are filled.  Seams up to
    ``seam`` wide are closed by leading edges through near vertices.  With ``close``,
    gaps, inlets and holes narrower than twice that are closed as well, and inner
    corners rounded, by growing the union and shrinking it again.
    """
    key = ["all"]
    if close > 0:
        found = closed(polygons.select(F.lit(0).alias("all"), "polygon"), key, close, fill_holes=True)
    else:
        led = through_vertices(polygon_edges(polygons, "part", fill_holes=True), "part", seam).withColumnRenamed("part", "owner")
        edges = snapped(led.withColumn("sign", F.lit(1)).withColumn("all", F.lit(0)), snap)
        found = dissolved_edges(edges, key, fill_holes=True, grid=snap)
    rings = found.select(F.get("polygon", 0).alias("ring"))
    # As many numbers as there are parts, which are few beside their vertices.
    return rings.withColumn("part", F.row_number().over(Window.orderBy(ring_area(F.col("ring")).desc(), F.col("ring"))).cast("long") - 1).select("part", "ring")
