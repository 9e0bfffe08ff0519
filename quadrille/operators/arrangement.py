"""Arrangements of polygons: repair, union, offsets and closing, of any size.

Coordinates are rounded to a grid of ``GRID`` degrees.  Then

1. *noding*: edges that cross, touch or overlap are cut where they meet.  Edges
   meet by equi-join on the square tiles that they pass; cut points are rounded, so
   the step is repeated until it cuts nothing;
2. *sides*: an edge's middle is looked up in the tiles of all polygons.  A tile
   holds its own edges and whether its corner is inside, so that a look takes the
   few edges of one tile, however large the polygon.  What is inside a polygon is
   so by the even-odd rule: an edge that a polygon has twice is no border of it;
3. *rings*: edges with the wanted area on one side alone are directed, each finds
   the one that follows at its end by a window over the angles there, and the
   places on the rings come from pointer doubling, in as many rounds as the longest
   ring has binary digits;
4. *nesting*: a hole belongs to the smallest ring around it, found in tiles as well.

Every step is a join, a window or an aggregation whose keys are tiles or vertices;
only a finished ring is one value.  All of it works on many groups at once, which
don't see each other.  Tiles should be so small that each holds few edges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.functions.geometry import ring_edges
from quadrille.sources.shared import Written

#: Degrees between the places that vertices can have.
GRID = 1e-9
#: Degrees to a side of a tile.
TILE = 0.01
#: Tiles begin at places that no vertex has and no edge is likely to run through.
_OFF_X, _OFF_Y = 0.3819660112501051, 0.7548776662466927
#: An edge that comes so close to a vertex, in grid steps, runs through it.
_TOUCH = 0.7072
ENDS = ["ax", "ay", "bx", "by"]
_EDGE = "struct<ax:double,ay:double,bx:double,by:double>"


def segments(polygons: DataFrame, grid: float = GRID) -> DataFrame:
    """(.., ax, ay, bx, by) of all rings of ``polygon``, in grid steps and with the smaller end first; other columns stay."""
    held = [c for c in polygons.columns if c != "polygon"]
    return snapped(polygons.select(*held, F.explode("polygon").alias("ring")).select(*held, F.inline(ring_edges(F.col("ring")))), grid)


def snapped(edges: DataFrame, grid: float = GRID) -> DataFrame:
    """(.., ax, ay, bx, by) of edges (.., x1, y1, x2, y2) in degrees; those shorter than a step go."""
    held = [c for c in edges.columns if c not in ("x1", "y1", "x2", "y2")]
    at = lambda c: F.round(F.col(c) / F.lit(grid)) + F.lit(0.0)
    a, b = (F.struct(at(f"x{k}").alias("x"), at(f"y{k}").alias("y")) for k in (1, 2))
    ends = edges.select(*held, F.least(a, b).alias("__from"), F.greatest(a, b).alias("__to")).where("__from <> __to")
    return ends.select(*held, *[F.col(f"{p}.{c}").alias(f"{n}{c}") for p, n in (("__from", "a"), ("__to", "b")) for c in "xy"])


def path_edges(vertices: DataFrame, width: float) -> DataFrame:
    """(x1, y1, x2, y2) from each vertex (x, y) to the next one by x, then y.

    Vertices are ordered within strips of ``width``; the last of a strip leads to the
    first of the next one that has any.  One row a strip is ordered in one task, so
    strips should hold many vertices, but not more than a task can sort.
    """
    place = F.struct("x", "y")
    placed = vertices.select(F.floor(F.col("x") / F.lit(width)).alias("strip"), place.alias("p"))
    inner = placed.select("p", F.lead("p").over(Window.partitionBy("strip").orderBy("p")).alias("q"))
    strips = placed.groupBy("strip").agg(F.max("p").alias("p"), F.min("p").alias("first"))
    between = strips.select("p", F.lead("first").over(Window.orderBy("strip")).alias("q"))
    return inner.unionByName(between).where("q IS NOT NULL").select(*[F.col(f"{v}.{c}").alias(f"{c}{k}") for k, v in ((1, "p"), (2, "q")) for c in "xy"])


def _tile(value: Column, off: float, tile: float) -> Column:
    return F.floor((value - F.lit(off)) / F.lit(tile))


def _x_at(y: Column) -> Column:
    """Where the line of an edge is at a height; the edge must not be level."""
    return F.col("ax") + (y - F.col("ay")) * (F.col("bx") - F.col("ax")) / F.nullif(F.col("by") - F.col("ay"), F.lit(0.0))


def filed(edges: DataFrame, tile: float, reach: float = 0.0) -> DataFrame:
    """``edges`` with (column, row) of each tile that they pass or come within ``reach`` of; ``tile`` in grid steps."""
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    rows = edges.withColumn("row", F.explode(F.sequence(_tile(low - reach, _OFF_Y, tile), _tile(high + reach, _OFF_Y, tile))))
    start = F.col("row") * F.lit(tile) + F.lit(_OFF_Y)
    bottom, top = F.greatest(low, start - reach), F.least(high, start + tile + reach)
    sides = [F.coalesce(_x_at(bottom), F.col("ax")), F.coalesce(_x_at(top), F.col("bx"))]
    # A step more for what rounding moves.
    west, east = F.least(*sides) - (reach + 1), F.greatest(*sides) + (reach + 1)
    return rows.withColumn("column", F.explode(F.sequence(_tile(west, _OFF_X, tile), _tile(east, _OFF_X, tile))))


def _cuts(edges: DataFrame, key: list[str], tile: float) -> DataFrame:
    """(key, ends, x, y): where edges (key, ends) meet others of their group inside."""
    near = filed(edges, tile, _TOUCH)
    ends = F.struct(*ENDS)
    first = near.select(*key, "column", "row", ends.alias("e"))
    pairs = first.join(first.withColumnRenamed("e", "f"), [*key, "column", "row"]).where("e < f")
    e, f = F.col("e"), F.col("f")
    cross = lambda px, py, qx, qy: px * qy - py * qx
    ex, ey, fx, fy = e["bx"] - e["ax"], e["by"] - e["ay"], f["bx"] - f["ax"], f["by"] - f["ay"]

    def touches(on: Column, dx: Column, dy: Column, x: Column, y: Column) -> Column:
        """Whether a vertex lies on an edge, its ends excepted."""
        px, py = x - on["ax"], y - on["ay"]
        size, along = dx * dx + dy * dy, px * dx + py * dy
        inside = (along > 0) & (along < size) & (F.abs(cross(px, py, dx, dy)) <= _TOUCH * F.sqrt(size))
        return inside & ~((x == on["ax"]) & (y == on["ay"])) & ~((x == on["bx"]) & (y == on["by"]))

    tests = [(e, ex, ey, f), (f, fx, fy, e)]
    met = [(on, of[f"{p}x"], of[f"{p}y"], touches(on, dx, dy, of[f"{p}x"], of[f"{p}y"])) for on, dx, dy, of in tests for p in "ab"]
    pairs = pairs.select("*", *[hit.alias(f"hit{k}") for k, (_, _, _, hit) in enumerate(met)])
    turn = F.nullif(cross(ex, ey, fx, fy), F.lit(0.0))
    gx, gy = f["ax"] - e["ax"], f["ay"] - e["ay"]
    t, u = cross(gx, gy, fx, fy) / turn, cross(gx, gy, ex, ey) / turn
    # Where a vertex lies on the other edge, that is the place; a crossing beside it would be rounding.
    crossing = ~(F.col("hit0") | F.col("hit1") | F.col("hit2") | F.col("hit3")) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
    at = F.struct((F.round(e["ax"] + t * ex) + F.lit(0.0)).alias("x"), (F.round(e["ay"] + t * ey) + F.lit(0.0)).alias("y"))
    place = lambda on, x, y: F.struct(on.alias("on"), x.alias("x"), y.alias("y"))
    pairs = pairs.withColumn("at", F.when(crossing, at))
    found = [F.when(F.col(f"hit{k}"), place(on, x, y)) for k, (on, x, y, _) in enumerate(met)]
    found += [F.when(F.col("at").isNotNull(), place(on, F.col("at")["x"], F.col("at")["y"])) for on in (e, f)]
    out = pairs.select(*key, F.explode(F.filter(F.array(*found), lambda p: p.isNotNull())).alias("p")).select(*key, "p.on.*", "p.x", "p.y")
    inner = ~((F.col("x") == F.col("ax")) & (F.col("y") == F.col("ay"))) & ~((F.col("x") == F.col("bx")) & (F.col("y") == F.col("by")))
    return out.where(inner).distinct()


def noded(edges: DataFrame, key: list[str], written: Written, tile: float) -> DataFrame:
    """Edges (key, .., ends) cut where they meet others of their ``key``, until none meet but at ends."""
    held = [c for c in edges.columns if c not in ENDS]
    edges, turn = written.save(edges, "edges-0"), 0
    while True:
        cuts = written.save(_cuts(edges.select(*key, *ENDS).distinct(), key, tile), f"cuts-{turn}")
        if cuts.isEmpty():
            return edges
        turn += 1
        whole = edges.join(cuts.select(*key, *ENDS).distinct(), [*key, *ENDS], "left_anti")
        along = (F.col("x") - F.col("ax")) * (F.col("bx") - F.col("ax")) + (F.col("y") - F.col("ay")) * (F.col("by") - F.col("ay"))
        cut = cuts.select(*key, *ENDS).distinct()
        stops = cuts.unionByName(cut.withColumn("x", F.col("ax")).withColumn("y", F.col("ay"))).unionByName(cut.withColumn("x", F.col("bx")).withColumn("y", F.col("by")))
        order = Window.partitionBy(*key, *ENDS).orderBy(along, "x", "y")
        here = F.struct("x", "y")
        steps = stops.select(*key, *ENDS, here.alias("p"), F.lead(here).over(order).alias("q")).where("q IS NOT NULL")
        a, b = F.least("p", "q"), F.greatest("p", "q")
        parts = edges.join(steps, [*key, *ENDS]).select(*held, a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by"))
        edges = written.save(whole.select(*held, *ENDS).unionByName(parts), f"edges-{turn}")
        written.drop(f"edges-{turn - 1}")


def tile_index(edges: DataFrame, owner: list[str], tile: float) -> DataFrame:
    """(owner, column, row, odd, edges): the tiles that an owner's borders pass or that lie inside.

    ``odd`` tells whether the tile's south-west corner is inside, by the parity of
    the crossings west of it, summed over the columns of its row.  ``edges`` (owner,
    ends) must hold each border once.
    """
    low, high = F.least("ay", "by"), F.greatest("ay", "by")
    first, last = F.ceil((low - _OFF_Y) / F.lit(tile)), F.ceil((high - _OFF_Y) / F.lit(tile)) - 1
    crossed = edges.where(first <= last).withColumn("row", F.explode(F.sequence(first, last)))
    at = _tile(_x_at(F.col("row") * F.lit(tile) + F.lit(_OFF_Y)), _OFF_X, tile)
    turns = crossed.select(*owner, "row", at.alias("k")).groupBy(*owner, "row", "k").agg(F.count("*").alias("n")).where("n % 2 = 1")
    order = Window.partitionBy(*owner, "row").orderBy("k")
    spans = turns.select(*owner, "row", "k", F.lead("k").over(order).alias("to"), F.row_number().over(order).alias("nth")).where("nth % 2 = 1 AND to > k")
    corners = spans.select(*owner, F.explode(F.sequence(F.col("k") + 1, F.col("to"))).alias("column"), "row", F.lit(1).alias("odd"), F.lit(None).cast(_EDGE).alias("e"))
    borders = filed(edges, tile).select(*owner, "column", "row", F.lit(0).alias("odd"), F.struct(*ENDS).alias("e"))
    return corners.unionByName(borders).groupBy(*owner, "column", "row").agg((F.max("odd") == 1).alias("odd"), F.collect_list("e").alias("edges"))


def _inside(x: Column, y: Column, tile: float, level: Column, own: Column | None = None) -> Column:
    """Whether a point is inside the owner of a tile of the index.

    Points on a border count as just west of it and above, or with ``level`` as just
    below; ``own`` is an edge through the point, which therefore isn't crossed there.
    The way leads from the corner up the tile's west side, then east.
    """
    corner_x, corner_y = F.col("column") * F.lit(tile) + F.lit(_OFF_X), F.col("row") * F.lit(tile) + F.lit(_OFF_Y)

    def crossings(g: Column) -> Column:
        low, high = F.least(g["ay"], g["by"]), F.greatest(g["ay"], g["by"])
        over = F.when(level, (low < y) & (y <= high)).otherwise((low <= y) & (y < high))
        at_x = g["ax"] + (y - g["ay"]) * (g["bx"] - g["ax"]) / F.nullif(g["by"] - g["ay"], F.lit(0.0))
        east = over & (at_x >= corner_x) & (at_x < x)
        at_y = g["ay"] + (corner_x - g["ax"]) * (g["by"] - g["ay"]) / F.nullif(g["bx"] - g["ax"], F.lit(0.0))
        below = F.when(level, at_y < y).otherwise(at_y <= y)
        up = (F.least(g["ax"], g["bx"]) <= corner_x) & (corner_x < F.greatest(g["ax"], g["bx"])) & (at_y >= corner_y) & below
        if own is not None:
            east = east & (g != own)
        return F.coalesce(east, F.lit(False)).cast("int") + F.coalesce(up, F.lit(False)).cast("int")

    total = F.aggregate("edges", F.col("odd").cast("int"), lambda n, g: n + crossings(g))
    return total % 2 == 1


def _on_border(x: Column, y: Column) -> Column:
    def on(g: Column) -> Column:
        level = (g["bx"] - g["ax"]) * (y - g["ay"]) == (g["by"] - g["ay"]) * (x - g["ax"])
        return level & x.between(F.least(g["ax"], g["bx"]), F.greatest(g["ax"], g["bx"])) & y.between(F.least(g["ay"], g["by"]), F.greatest(g["ay"], g["by"]))

    return F.exists("edges", on)


def covering(points: DataFrame, polygons: DataFrame, owner: list[str], grid: float = GRID, tile: float = TILE) -> DataFrame:
    """``points`` (.., x, y) by ``polygons`` (owner, polygon) that cover them; borders count.

    A point meets the edges of its own tile alone, so the cost of a look doesn't grow
    with the polygon, and the index has a row for each tile, not a copy of the shape.
    Even-odd rule; points and vertices are rounded to the grid.
    """
    return covering_edges(points, segments(polygons.select(*owner, "polygon"), grid), owner, grid, tile)


def covering_edges(points: DataFrame, edges: DataFrame, owner: list[str], grid: float = GRID, tile: float = TILE) -> DataFrame:
    """As :func:`covering`, of the polygons' edges (owner, ends) as :func:`segments` returns them: no polygon is one value."""
    step = tile / grid
    edges = edges.select(*owner, *ENDS).groupBy(*owner, *ENDS).agg(F.count("*").alias("n")).where("n % 2 = 1").drop("n")
    index = tile_index(edges, owner, step)
    held = points.columns
    at = lambda c: F.round(F.col(c) / F.lit(grid))
    placed = points.select("*", at("x").alias("px"), at("y").alias("py"))
    placed = placed.withColumn("column", _tile(F.col("px"), _OFF_X, step)).withColumn("row", _tile(F.col("py"), _OFF_Y, step))
    met = placed.join(index, ["column", "row"])
    px, py = F.col("px"), F.col("py")
    return met.where(_inside(px, py, step, F.lit(False)) | _on_border(px, py)).select(*held, *owner)


def borders(edges: DataFrame, key: list[str], written: Written, tile: float) -> DataFrame:
    """(key, ends), directed: noded edges (key, owner, sign, ends) with the wanted area on their left alone.

    Wanted is what lies in an owner of sign 1 and in none of sign -1.
    """
    owner = [*key, "owner", "sign"]
    odd = written.save(edges.groupBy(*owner, *ENDS).agg(F.count("*").alias("n")).where("n % 2 = 1").drop("n"), "odd")
    index = tile_index(odd, owner, tile)
    x, y = (F.col("ax") + F.col("bx")) / 2, (F.col("ay") + F.col("by")) / 2
    middles = odd.select(*key, *ENDS).distinct().select(*key, F.struct(*ENDS).alias("own"), x.alias("x"), y.alias("y"), (F.col("ay") == F.col("by")).alias("level"))
    middles = middles.withColumn("column", _tile(F.col("x"), _OFF_X, tile)).withColumn("row", _tile(F.col("y"), _OFF_Y, tile))
    met = middles.join(index, [*key, "column", "row"])
    met = met.select(*key, "own", "level", "sign", _inside(F.col("x"), F.col("y"), tile, F.col("level"), F.col("own")).alias("here"), F.exists("edges", lambda g: g == F.col("own")).alias("border"))
    # Across its own border a polygon's other side begins.
    some = lambda sign, here: F.max(F.when((F.col("sign") == sign) & here, 1).otherwise(0))
    there = F.col("here") != F.col("border")
    sums = met.groupBy(*key, "own", "level").agg(some(1, F.col("here")).alias("p"), some(-1, F.col("here")).alias("m"), some(1, there).alias("q"), some(-1, there).alias("n"))
    near, far = (F.col("p") == 1) & (F.col("m") == 0), (F.col("q") == 1) & (F.col("n") == 0)
    kept = sums.where(near != far).select(*key, "own.*", "level", near.alias("near"))
    # The near side is west, on the left of an edge that goes up; of a level edge it is south, left of one that goes west.
    forward = F.when(F.col("level"), ~F.col("near")).otherwise((F.col("by") > F.col("ay")) == F.col("near"))
    ends = [F.when(forward, F.col(c)).otherwise(F.col(d)).alias(c) for c, d in (("ax", "bx"), ("ay", "by"), ("bx", "ax"), ("by", "ay"))]
    return kept.select(*key, *ends)


def _doubled(links: DataFrame, reach: int) -> DataFrame:
    """Links (id, to, ring, ahead) that know the next ``reach`` edges, of twice as many."""
    then = links.select(F.col("id").alias("to"), F.col("to").alias("to2"), F.col("ring").alias("ring2"), F.col("ahead").alias("ahead2"))
    less = F.col("ring2") < F.col("ring")
    return links.join(then, "to").select(
        "id", F.col("to2").alias("to"), F.least("ring", "ring2").alias("ring"), F.when(less, F.col("ahead2") + F.lit(reach)).otherwise(F.col("ahead")).alias("ahead"), less.alias("new")
    )


def rings_of(edges: DataFrame, key: list[str], written: Written) -> DataFrame:
    """(key, ends, ring, seq): directed edges by the ring that they are on and their place there.

    Where rings touch, each turns as sharply as it can around the area on its left,
    so that areas that touch in a point are rings of their own.
    """
    edges = written.save(edges.withColumn("id", F.monotonically_increasing_id()), "directed")
    angle = lambda x1, y1, x2, y2: F.atan2(F.col(y2) - F.col(y1), F.col(x2) - F.col(x1)).alias("angle")
    away = edges.select(*key, F.col("ax").alias("x"), F.col("ay").alias("y"), angle("ax", "ay", "bx", "by"), F.col("id").alias("to"), F.lit(None).cast("long").alias("from"))
    back = edges.select(*key, F.col("bx").alias("x"), F.col("by").alias("y"), angle("bx", "by", "ax", "ay"), F.lit(None).cast("long").alias("to"), F.col("id").alias("from"))
    # Where both directions of an edge are given, turning back is the last choice.
    around = Window.partitionBy(*key, "x", "y").orderBy("angle", F.col("to").isNotNull())
    before, whole = around.rowsBetween(Window.unboundedPreceding, -1), around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    turned = F.coalesce(F.last("to", ignorenulls=True).over(before), F.last("to", ignorenulls=True).over(whole))
    links = away.unionByName(back).select("from", turned.alias("to")).where("from IS NOT NULL")
    # Doubling: the least edge number among the next 2, 4, 8 .. edges, and how far ahead it is.
    now, turn = written.save(links.select(F.col("from").alias("id"), "to", F.col("from").alias("ring"), F.lit(0).cast("long").alias("ahead"), F.lit(True).alias("new")), "links-0"), 0
    while not now.where("new").isEmpty():
        # Twice between writings; the state stands when the second changes nothing.
        now = written.save(_doubled(_doubled(now, 1 << 2 * turn), 2 << 2 * turn), f"links-{turn + 1}")
        written.drop(f"links-{turn}")
        turn += 1
    sizes = now.groupBy("ring").agg(F.count("*").alias("n"))
    placed = now.join(sizes, "ring").select("id", "ring", ((F.col("n") - F.col("ahead")) % F.col("n")).alias("seq"))
    return edges.join(placed, "id").drop("id")


def nested(rings: DataFrame, key: list[str], written: Written, tile: float, grid: float, fill_holes: bool) -> DataFrame:
    """(key, part, polygon) of :func:`rings_of`, in degrees: outer rings with their holes, or without them."""
    points = F.array_sort(F.collect_list(F.struct("seq", "ax", "ay")))
    whole = rings.groupBy(*key, "ring").agg(points.alias("p"))
    x0, y0 = F.get("p", 0)["ax"], F.get("p", 0)["ay"]
    turn = F.aggregate(
        F.transform("p", lambda q, i: (q["ax"] - x0) * (F.coalesce(F.get("p", i + 1)["ay"], y0) - y0) - (F.coalesce(F.get("p", i + 1)["ax"], x0) - x0) * (q["ay"] - y0)),
        F.lit(0.0),
        lambda s, v: s + v,
    )
    at = lambda q: F.array(q["ax"] * F.lit(grid), q["ay"] * F.lit(grid))
    whole = whole.select(*key, "ring", turn.alias("turn"), F.concat(F.transform("p", at), F.array(at(F.get("p", 0)))).alias("points"))
    whole = written.save(whole, "rings")
    # A ring's first edge tells which other rings are around all of it, for they don't cross.
    first = rings.where("seq = 0").select(*key, F.col("ring").alias("inner"), ((F.col("ax") + F.col("bx")) / 2).alias("x"), ((F.col("ay") + F.col("by")) / 2).alias("y"), (F.col("ay") == F.col("by")).alias("level"), F.least("ax", "bx").alias("west"), F.greatest("ax", "bx").alias("east"))
    first = first.withColumn("column", _tile(F.col("x"), _OFF_X, tile)).withColumn("row", _tile(F.col("y"), _OFF_Y, tile))
    shells = whole.where("turn > 0").select(*key, "ring", F.col("turn").alias("size"))
    index = tile_index(rings.join(shells, [*key, "ring"], "left_semi").select(*key, "ring", *ENDS), [*key, "ring"], tile)
    around = first.join(index, [*key, "column", "row"]).where((F.col("ring") != F.col("inner")) & _inside(F.col("x"), F.col("y"), tile, F.col("level")))
    # A ring that has this edge as well, the other way round, is beside it.
    around = around.where(~F.exists("edges", lambda g: (F.least(g["ax"], g["bx"]) == F.col("west")) & (F.greatest(g["ax"], g["bx"]) == F.col("east")) & (g["ay"] + g["by"] == 2 * F.col("y"))))
    around = around.select(*key, "inner", "ring").join(shells, [*key, "ring"])
    if fill_holes:
        outer = whole.where("turn > 0").join(around.select(*key, F.col("inner").alias("ring")).distinct(), [*key, "ring"], "left_anti")
        return outer.select(*key, F.col("ring").alias("part"), F.array("points").alias("polygon"))
    owner = around.groupBy(*key, "inner").agg(F.min(F.struct("size", "ring"))["ring"].alias("part"))
    holes = whole.where("turn < 0").withColumnRenamed("ring", "inner").join(owner, [*key, "inner"])
    holes = holes.groupBy(*key, "part").agg(F.array_sort(F.collect_list(F.struct("inner", "points"))).alias("holes"))
    outer = whole.where("turn > 0").withColumnRenamed("ring", "part").join(holes, [*key, "part"], "left")
    inner = F.transform(F.coalesce("holes", F.array().cast("array<struct<inner:bigint,points:array<array<double>>>>")), lambda h: h["points"])
    return outer.select(*key, "part", F.concat(F.array("points"), inner).alias("polygon"))


def dissolved(polygons: DataFrame, key: list[str], *, fill_holes: bool = False, grid: float = GRID, tile: float = TILE) -> DataFrame:
    """(key, part, polygon): the union of ``polygons`` (key, owner, polygon) of each key.

    With a column ``sign``, polygons of sign -1 are taken away.  Polygons may
    overlap, touch, repeat and cross themselves; each is what its rings enclose an odd
    number of times.  Parts are simple rings, counter-clockwise, with holes,
    clockwise; parts that touch in a point are separate.  ``part`` numbers are
    unique and not dense.  Null or empty polygons and those without area add
    nothing; without any, the result is empty.
    """
    signed = polygons if "sign" in polygons.columns else polygons.withColumn("sign", F.lit(1))
    return dissolved_edges(segments(signed.select(*key, "owner", "sign", "polygon"), grid), key, fill_holes=fill_holes, grid=grid, tile=tile)


def dissolved_edges(edges: DataFrame, key: list[str], *, fill_holes: bool = False, grid: float = GRID, tile: float = TILE) -> DataFrame:
    """As :func:`dissolved`, of the polygons' edges (key, owner, sign, ends) as :func:`segments` returns them."""
    written, step = Written(edges.sparkSession, "arrangement"), tile / grid
    cut = noded(edges, key, written, step)
    rings = written.save(rings_of(borders(cut, key, written, step), key, written), "placed")
    return nested(rings, key, written, step, grid, fill_holes)


def polygonized(lines: DataFrame, key: list[str], *, grid: float = GRID, tile: float = TILE) -> DataFrame:
    """(key, part, polygon): the faces that lines (key, x1, y1, x2, y2) enclose, each with its holes.

    Lines may cross, touch, overlap and repeat.  The area outside of all is no face.
    A line that ends in the open stays in the ring of its face, there and back.
    """
    written, step = Written(lines.sparkSession, "faces"), tile / grid
    cut = noded(snapped(lines.select(*key, "x1", "y1", "x2", "y2"), grid).distinct(), key, written, step).distinct()
    back = cut.select(*key, F.col("bx").alias("ax"), F.col("by").alias("ay"), F.col("ax").alias("bx"), F.col("ay").alias("by"))
    rings = written.save(rings_of(cut.unionByName(back), key, written), "placed")
    return nested(rings, key, written, step, grid, False)


def _touching(first: DataFrame, second: DataFrame, grid: float, tile: float) -> DataFrame:
    """(a, b), perhaps more than once: polygons whose borders have a point in common."""
    step = tile / grid
    one, two = (segments(p.select(c, "polygon"), grid) for p, c in ((first, "a"), (second, "b")))
    other = [F.col(c).alias(f"{c}2") for c in ENDS]
    pairs = filed(one, step, 1.0).join(filed(two, step, 1.0).select("b", "column", "row", *other), ["column", "row"])

    def side(px: str, py: str, qx: str, qy: str, x: str, y: str) -> Column:
        """On which side of an edge a point lies: 1, 0 or -1."""
        return F.signum((F.col(qx) - F.col(px)) * (F.col(y) - F.col(py)) - (F.col(qy) - F.col(py)) * (F.col(x) - F.col(px)))

    across = (side("ax", "ay", "bx", "by", "ax2", "ay2") * side("ax", "ay", "bx", "by", "bx2", "by2") <= 0) & (
        side("ax2", "ay2", "bx2", "by2", "ax", "ay") * side("ax2", "ay2", "bx2", "by2", "bx", "by") <= 0
    )
    boxes = [F.greatest(f"a{c}", f"b{c}") >= F.least(f"a{c}2", f"b{c}2") for c in "xy"] + [F.greatest(f"a{c}2", f"b{c}2") >= F.least(f"a{c}", f"b{c}") for c in "xy"]
    return pairs.where(across & boxes[0] & boxes[1] & boxes[2] & boxes[3]).select("a", "b")


def lying_within(first: DataFrame, second: DataFrame, margin: float = 1e-6, grid: float = GRID, tile: float = TILE) -> DataFrame:
    """(a): the polygons (a, polygon) that, shrunk by ``margin``, lie within the union of polygons (polygon).

    One that touches the union's border from within lies within; one that passes it by
    more than the margin, or touches it from outside, does not, and neither does one of
    which nothing is left.
    """
    whole = dissolved(second.select(F.lit(0).alias("b"), F.monotonically_increasing_id().alias("owner"), "polygon"), ["b"], grid=grid, tile=tile)
    whole = Written(first.sparkSession, "within").save(whole.select("b", "polygon"), "whole")
    inner = offset(repaired(first.select("a", "polygon"), ["a"], grid=grid, tile=tile).drop("part"), ["a"], -margin, grid=grid, tile=tile)
    inner = Written(first.sparkSession, "within").save(inner, "inner")
    vertex = F.get(F.get("polygon", 0), 0)
    inside = covering(inner.select("a", "part", vertex[0].alias("x"), vertex[1].alias("y")), whole, ["b"], grid, tile).select("a", "part").distinct()
    parts = inner.groupBy("a").agg(F.count("*").alias("n")).join(inside.groupBy("a").agg(F.count("*").alias("n_inside")), "a")
    return parts.where("n = n_inside").select("a").join(_touching(inner, whole, grid, tile).select("a").distinct(), "a", "left_anti")


def meeting(first: DataFrame, second: DataFrame, grid: float = GRID, tile: float = TILE) -> DataFrame:
    """(a, b): pairs of polygons (a, polygon) and (b, polygon) that have a point in common; borders count.

    Either their borders meet, which edges tell that share a tile, or one lies within
    the other, which a vertex of it tells.  Each pair is returned once.
    """
    crossing = _touching(first, second, grid, tile)
    vertex = lambda p, c: p.select(c, F.get(F.get("polygon", 0), 0).alias("v")).where("v IS NOT NULL").select(c, F.col("v")[0].alias("x"), F.col("v")[1].alias("y"))
    within = covering(vertex(first, "a"), second, ["b"], grid, tile).select("a", "b")
    around = covering(vertex(second, "b"), first, ["a"], grid, tile).select("a", "b")
    return crossing.unionByName(within).unionByName(around).distinct()


def repaired(polygons: DataFrame, key: list[str], **settings) -> DataFrame:
    """(key, part, polygon): each polygon (key, polygon) by itself, as simple rings that don't cross, by the even-odd rule.

    Bow-ties become two parts, spikes and repeated edges go, holes that cross the
    outer ring are cut out of it.
    """
    return dissolved(polygons.select(*key, F.lit(0).alias("owner"), "polygon"), key, **settings)


def _pieces(polygons: DataFrame, key: list[str], distance: float, quarter: int) -> DataFrame:
    """(key, polygon): a rectangle on each edge, outside for a positive ``distance``, and a sector at each corner that leaves a gap.

    Outer rings go counter-clockwise and holes clockwise, so outside is always on the right.
    """
    rings = polygons.select(*key, F.explode("polygon").alias("r")).where(F.size("r") > 3)
    place = lambda i: F.get("r", i)
    count = F.size("r") - 1

    def corner(i: Column) -> Column:
        before, here, after = place((i + count - 1) % count), place(i), place(i + 1)
        return F.struct(*[p[k].alias(f"{n}{c}") for n, p in (("p", before), ("x", here), ("n", after)) for k, c in ((0, "0"), (1, "1"))])

    corners = rings.select(*key, F.inline(F.transform(F.sequence(F.lit(0), count - 1), corner)))
    unit = lambda dx, dy: (dy / F.sqrt(dx * dx + dy * dy), -dx / F.sqrt(dx * dx + dy * dy))
    (ax, ay), (bx, by) = unit(F.col("x0") - F.col("p0"), F.col("x1") - F.col("p1")), unit(F.col("n0") - F.col("x0"), F.col("n1") - F.col("x1"))
    d = F.lit(float(distance))
    corners = corners.select("*", ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"))
    point = lambda x, y: F.array(x, y)
    here, then = point(F.col("x0"), F.col("x1")), point(F.col("n0"), F.col("n1"))
    beside = lambda x, y, nx, ny: point(F.col(x) + d * F.col(nx), F.col(y) + d * F.col(ny))
    side = F.array(here, then, beside("n0", "n1", "bx", "by"), beside("x0", "x1", "bx", "by"), here)
    # The turn from one side's normal to the next; the normals part on the outside if it goes with the distance's sign.
    turn = F.atan2(F.col("ax") * F.col("by") - F.col("ay") * F.col("bx"), F.col("ax") * F.col("bx") + F.col("ay") * F.col("by"))
    start = F.atan2("ay", "ax")
    steps = F.ceil(F.abs(turn) / F.lit(1.5707963267948966 / quarter)).cast("int")
    arc = F.transform(
        F.sequence(F.lit(0), steps),
        lambda s: F.when(s == 0, beside("x0", "x1", "ax", "ay")).when(s == steps, beside("x0", "x1", "bx", "by")).otherwise(
            point(F.col("x0") + d * F.cos(start + turn * s / steps), F.col("x1") + d * F.sin(start + turn * s / steps))
        ),
    )
    opens = (turn * F.lit(1.0 if distance > 0 else -1.0)) > 1e-12
    sector = F.when(opens, F.array(F.concat(F.array(here), arc, F.array(here))))
    both = corners.select(*key, F.explode(F.filter(F.array(F.array(side), sector), lambda p: p.isNotNull())).alias("polygon"))
    return both


def _grown(polygons: DataFrame, key: list[str], distance: float, quarter: int, fill_holes: bool, grid: float, tile: float) -> DataFrame:
    """The union of ``polygons`` and of their pieces on each side given: (distance, sign)."""
    sides = [(distance, 1), (-distance, 1)] if distance > 0 else [(distance, -1)]
    all_of = polygons.select(*key, "polygon", F.lit(1).alias("sign"))
    for d, sign in sides:
        all_of = all_of.unionByName(_pieces(polygons, key, d, quarter).withColumn("sign", F.lit(sign)))
    written = Written(polygons.sparkSession, "offset")
    all_of = written.save(all_of.withColumn("owner", F.monotonically_increasing_id()), "pieces")
    return dissolved(all_of, key, fill_holes=fill_holes, grid=grid, tile=tile)


def offset(polygons: DataFrame, key: list[str], distance: float, *, quarter: int = 8, fill_holes: bool = False, grid: float = GRID, tile: float = TILE) -> DataFrame:
    """(key, part, polygon): the union of ``polygons`` (key, polygon) grown by ``distance`` degrees, or shrunk by a negative one.

    To be shrunk, polygons must be simple and apart, with outer rings
    counter-clockwise and holes clockwise, as :func:`dissolved` returns them; to be grown
    they may overlap and run either way.  Corners are rounded, by ``quarter`` steps for
    a right angle.
    """
    return _grown(polygons, key, distance, quarter, fill_holes, grid, tile)


def closed(polygons: DataFrame, key: list[str], distance: float, *, quarter: int = 8, fill_holes: bool = False, grid: float = GRID, tile: float = TILE) -> DataFrame:
    """(key, part, polygon): the union of ``polygons`` (key, polygon) without gaps, inlets and holes narrower than twice ``distance``.

    Grown by ``distance`` and shrunk by it again; wider openings stay, and so does the
    outline, but for inner corners, which are rounded.
    """
    wide = offset(polygons, key, distance, quarter=quarter, fill_holes=fill_holes, grid=grid, tile=tile)
    return offset(wide.drop("part"), key, -distance, quarter=quarter, fill_holes=fill_holes, grid=grid, tile=tile)
