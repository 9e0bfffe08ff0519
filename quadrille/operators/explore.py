"""What a map of the cells needs: bounds, pixels, labels, search and details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrille.constants import PREFIX
from quadrille.functions.geometry import bounds

WIDTH, PAD = 760, 8
#: Characters of the longest grams of the search index, and keys that share a gram.
GRAM, SALTS = 3, 16


def map_frame(cells: DataFrame, width: int = WIDTH, pad: int = PAD) -> DataFrame:
    """One row: min_x, max_x, min_y, max_y, sx (pixels a degree), height, cell_lon, font_px.

    ``cells``: chi_id and geometry (polygon).  The font fits the first cell's width.
    """
    ring = F.get(F.col("geometry"), F.lit(0))
    edges = cells.select("chi_id", *[c.alias(n) for n, c in bounds(ring).items()])
    out = edges.agg(
        F.min("west").alias("min_x"),
        F.max("east").alias("max_x"),
        F.min("south").alias("min_y"),
        F.max("north").alias("max_y"),
        F.min_by(F.col("east") - F.col("west"), "chi_id").alias("cell_lon"),
    )
    out = out.withColumn("sx", F.lit(float(width - 2 * pad)) / (F.col("max_x") - F.col("min_x")))
    out = out.withColumn("height", (F.col("max_y") - F.col("min_y")) * F.col("sx") + F.lit(2.0 * pad))
    return out.withColumn("font_px", F.greatest(F.lit(4.0), F.least(F.lit(8.0), F.col("sx") * F.col("cell_lon") / F.lit(5.5))))


def point_strings(cells: DataFrame, frame: DataFrame, pad: int = PAD) -> DataFrame:
    """(chi_id, points): each outer ring in pixels, to one place."""
    ring = F.get(F.col("geometry"), F.lit(0))
    px = lambda lon: F.lit(float(pad)) + (lon - F.col("min_x")) * F.col("sx")
    py = lambda lat: F.col("height") - F.lit(float(pad)) - (lat - F.col("min_y")) * F.col("sx")
    # The frame is one row.
    joined = cells.join(F.broadcast(frame), F.lit(True))
    text = F.array_join(F.transform(ring, lambda p: F.format_string("%.1f,%.1f", px(p[0]), py(p[1]))), " ")
    return joined.select("chi_id", text.alias("points"))


def label_text(label: Column) -> Column:
    """A label without the mark at its end."""
    return F.regexp_replace(label, r"\s*χ$", "")


def search(cells: DataFrame, query: str) -> DataFrame:
    """The first cell, by id, whose id is the query or whose name or label holds it; none for a blank query."""
    q = query.strip().lower()
    if not q:
        return cells.limit(0)
    own = F.replace(F.lower("chi_ordinate"), F.lit(PREFIX), F.lit("")) == q
    hit = own | F.lower("name").contains(q) | F.lower("label").contains(q)
    first = cells.where(hit).agg(F.min_by(F.struct(*cells.columns), "chi_id").alias("c"))
    return first.where("c is not null").select("c.*")


def _grams(text: Column, size: int) -> Column:
    """The runs of ``size`` characters in a text; none in a shorter or null one."""
    runs = F.transform(F.sequence(F.lit(1), F.length(text) - F.lit(size - 1)), lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, runs).otherwise(F.array().cast("array<string>"))


def search_index(cells: DataFrame, salts: int = SALTS) -> DataFrame:
    """(whole, gram, salt, chi_id): what :func:`search_all` looks up; worth writing once for many searches.

    Runs of one to three characters of a cell's name and label, each once, and its
    own ordinate whole.  The cells of a gram lie under ``salts`` keys, so that the
    commonest is no one task's.
    """
    texts = [F.lower("name"), F.lower("label")]
    grams = F.array_distinct(F.flatten(F.array(*[_grams(t, k) for t in texts for k in range(1, GRAM + 1)])))
    own = F.replace(F.lower("chi_ordinate"), F.lit(PREFIX), F.lit(""))
    filed = F.transform(grams, lambda g: F.struct(F.lit(False).alias("whole"), g.alias("gram")))
    both = F.concat(filed, F.array(F.struct(F.lit(True).alias("whole"), own.alias("gram"))))
    return cells.select(F.inline(both), F.pmod(F.xxhash64("chi_id"), F.lit(salts)).cast("int").alias("salt"), "chi_id")


def search_all(cells: DataFrame, queries: DataFrame, index: DataFrame | None = None, salts: int = SALTS) -> DataFrame:
    """(query, and the columns of ``cells``): what :func:`search` finds for each distinct query; no row without a hit.

    Each query's rarest gram names the cells to look at, by equi-join with the
    index, and these are checked in full.  Blank and null queries find nothing.
    ``index`` is a :func:`search_index` of the cells with as many salts.
    """
    index = search_index(cells, salts) if index is None else index
    q = F.lower(F.regexp_replace("query", r"(?U)^\s+|\s+$", ""))
    asked = queries.select("query").distinct().withColumn("q", q).where("q <> ''")
    runs = F.when(F.length("q") < GRAM, F.array("q")).otherwise(_grams(F.col("q"), GRAM))
    wanted = asked.select("query", F.explode(F.array_distinct(runs)).alias("gram"))
    sizes = index.where("not whole").join(wanted.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    # A gram that no cell has is the rarest.
    rarest = wanted.join(sizes, "gram", "left").groupBy("query").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    looked = rarest.select("query", F.lit(False).alias("whole"), "gram").unionByName(asked.select("query", F.lit(True).alias("whole"), F.col("q").alias("gram")))
    looked = looked.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    near = looked.join(index, ["whole", "gram", "salt"]).select("query", "chi_id").distinct().join(asked, "query")
    held = cells.select("chi_id", F.struct(*cells.columns).alias("cell"))
    met = near.join(held, "chi_id")
    own = F.replace(F.lower("cell.chi_ordinate"), F.lit(PREFIX), F.lit("")) == F.col("q")
    holds = [F.contains(F.lower(f"cell.{c}"), F.col("q")) for c in ("name", "label")]
    met = met.where(own | holds[0] | holds[1])
    return met.groupBy("query").agg(F.min_by("cell", "chi_id").alias("cell")).select("query", "cell.*")


def select_cell(cells: DataFrame, ord_: str) -> DataFrame:
    return cells.where(F.col("chi_ordinate") == ord_)


def parse_link(text: Column) -> Column:
    """The ordinate that a deep link names, or null."""
    found = F.regexp_extract(text, "chi=([A-Za-z0-9]+)", 1)
    return F.when(found != "", F.concat(F.lit(PREFIX), F.upper(found)))


def format_link(ord_: Column) -> Column:
    return F.concat(F.lit("#chi="), F.replace(ord_, F.lit(PREFIX), F.lit("")))


def detail_card(cells: DataFrame) -> DataFrame:
    """(chi_id, ordinate, name, label, canonical, center, cell, edge) as shown; absent lines are null.

    ``label_canon``, ``area_sqmi`` and ``edge`` may be missing from ``cells``.
    """
    has = set(cells.columns)
    null = F.lit(None).cast("string")
    canon = F.when((F.col("label_canon") != "") & (F.col("label_canon") != F.col("label")), F.col("label_canon")) if "label_canon" in has else null
    size = F.coalesce(F.format_string("%.2f sq mi", "area_sqmi"), F.lit("1 sq mile")) if "area_sqmi" in has else F.lit("1 sq mile")
    if "area_sqmi" in has:
        size = F.when(F.col("area_sqmi").isNull(), "1 sq mile").otherwise(size)
    edge = F.when(F.col("edge"), "city-clipped") if "edge" in has else null
    center = F.format_string("%.4f, %.4f", F.round("lat", 6), F.round("lon", 6))
    return cells.select(
        "chi_id", F.col("chi_ordinate").alias("ordinate"), "name", "label", canon.alias("canonical"), center.alias("center"), size.alias("cell"), edge.alias("edge_note")
    )


def join_versions(left: DataFrame, right: DataFrame) -> DataFrame:
    """Cells of two versions side by side by id; a version without the cell has nulls."""
    a = left.select("chi_id", F.col("name").alias("name_a"), F.col("label").alias("label_a"))
    b = right.select("chi_id", F.col("name").alias("name_b"), F.col("label").alias("label_b"))
    return a.join(b, "chi_id", "full")
