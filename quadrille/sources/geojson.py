"""GeoJSON in and out.

``coordinates`` is read as raw JSON text, so any geometry type fits one schema,
and parsed by type.  A multi-line FeatureCollection is one split: write a large
one with :func:`write_collection` or :func:`to_lines`, one feature a line, and read
it with :func:`read_feature_lines`.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrille.functions.geometry import MULTIPOLYGON, POLYGON, RING

GEOMETRY = "struct<type:string, coordinates:string>"
FEATURE = f"struct<type:string, geometry:{GEOMETRY}, properties:map<string,string>>"
COLLECTION = f"type string, features array<{FEATURE}>, geometry {GEOMETRY}, coordinates string, properties map<string,string>"


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """(file, seq, geometry, properties) of a FeatureCollection, a Feature or a bare geometry.

    A collection under ``data`` is unwrapped.  Features keep their position.
    """
    schema = f"{COLLECTION}, data struct<type:string, features:array<{FEATURE}>>"
    whole = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("file", F.input_file_name())
    own = F.when(F.col("type") == "Feature", F.struct(F.lit("Feature").alias("type"), "geometry", "properties"))
    bare = F.struct(
        F.lit("Feature").alias("type"), F.struct("type", "coordinates").alias("geometry"), F.create_map().cast("map<string,string>").alias("properties")
    )
    single = F.array(F.coalesce(own, F.when(F.col("coordinates").isNotNull(), bare)))
    features = F.coalesce("features", "data.features", F.when(F.col("type").isNotNull() & (F.col("type") != "FeatureCollection"), single), F.array().cast(f"array<{FEATURE}>"))
    return whole.select("file", F.posexplode(features).alias("seq", "f")).where("f is not null").select("file", "seq", "f.geometry", "f.properties")


def read_feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`read_features`, of a collection with one feature a line, in as many tasks as the files have splits.

    ``path`` is what :func:`write_collection`, :func:`joined_collection` or :func:`to_lines`
    wrote: part files go by name.  ``seq`` (long) grows with the position, across all
    files, and is not dense.  A line that is no feature, head or tail is an error.
    """
    place = [F.col(f"_metadata.{c}").alias(c) for c in ("file_path", "file_block_start")]
    lines = spark.read.text(path).select("value", *place, F.monotonically_increasing_id().alias("id"))
    # One row a split: its rank and the line's number in its task make up the position.
    order = Window.orderBy("file_path", "file_block_start")
    splits = lines.select("file_path", "file_block_start").distinct().withColumn("nth", F.row_number().over(order).cast("long"))
    seq = F.shiftleft("nth", 33).bitwiseOR(F.col("id").bitwiseAND(F.lit((1 << 33) - 1)))
    text = F.trim(F.col("value"))
    body = F.rtrim(F.ltrim(text, F.lit(", ")), F.lit(", "))
    # A head ends in the bracket that a tail begins with; a feature does neither.
    frame = (text.startswith("{") & text.endswith("[")) | text.startswith("]") | (text == "")
    f, wrong = F.from_json(body, FEATURE), F.raise_error(F.concat(F.lit("not one feature a line: "), "file_path"))
    # Exploded, a line is parsed once, whatever is asked of it, and checked when it is known to be no frame.
    held = F.explode(F.when(~frame, F.array(F.when(f["type"] == "Feature", f).otherwise(wrong))))
    found = lines.join(F.broadcast(splits), ["file_path", "file_block_start"]).select(F.col("file_path").alias("file"), seq.alias("seq"), held.alias("f"))
    return found.select("file", "seq", "f.geometry", "f.properties")


def lines_of(geometry: Column) -> Column:
    """Vertices of a LineString, or of a MultiLineString end to end; null for anything else or malformed."""
    kind, text = geometry["type"], geometry["coordinates"]
    return F.when(kind == "LineString", F.from_json(text, RING)).when(kind == "MultiLineString", F.flatten(F.from_json(text, POLYGON)))


def polygons_of(geometry: Column) -> Column:
    """Parts of a Polygon or MultiPolygon; null for anything else."""
    kind, text = geometry["type"], geometry["coordinates"]
    return F.when(kind == "Polygon", F.array(F.from_json(text, POLYGON))).when(kind == "MultiPolygon", F.from_json(text, MULTIPOLYGON))


def read_centerlines(spark: SparkSession, path: str, by_line: bool = False) -> DataFrame:
    """(seq, street_name, class, points); features without usable lines have no row.  ``by_line``: :func:`read_feature_lines`."""
    found = read_feature_lines(spark, path) if by_line else read_features(spark, path)
    return found.select(
        "seq", F.col("properties")["STREET_NAME"].alias("street_name"), F.col("properties")["CLASS"].alias("class"), lines_of(F.col("geometry")).alias("points")
    ).where(F.size("points") > 0)


def read_boundary(spark: SparkSession, path: str) -> DataFrame:
    """(part, polygon) of every polygon in a boundary file, however it is wrapped."""
    found = read_features(spark, path).select("seq", F.posexplode(polygons_of(F.col("geometry"))).alias("n", "polygon"))
    return found.select((F.col("seq").cast("long") * 100_000 + F.col("n")).alias("part"), "polygon")


def polygon_edges(polygons: DataFrame, owner: str, fill_holes: bool = False) -> DataFrame:
    """(owner, x1, y1, x2, y2) of polygons (owner, polygon); with ``fill_holes`` of outer rings alone."""
    from quadrille.functions.geometry import ring_edges

    rings = F.slice("polygon", 1, 1) if fill_holes else F.col("polygon")
    return polygons.select(owner, F.explode(rings).alias("r")).select(owner, F.inline(ring_edges(F.col("r"))))


def shape_json(geometry: Column, kind: str) -> Column:
    """A polygon, or a multipolygon, as JSON text; a multipolygon of one part is written as that polygon."""
    text = lambda k, c: F.concat(F.lit(f'{{"type":"{k}","coordinates":'), F.to_json(c), F.lit("}"))
    if kind == "Polygon":
        return text(kind, geometry)
    return F.when(F.size(geometry) == 1, text("Polygon", F.get(geometry, F.lit(0)))).otherwise(text(kind, geometry))


def feature_json(cells: DataFrame, properties: list[str], kind: str = "Polygon") -> DataFrame:
    """(chi_id, json): one GeoJSON feature per cell; nulls are kept, text is not escaped."""
    held = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"})
    text = F.concat(F.lit('{"type":"Feature","geometry":'), shape_json(F.col("geometry"), kind), F.lit(',"properties":'), held, F.lit("}"))
    return cells.select("chi_id", text.alias("json"))


def read_published(spark: SparkSession, root: str, version: str, name: str = "grid.geojson") -> DataFrame:
    """Features of a published version, ``root/version/name``; a version that isn't there is an error."""
    try:
        return read_features(spark, f"{root.rstrip('/')}/{version}/{name}")
    except AnalysisException as missing:
        raise ValueError(f"Could not load the grid: no version {version} under {root}") from missing


def to_lines(features: DataFrame, path: str) -> None:
    """One feature per line, in as many files as there are partitions."""
    features.select(F.col("json").alias("value")).write.text(path)


def feature_collection(features: DataFrame, properties: dict) -> DataFrame:
    """One row, ``json``: the whole collection, features by id.  For grids, which are small; use :func:`to_lines` else."""
    import json

    head = json.dumps(properties, ensure_ascii=False)[1:-1]
    rows = features.agg(F.array_sort(F.collect_list(F.struct("chi_id", "json"))).alias("f"))
    text = F.concat(
        F.lit(f'{{"type":"FeatureCollection","properties":{{{head}{", " if head else ""}"count":'),
        F.size("f").cast("string"),
        F.lit('},"features":['),
        F.array_join(F.transform("f", lambda x: x["json"]), ","),
        F.lit("]}"),
    )
    return rows.select(text.alias("json"))


def write_collection(features: DataFrame, properties: dict, path: str) -> None:
    """Writes the text of :func:`feature_collection` as part files which, in the order of their names, make up one document.

    Features (chi_id, json) are sorted in ranges, so no task holds them all; the head
    with their number and the tail are rows like others.  An existing folder is an
    error; equal ids stay side by side.
    """
    import json

    spark = features.sparkSession
    whole = features.agg(F.count("*").alias("n"), F.min(F.struct("chi_id", "json")).alias("first")).first()
    head = json.dumps(properties, ensure_ascii=False)[1:-1]
    ends = [(0, "", f'{{"type":"FeatureCollection","properties":{{{head}{", " if head else ""}"count":{whole["n"]}}},"features":['), (3, "", "]}")]
    # The first feature has no comma; of rows equal to it only one is the first.
    is_first = F.lit(False)
    if whole["n"]:
        of = Window.partitionBy("chi_id", "json").orderBy("json")
        known = F.struct("chi_id", "json") == F.struct(F.lit(whole["first"]["chi_id"]).alias("chi_id"), F.lit(whole["first"]["json"]).alias("json"))
        is_first = known & (F.row_number().over(of) == 1)
    rows = features.select("chi_id", "json", is_first.alias("lead"))
    rows = rows.select(F.when(F.col("lead"), 1).otherwise(2).alias("part"), "chi_id", F.concat(F.when(F.col("lead"), "").otherwise(","), "json").alias("value"))
    lines = spark.createDataFrame(ends, "part int, chi_id string, value string").unionByName(rows)
    # The driver samples the range keys, so they are no whole features.
    ranges = lines.repartitionByRange("part", "chi_id", F.substring("value", 1, 64))
    ranges.sortWithinPartitions("part", "chi_id", "value").select("value").write.text(path)


def joined_collection(spark: SparkSession, path: str, to: str) -> None:
    """One file ``to`` of the part files in ``path``, in order; bytes are streamed from file to file, none are kept."""
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    source, target = hadoop.fs.Path(path), hadoop.fs.Path(to)
    fs, out_fs = source.getFileSystem(conf), target.getFileSystem(conf)
    parts = sorted(str(s.getPath()) for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))
    out = out_fs.create(target, False)
    try:
        for part in parts:
            stream = fs.open(hadoop.fs.Path(part))
            hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
            stream.close()
    finally:
        out.close()
