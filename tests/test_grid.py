import json
import math
import random
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quadrille import constants as C
from quadrille import inputs
from quadrille.operators import explore, lines, overlay, roads
from quadrille.operators.lattice import clip_lattice, extent_of, lattice, with_rings
from quadrille.operators.locate import cover_index, locate
from quadrille.operators.places import summarise_places
from quadrille.plans import grids
from quadrille.sources import geojson, tables


def test_default_lattice(spark):
    cells = lattice(spark)
    assert cells.count() == 952 and cells.select("chi_ordinate").distinct().count() == 952


def test_boundary_that_only_touches_or_contains_cells(spark):
    # The square of the cell 2S2E itself: its eight neighbours touch it.
    south, north = C.ORIGIN_LAT - 2 * C.MILE_LAT, C.ORIGIN_LAT - C.MILE_LAT
    ring = inputs.box_ring(south, north, C.ORIGIN_LON + C.MILE_LON, C.ORIGIN_LON + 2 * C.MILE_LON)
    edges = inputs.ring_edges(spark, {0: ring}, "part").drop("part")
    kept = {r["chi_id"] for r in clip_lattice(lattice(spark, extent_of(edges)), edges).collect()}
    assert "2S2E" in kept and kept <= {f"{s}S{e}E" for s in (1, 2, 3) for e in (1, 2, 3)}
    wide = inputs.ring_edges(spark, {0: inputs.box_ring(41.0, 43.0, -89.0, -86.0)}, "part").drop("part")
    assert clip_lattice(lattice(spark), wide).count() == 952
    assert grids.regular_grid(spark, wide.where("false")).count() == 0


def test_lookup_against_every_cell(spark):
    draw = random.Random(6)
    cells = with_rings(lattice(spark))
    shapes = [(r["chi_id"], r["geometry"][0]) for r in cells.collect()]
    spots = [(i, draw.uniform(41.6, 42.1), draw.uniform(-88, -87.5)) for i in range(300)]
    corners = [p for _, ring in draw.sample(shapes, 40) for p in ring[:4]]
    spots += [(1000 + i, p[1], p[0]) for i, p in enumerate(corners)] + [(5000, None, 1.0), (5001, 0.0, 0.0)]
    found = locate(spark.createDataFrame(spots, "id int, lat double, lon double"), cover_index(cells, "chi_id", ["chi_id"]), squares=True)
    by = {r["id"]: r["cell"] and r["cell"]["chi_id"] for r in found.collect()}
    assert len(by) == len(spots)
    for i, y, x in spots:
        hits = [] if y is None else sorted(c for c, r in shapes if r[0][0] <= x <= r[1][0] and r[0][1] <= y <= r[2][1])
        assert by[i] == (hits[0] if hits else None)


def test_places_of_a_cell(spark):
    cells = with_rings(lattice(spark)).where("chi_id in ('1S1W', '1S2W')").withColumn("name", F.lit("n"))
    cells = cells.unionByName(cells.limit(1).withColumn("chi_id", F.lit("0")).withColumn("geometry", F.lit(None).cast("array<array<array<double>>>")))
    y, x = C.ORIGIN_LAT - 0.5 * C.MILE_LAT, C.ORIGIN_LON - 0.5 * C.MILE_LON
    given = [("p%d" % i, "b" if i % 2 else "a", None if i == 3 else "n", y, x) for i in range(10)]
    given += [("q1", None, "z", y, x), ("q2", "", "y", y, x), (None, "c", "n", y, x), ("r", "a", "n", None, x), ("s", "a", "n", y, None), ("t", "a", "n", 0.0, 0.0)]
    found = summarise_places(cells, spark.createDataFrame(given, "poi_id string, category string, name string, lat double, lng double"), squares=True)
    by = {r["chi_id"]: r for r in found.collect()}
    assert set(by) == {"1S1W", "1S2W"}
    assert by["1S2W"]["place_ids"] == [] and by["1S2W"]["counts_by_category"] == {}
    want = ["q2", "q1", "p0", "p2", "p4", "p6", "p8", "p3", "p1", "p5", "p7", "p9", None]
    assert by["1S1W"]["place_ids"] == want and by["1S1W"]["featured_place_ids"] == want[:8]
    assert by["1S1W"]["counts_by_category"] == {"a": 5, "b": 5, "c": 1}


def brute_namer(records, lat, lon):
    """Tier after tier, with strict nearness and the earliest record on ties."""
    def best(axis, tiers, miles):
        ux, ua = (C.MILE_LON, C.MILE_LAT) if axis == "avenue" else (C.MILE_LAT, C.MILE_LON)
        x, a = (lon, lat) if axis == "avenue" else (lat, lon)
        reach, name = miles * ux, None
        for t in tiers:
            for r in sorted((r for r in records if r["axis"] == axis and r["tier"] == t), key=lambda r: r["seq"]):
                if r["lo"] - 0.2 * ua <= a <= r["hi"] + 0.2 * ua and abs(r["med"] - x) < reach:
                    reach, name = abs(r["med"] - x), r["name"]
        return name

    return tuple(best(a, (0,), 0.6) or best(a, (1,), 0.6) or best(a, (0, 1), 1.6) for a in ("avenue", "street"))


def test_namer_against_brute_force(spark):
    draw = random.Random(12)
    rows = []
    for seq in range(60):
        axis = draw.choice(["avenue", "street"])
        lo_x, hi_x, lo_a, hi_a = (-87.9, -87.5, 41.65, 42.0) if axis == "avenue" else (41.65, 42.0, -87.9, -87.5)
        a, b = sorted((draw.uniform(lo_a, hi_a), draw.uniform(lo_a, hi_a)))
        rows.append((axis, draw.choice([0, 1, 1]), seq, f"r{seq}", f"R{seq}", round(draw.uniform(lo_x, hi_x), 2), a, b))
    records = spark.createDataFrame(rows, "axis string, tier int, seq bigint, base string, name string, med double, lo double, hi double")
    cells = lattice(spark)
    found = {r["chi_id"]: (r["avenue"], r["street"]) for r in roads.nearest_roads(cells, records).collect()}
    kept = [r.asDict() for r in records.collect()]
    for c in cells.collect():
        assert found.get(c["chi_id"], (None, None)) == brute_namer(kept, c["lat"], c["lon"])
    assert roads.nearest_roads(cells, records.where("axis = 'avenue' or tier = 1")).count() == 0


def test_fits_match_polyfit_and_need_six_vertices(spark):
    draw = np.random.default_rng(2)
    y = draw.uniform(41.6, 42.0, 50)
    state = [("state", i, float(-87.6 + 0.02 * (v - 41.8) + draw.normal(0, 1e-4)), float(v)) for i, v in enumerate(y)]
    few = [("madison", i, -87.6 - i / 100, 41.88) for i in range(5)]
    vertices = spark.createDataFrame(state + few, "base string, seq bigint, lon double, lat double")
    (row,) = lines.fit_lines(vertices, lines.anchors(spark)).collect()
    want = np.polyfit([r[3] for r in state], [r[2] for r in state], 1)
    assert (row["axis"], row["idx"]) == ("ns", 0) and np.allclose([row["slope"], row["intercept"]], want, rtol=1e-7)
    with pytest.raises(ValueError, match="two or more"):
        lines.check_lines(lines.complete_lines(lines.fit_lines(vertices, lines.anchors(spark))))


def star(draw, n):
    angle = np.sort(draw.uniform(0, 2 * np.pi, n))
    radius = draw.uniform(0.2, 1.0, n)
    return np.stack([radius * np.cos(angle), radius * np.sin(angle)], 1)


def test_split_keeps_area_and_sides():
    draw = np.random.default_rng(4)
    for _ in range(60):
        ring = star(draw, int(draw.integers(4, 40)))
        pieces = [ring]
        for m, c in zip(draw.normal(0, 0.3, 5), draw.uniform(-0.5, 0.5, 5), strict=True):
            after = []
            for p in pieces:
                below, above = overlay.split_ring(p, p[:, 0] - (m * p[:, 1] + c), p[:, 1])
                for q, sign in [(q, -1) for q in below] + [(q, 1) for q in above]:
                    assert (sign * (q[:, 0] - (m * q[:, 1] + c)) >= -1e-9).all()
                    after.append(q)
            pieces = after
        assert sum(map(overlay.area, pieces)) == pytest.approx(overlay.area(ring), rel=1e-9)


def test_lines_through_vertices_and_along_edges():
    ring = np.array([[0, 0], [2, 0], [2, 2], [1, 2], [1, 1], [0, 1]], float)
    below, above = overlay.split_ring(ring, ring[:, 0] - 1.0, ring[:, 1])
    assert sum(map(overlay.area, below)) == pytest.approx(1) and sum(map(overlay.area, above)) == pytest.approx(2)
    below, above = overlay.split_ring(ring, ring[:, 0] - 2.0, ring[:, 1])
    assert sum(map(overlay.area, below + above)) == pytest.approx(3)


def test_inner_point_lies_inside():
    draw = np.random.default_rng(9)
    for _ in range(200):
        ring = star(draw, 12)
        x, y = overlay.inner_point([ring])
        a, b = ring, np.roll(ring, -1, 0)
        crosses = ((a[:, 1] > y) != (b[:, 1] > y)) & (x < a[:, 0] + (y - a[:, 1]) * (b[:, 0] - a[:, 0]) / np.where(b[:, 1] == a[:, 1], 1, b[:, 1] - a[:, 1]))
        assert crosses.sum() % 2 == 1


def city(spark):
    ring = [list(p) for p in [*inputs.CITY, inputs.CITY[0]]]
    return spark.createDataFrame([(0, [ring])], "part int, polygon array<array<array<double>>>"), np.array(inputs.CITY)


def test_street_grid_tiles_the_city(spark, sf_dir):
    boundary, ring = city(spark)
    cells = grids.street_grid(boundary, inputs.centerlines(spark, sf_dir)).cache()
    total = cells.agg(F.sum("area")).first()[0]
    assert total == pytest.approx(overlay.area(ring), rel=1e-9)
    rows = cells.collect()
    assert len({r["chi_ordinate"] for r in rows}) == len(rows)
    assert {r["edge"] for r in rows} == {True, False}
    assert all(r["flag"] == (not r["edge"] and not 0.9 <= r["area_sqmi"] <= 1.1) for r in rows)


@pytest.mark.parametrize("gap", [0.0, 5e-6, 0.5])
def test_distance_of_faces_is_that_of_a_small_outline(gap):
    # A notch ends on, just short of or well above the middle face, which has no vertex at the outline.
    notch = [(4, 4), (2.1, 4), (2, 2 + gap), (1.9, 4), (0, 4)]
    small = np.array([(0, 0), (4, 0), *notch], float)
    many = np.stack([np.linspace(0, 4, 100_001), np.zeros(100_001)], 1)
    large = np.concatenate([many, np.array(notch, float)])
    cut = overlay._strip_faces([(0.0, 1.0), (0.0, 3.0)], [(0.0, 1.0), (0.0, 2.0)])
    near = []
    for ring in (small, large):
        frame = pd.DataFrame({"part": [0], "rings": [[ring.tolist()]], "strip": [1]})
        faces = [(min(y for _, y in r), n) for r, n in next(cut(iter([frame])))[["ring", "near"]].itertuples(index=False)]
        near.append([n for _, n in sorted(faces)])
    assert near[1] == pytest.approx(near[0], abs=1e-12)
    assert near[1] == pytest.approx([0, gap, 0], abs=1e-12)


def test_dissolve_cancels_shared_edges(spark):
    cells = with_rings(lattice(spark)).where("ks between 0 and 2 and kw between 0 and 2").select("chi_id", F.col("geometry").alias("polygon"))
    assert overlay.dissolve(geojson.polygon_edges(cells, "chi_id")).count() == 12


def rings_of(spark, polygons, **options):
    rows = [(i, [[[float(v) for v in p] for p in [*r, r[0]]] for r in rings]) for i, rings in enumerate(polygons)]
    given = spark.createDataFrame(rows, "part bigint, polygon array<array<array<double>>>")
    return given, [np.array(r["ring"])[:-1] for r in overlay.outline_parts(given, **options).orderBy("part").collect()]


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def test_outline_of_adjoining_polygons(spark):
    # Borders with other vertices, a hole between them, a part of its own, and one that touches in a point.
    given = [[box(0, 0, 0.02, 0.01)], [box(0, 0.01, 0.01, 0.01)], [box(0.01, 0.01, 0.01, 0.01)], [box(0.05, 0, 0.01, 0.01)], [box(0.02, 0.02, 0.01, 0.01)]]
    _, found = rings_of(spark, given)
    assert sorted(round(overlay.area(r), 12) for r in found) == [0.0001, 0.0001, 0.0004]
    ring = [[box(0, 0, 0.03, 0.01)], [box(0, 0.02, 0.03, 0.01)], [box(0, 0.01, 0.01, 0.01)], [box(0.02, 0.01, 0.01, 0.01)]]
    _, found = rings_of(spark, ring)
    assert [round(overlay.area(r), 12) for r in found] == [0.0009]
    # A hole with an island, and a seam between neighbours.
    _, found = rings_of(spark, [[box(0, 0, 0.03, 0.03), box(0.01, 0.01, 0.01, 0.01)], [box(0.01, 0.01, 0.01, 0.01)]])
    assert [round(overlay.area(r), 12) for r in found] == [0.0009]
    _, found = rings_of(spark, [[box(0, 0, 0.01, 0.01)], [box(0.010004, 0.002, 0.01, 0.005)]], seam=1e-5)
    assert len(found) == 1 and overlay.area(found[0]) == pytest.approx(0.00015, rel=1e-2)


def test_adjoining_parts_are_flagged_like_their_union(spark, sf_dir):
    west, south, wide, high, cut = -87.86, 41.70, 0.30, 0.30, -87.7234
    whole = box(west, south, wide, high)
    parts = [[(west, south), (cut, south), (cut, 41.8), (cut, south + high), (west, south + high)], box(cut, south, west + wide - cut, high)]
    out = []
    for polygons in ([whole], parts):
        given, _ = rings_of(spark, [[r] for r in polygons])
        cells = grids.street_grid(given, inputs.centerlines(spark, sf_dir)).select("chi_id", "edge", "flag", F.round("area_sqmi", 2).alias("a"))
        out.append(sorted(map(tuple, cells.collect())))
    assert out[0] == out[1] and {r[1] for r in out[0]} == {True, False}


def test_distance_to_another_part(spark):
    lines_ = spark.createDataFrame([("ns", 0, 0.0, 0.5), ("ew", 0, 0.0, 0.5)], "axis string, idx int, slope double, intercept double")
    gap = 5e-6
    rows = [(0, [list(map(float, p)) for p in [*box(0, 0, 1, 1), (0, 0)]]), (1, [list(map(float, p)) for p in [*box(1 + gap, 0.2, 0.1, 0.1), (1 + gap, 0.2)]])]
    outlines = spark.createDataFrame(rows, "part bigint, ring array<array<double>>")
    assert overlay._close_parts(outlines).count() == 2
    assert overlay.overlay_faces(outlines, lines_).where("near > 0").count() == 0


def test_published_versions(spark, tmp_path):
    (tmp_path / "v7").mkdir()
    write(tmp_path / "v7" / "grid.geojson", {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"chi_id": "1S1W"}, "geometry": SQUARE}]})
    assert geojson.read_published(spark, str(tmp_path), "v7").first()["properties"]["chi_id"] == "1S1W"
    with pytest.raises(ValueError, match="Could not load the grid"):
        geojson.read_published(spark, str(tmp_path), "v8")


LINE = {"type": "LineString", "coordinates": [[-87.6, 41.8], [-87.6, 41.9]]}
MULTI = {"type": "MultiLineString", "coordinates": [[[0, 1], [2, 3]], [[4, 5]]]}
SQUARE = {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]], [[0.1, 0.1], [0.2, 0.1], [0.2, 0.2], [0.1, 0.1]]]}


def write(path, value):
    path.write_text(json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_geojson_sources(spark, tmp_path):
    road = lambda name, kind, shape: {"type": "Feature", "properties": {"STREET_NAME": name, "CLASS": kind}, "geometry": shape}
    odd = [road("A St", 2, LINE), road("B", "RIV", MULTI), road("C", None, None), road("D", "2", SQUARE), road(None, "2", LINE), {"type": "Feature", "properties": None, "geometry": LINE}]
    for wrapped in ({"type": "FeatureCollection", "features": odd}, {"data": {"type": "FeatureCollection", "features": odd}}):
        found = geojson.read_centerlines(spark, write(tmp_path / "roads.json", wrapped))
        assert [(r["seq"], r["street_name"], r["class"], len(r["points"])) for r in found.orderBy("seq").collect()] == [
            (0, "A St", "2", 2), (1, "B", "RIV", 3), (4, None, "2", 2), (5, None, None, 2),
        ]
        assert [r["base"] for r in roads.road_vertices(found).select("base").distinct().collect()] == ["a"]
    feature = {"type": "Feature", "properties": {}, "geometry": SQUARE}
    for shape in (SQUARE, feature, {"type": "FeatureCollection", "features": [feature, {"type": "Feature", "properties": {}, "geometry": None}]}):
        polygons = geojson.read_boundary(spark, write(tmp_path / "city.json", shape))
        assert polygons.count() == 1
        assert geojson.polygon_edges(polygons, "part").count() == 6 and geojson.polygon_edges(polygons, "part", fill_holes=True).count() == 3
    two = {"type": "MultiPolygon", "coordinates": [SQUARE["coordinates"], SQUARE["coordinates"]]}
    assert geojson.read_boundary(spark, write(tmp_path / "two.json", two)).count() == 2
    assert geojson.read_boundary(spark, write(tmp_path / "none.json", {"type": "FeatureCollection", "features": []})).count() == 0


def test_geojson_sinks(spark, tmp_path):
    cells = grids.regular_grid(spark, dialect="simple").where("chi_id in ('5S3W', '10N1E')")
    rows = geojson.feature_json(cells, ["chi_id", "name", "label", "center"])
    whole = json.loads(geojson.feature_collection(rows, {"cell_miles": 1}).first()["json"])
    assert whole["properties"] == {"cell_miles": 1, "count": 2}
    assert [f["properties"]["chi_id"] for f in whole["features"]] == ["10N1E", "5S3W"]
    assert whole["features"][1]["properties"]["name"] == "Damen–43rd chi" and len(whole["features"][1]["geometry"]["coordinates"][0]) == 5
    none = json.loads(geojson.feature_collection(rows.where("false"), {}).first()["json"])
    assert none == {"type": "FeatureCollection", "properties": {"count": 0}, "features": []}
    geojson.to_lines(rows, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 2


def test_flat_tables_round_trip(spark, tmp_path):
    cells = roads.dual_names(lattice(spark)).withColumn("area_sqmi", F.lit(0.8)).withColumn("edge", F.col("kw") % 2 == 0)
    tables.write_grid_csv(cells, str(tmp_path / "v2"), 2)
    back = tables.read_grid_csv(spark, str(tmp_path / "v2"), 2)
    assert back.count() == 952 and back.where("flag").count() == back.where("not edge").count()
    tables.write_grid_csv(cells, str(tmp_path / "v1"))
    assert tables.read_grid_csv(spark, str(tmp_path / "v1")).where("chi_id = '5S3W'").first()["label"] == "Dam43"


def test_stream_of_points(spark, tmp_path):
    from quadrille.streaming.counts import windowed_counts

    rows = [(f"2024-01-01 00:0{i % 3}:00", 41.8168, -87.6763) for i in range(9)]
    spark.createDataFrame(rows, "t string, lat double, lon double").selectExpr("cast(t as timestamp) as t", "lat", "lon").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t timestamp, lat double, lon double").parquet(str(tmp_path / "in"))
    run = windowed_counts(stream, "t", "1 minute", "5 minutes").writeStream.format("memory").queryName("counts").outputMode("complete").trigger(availableNow=True).start()
    run.awaitTermination()
    assert sorted((r["chi_id"], r["n"]) for r in spark.table("counts").collect()) == [("5S3W", 3)] * 3


def test_command_line(spark, tmp_path, capsys):
    from quadrille.__main__ import main

    main(["regular"], spark)
    out = capsys.readouterr()
    assert json.loads(out.out)["properties"]["count"] == 952 and out.err.strip().endswith("wrote 952 cells")
    ring = [list(p) for p in [*inputs.CITY, inputs.CITY[0]]]
    city = write(tmp_path / "city.json", {"type": "Polygon", "coordinates": [ring]})
    main(["regular", "--boundary", city], spark)
    assert 200 < json.loads(capsys.readouterr().out)["properties"]["count"] < 400
    road = lambda name, a, b: {
        "type": "Feature",
        "properties": {"STREET_NAME": name, "CLASS": "2"},
        "geometry": {"type": "LineString", "coordinates": [[a[0] + (b[0] - a[0]) * k / 9, a[1] + (b[1] - a[1]) * k / 9] for k in range(10)]},
    }
    features = [road(b, (C.ORIGIN_LON - i * C.MILE_LON, 41.6), (C.ORIGIN_LON - i * C.MILE_LON, 42.1)) for i, b in C.ANCHORS_NS.items()]
    features += [road(b, (-87.84, C.ORIGIN_LAT - i * C.MILE_LAT), (-87.5, C.ORIGIN_LAT - i * C.MILE_LAT)) for i, b in C.ANCHORS_EW.items()]
    roads_file = write(tmp_path / "roads.json", {"data": {"type": "FeatureCollection", "features": features}})
    main(["streets", "--boundary", city, "--centerlines", roads_file], spark)
    found = json.loads(capsys.readouterr().out)
    inner = [f["properties"] for f in found["features"] if not f["properties"]["edge"]]
    assert len(inner) > 30 and all(abs(p["area_sqmi"] - 1) < 0.01 and not p["flag"] for p in inner)
    assert {p["chi_id"]: p["label_canon"] for p in inner}["5S3W"] == "Dam43"


def test_collection_in_parts_is_the_same_document(spark, tmp_path):
    import json

    features = spark.createDataFrame([(f"{i:03d}", f'{{"id": "{i:03d}"}}') for i in [*range(200), 0, 0, 7]], "chi_id string, json string").repartition(5)
    for name, given in (("some", features), ("none", features.limit(0))):
        geojson.write_collection(given, {"cell_miles": 1}, str(tmp_path / name / "parts"))
        geojson.joined_collection(spark, str(tmp_path / name / "parts"), str(tmp_path / name / "grid.json"))
        found = json.loads((tmp_path / name / "grid.json").read_text())
        assert found == json.loads(geojson.feature_collection(given, {"cell_miles": 1}).first()["json"])


def test_closed_street_grid_has_no_seams(spark, sf_dir):
    # Two parts with a gap of 0.001 degrees: one outline, and the gap's area is in the cells.
    west = [[-87.86, 41.70], [-87.7234, 41.70], [-87.7234, 42.00], [-87.86, 42.00], [-87.86, 41.70]]
    east = [[-87.7224, 41.70], [-87.56, 41.70], [-87.56, 42.00], [-87.7224, 42.00], [-87.7224, 41.70]]
    given = spark.createDataFrame([(0, [west]), (1, [east])], "part bigint, polygon array<array<array<double>>>")
    areas = [grids.street_grid(given, inputs.centerlines(spark, sf_dir), close=c).agg(F.sum("area")).first()[0] for c in (0.0, 0.0006)]
    assert areas[0] == pytest.approx(0.299 * 0.3, rel=1e-6)
    assert areas[1] == pytest.approx(0.3 * 0.3, rel=1e-4)


def test_medians_of_any_spread(spark):
    """Upper medians by steps of any width: ties, nulls, NaN, even numbers, one road with most vertices."""
    rng = random.Random(7)
    nan = float("nan")
    roads_of = {
        "one": [(5.0, -3.0)],
        "even": [(1.0, 4.0), (2.0, 3.0), (3.0, 2.0), (4.0, 1.0)],
        "same": [(1.5, 2.5)] * 9,
        "null": [(None, 1.0), (None, 2.0), (3.0, None)],
        "nan": [(nan, 1.0), (nan, nan), (1.0, 3.0)],
        "none": [(None, None)],
        "hot": [(round(rng.gauss(-87.6, 0.05), 4), round(rng.choice([41.8, 41.9, rng.gauss(41.8, 0.1)]), 4)) for _ in range(3000)],
    }
    rows = [(b, i, x, y) for b, points in roads_of.items() for i, (x, y) in enumerate(points)]
    vertices = spark.createDataFrame(rows, "base string, seq long, lon double, lat double").repartition(5)

    def middle(values):
        ordered = sorted(values, key=lambda v: (v is not None, v is not None and math.isnan(v), 0 if v is None or math.isnan(v) else v))
        return ordered[len(ordered) // 2]

    for step in (1e-5, 0.001, 0.37, 1000.0):
        found = {r["base"]: r for r in roads.road_summary(vertices, step).collect()}
        assert set(found) == set(roads_of)
        for base, points in roads_of.items():
            assert repr(found[base]["med_lon"]) == repr(middle([p[0] for p in points])), (step, base)
            assert repr(found[base]["med_lat"]) == repr(middle([p[1] for p in points])), (step, base)
            assert found[base]["n"] == len(points) and found[base]["seq"] == 0
    spans = {r["base"]: r for r in roads.road_spans(vertices).collect()}
    for base, r in found.items():
        assert all(repr(r[c]) == repr(spans[base][c]) for c in spans[base].asDict())
    assert roads.road_summary(vertices.limit(0)).collect() == []


def test_search_by_index(spark):
    """Searches of many queries find what one scan a query finds."""
    rng = random.Random(3)
    words = ["Damen", "Ashland", "43rd", "Oak", "Ave", "St", "É", "N", "ax"]
    rows = [(f"{i}N{i % 3}W", f"χ:{i}N{i % 3}W", " & ".join(rng.choices(words, k=rng.randint(1, 3))), f"Lab {rng.choice(words)} χ") for i in range(60)]
    rows += [("none", None, None, None), ("a-blank", "χ:", "", "")]
    cells = spark.createDataFrame(rows, "chi_id string, chi_ordinate string, name string, label string")
    asked = ["damen", " Damen\t", "43", "é", "&", "n & a", "7n1w", "χ:7n", "no such", "", "  ", "ave & ave", "lab", "aveave", "x"]
    queries = spark.createDataFrame([(q,) for q in [*asked, "damen", None]], "query string")
    want = {q: [r.asDict() for r in explore.search(cells, q).collect()] for q in asked}
    for index in (None, explore.search_index(cells, 3)):
        found = explore.search_all(cells, queries, index, explore.SALTS if index is None else 3)
        assert found.columns == ["query", *cells.columns]
        got = [r.asDict() for r in found.collect()]
        assert len(got) == len({r["query"] for r in got})
        held = {r.pop("query"): r for r in got}
        assert {q: r for q, (r,) in ((q, w) for q, w in want.items() if w)} == held
    assert explore.search_all(cells.limit(0), queries).collect() == []
    assert explore.search_all(cells, queries.limit(0)).collect() == []


def test_collection_is_read_by_line(spark, tmp_path):
    line = lambda i: json.dumps({"type": "LineString", "coordinates": [[i, 1.5], [i, 2.5]]})
    text = lambda i, shape: f'{{"type":"Feature","properties":{{"STREET_NAME":"S, [{i}]","CLASS":"2"}},"geometry":{shape}}}'
    given = [(f"{i:04d}", text(i, "null" if i == 7 else line(i))) for i in range(300)]
    geojson.write_collection(spark.createDataFrame(given, "chi_id string, json string").repartition(5), {"made": "[here"}, str(tmp_path / "parts"))
    geojson.joined_collection(spark, str(tmp_path / "parts"), str(tmp_path / "roads.json"))
    whole = [tuple(r) for r in geojson.read_centerlines(spark, str(tmp_path / "roads.json")).orderBy("seq").select("street_name", "class", "points").collect()]
    assert len(whole) == 299
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        for path in ("parts", "roads.json"):
            found = geojson.read_centerlines(spark, str(tmp_path / path), by_line=True)
            assert spark.read.text(str(tmp_path / path)).rdd.getNumPartitions() > 5
            assert [tuple(r) for r in found.orderBy("seq").select("street_name", "class", "points").collect()] == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for bad in (json.dumps({"type": "FeatureCollection", "features": []}), '{"type":"FeatureCollection","features":[\n{"type":"Feature",\n"geometry":null}\n]}'):
        (tmp_path / "bad.json").write_text(bad)
        with pytest.raises(Exception, match="not one feature a line"):
            geojson.read_centerlines(spark, str(tmp_path / "bad.json"), by_line=True).collect()
    geojson.write_collection(spark.createDataFrame([], "chi_id string, json string"), {}, str(tmp_path / "none"))
    assert geojson.read_centerlines(spark, str(tmp_path / "none"), by_line=True).count() == 0


def test_roads_are_written_in_bounded_lines(spark, sf_dir):
    from quadrille import queries
    from quadrille.sources.shared import shared_dir

    files = lambda: {p for p in Path(shared_dir(spark).removeprefix("file:")).glob("quadrille-roads-*/part-*")}
    before = files()
    found = queries.centerlines_read(spark, sf_dir).collect()
    texts = [p.read_text().splitlines() for p in files() - before]
    assert sum(r["vertices"] for r in found) == inputs.table(spark, sf_dir, "lineitem").count()
    # No value holds a road, let alone all: the longest feature has the vertices of one line.
    assert max(len(t) for lines in texts for t in lines) < 60 * queries.VERTICES < sum(len(t) for lines in texts for t in lines) / 10


def test_one_road_with_all_vertices_at_one_place_is_many_lines(spark, tmp_path):
    from quadrille import queries
    from quadrille.sources.shared import shared_dir

    rows = spark.range(1_500).select(F.lit(8).cast("long").alias("l_orderkey"), F.lit(40).cast("long").alias("l_partkey"), F.lit(3).alias("l_linenumber"))
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    files = lambda: {p for p in Path(shared_dir(spark).removeprefix("file:")).glob("quadrille-roads-*/part-*")}
    before = files()
    found = queries.centerlines_read(spark, str(tmp_path)).collect()
    assert [(r["street_name"], r["vertices"]) for r in found] == [("Racine Ave", 1_500)]
    assert sum(t.count('"Feature"') for p in files() - before for t in p.read_text().splitlines()) == 8
