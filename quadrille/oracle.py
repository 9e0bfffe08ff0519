"""DuckDB SQL for the rows of the grid's queries, by other means where there are any."""

from __future__ import annotations

import textwrap

from quadrille import constants as C
from quadrille.inputs import CATEGORY, CITY, CORNER_X, CORNER_Y, CUT, FACE, FIT, FITTED, HEXAGON, LOOKUP, PART_ROAD, PLACE_LAT, PLACE_NAME, POINT, REGIONS, ROAD_LAT, ROAD_LON, ROAD_SEQ, ROADS
from quadrille.queries import CONVEX, PRETTY


def _d(x: float | None) -> str:
    """A double literal, never a decimal."""
    if x is None:
        return "NULL::DOUBLE"
    return f"{x!r}" if "e" in repr(x) else f"{x!r}e0"


def _q(x: str | None) -> str:
    return "NULL" if x is None else "'" + x.replace("'", "''") + "'"


LAT0, LON0, ML, MO = _d(C.ORIGIN_LAT), _d(C.ORIGIN_LON), _d(C.MILE_LAT), _d(C.MILE_LON)


def _values(rows: list[tuple]) -> str:
    cell = lambda v: _q(v) if v is None or isinstance(v, str) else _d(v) if isinstance(v, float) else str(v)
    return "VALUES " + ", ".join("(" + ", ".join(cell(v) for v in r) + ")" for r in rows)


def _south(lat: str) -> str:
    return f"(({LAT0} - ({lat})) / {ML})"


def _west(lon: str) -> str:
    return f"(({LON0} - ({lon})) / {MO})"


def _band(miles: str) -> str:
    return f"CAST(floor(abs({miles}) + 1e-9) AS BIGINT)"


def _ordinate(lat: str, lon: str) -> str:
    s, w = _south(lat), _west(lon)
    return (
        f"'χ:' || ({_band(s)} + 1) || CASE WHEN {s} >= 0 THEN 'S' ELSE 'N' END || "
        f"({_band(w)} + 1) || CASE WHEN {w} >= 0 THEN 'W' ELSE 'E' END"
    )


POINTS = f"points AS (SELECT event_id, {POINT['lat']} AS lat, {POINT['lon']} AS lon FROM events)"
#: The default lattice, by whole steps; ids by integers alone.
CELLS = f"""cells AS (
  SELECT ks, kw, {LAT0} - (0.5e0 + ks) * {ML} AS lat, {LON0} - (0.5e0 + kw) * {MO} AS lon,
         CASE WHEN ks >= 0 THEN (ks + 1) || 'S' ELSE (-ks) || 'N' END || CASE WHEN kw >= 0 THEN (kw + 1) || 'W' ELSE (-kw) || 'E' END AS chi_id,
         CASE WHEN ks >= 0 THEN ks ELSE -ks - 1 END AS ns, CASE WHEN kw >= 0 THEN kw ELSE -kw - 1 END AS ew
  FROM range(-14, 20) AS a(ks), range(-9, 19) AS b(kw)
)"""

#: Those of its cells that have a point.
SEEN = f"""{POINTS}, spots AS (SELECT DISTINCT CAST(floor({_south("lat")}) AS BIGINT) AS ks, CAST(floor({_west("lon")}) AS BIGINT) AS kw FROM points),
{CELLS.replace("cells AS (", "every_cell AS (", 1)},
cells AS (SELECT * FROM every_cell SEMI JOIN spots USING (ks, kw))"""


def _bands(dialect: str) -> str:
    rows = []
    for side, table in (("W", C.AVENUES_WEST), ("E", C.AVENUES_EAST), ("S", C.STREETS_SOUTH), ("N", C.STREETS_NORTH)):
        rows += [(side, i, r) for i, r in enumerate(table) if not (dialect == "simple" and i == 0 and side in "WS")]
    return f"bands_{dialect}(side, band, road) AS ({_values(rows)})"


def _token(road: str, dialect: str) -> str:
    head = f"split_part({road}, ' ', 1)"
    token = f"CASE WHEN regexp_matches({head}, '^[0-9]') THEN regexp_replace({head}, '[^0-9]', '', 'g') ELSE left({head}, 3) END"
    if dialect == "simple":
        return token
    return (
        f"CASE WHEN {road} = 'Division' THEN 'Divi' WHEN {road} = 'Diversey' THEN 'Dive' "
        f"WHEN regexp_full_match({road}, 'Avenue [^ ]+') THEN split_part({road}, ' ', 2) ELSE {token} END"
    )


def _naming(av: str, st: str, chi_id: str, dialect: str) -> str:
    ok = f"coalesce({av}, '') <> '' AND coalesce({st}, '') <> ''"
    return (
        f"CASE WHEN {ok} THEN {av} || '–' || {st} || ' chi' ELSE 'χ:' || {chi_id} || ' chi' END AS name, "
        f"CASE WHEN {ok} THEN ({_token(av, dialect)}) || ({_token(st, dialect)}) ELSE 'χ:' || {chi_id} END AS label"
    )


def _by_band(cells: str, dialect: str, out: str) -> str:
    """Cells with av, st by a join on the band tables."""
    return f"""{out} AS (
  SELECT c.*, a.road AS av, s.road AS st FROM {cells} AS c
  LEFT JOIN bands_{dialect} AS a ON a.side = CASE WHEN kw >= 0 THEN 'W' ELSE 'E' END AND a.band = ew
  LEFT JOIN bands_{dialect} AS s ON s.side = CASE WHEN ks >= 0 THEN 'S' ELSE 'N' END AND s.band = ns
)"""


def _named(dialect: str, cells: str = CELLS) -> str:
    return f"""{cells + ", " if cells else ""}{_bands(dialect)}, {_by_band("cells", dialect, f"banded_{dialect}")},
named_{dialect} AS (SELECT ks, kw, lat, lon, chi_id, {_naming("av", "st", "chi_id", dialect)} FROM banded_{dialect})"""


def _point_names(dialect: str) -> str:
    return f"""WITH {POINTS}, {_bands(dialect)},
p AS (SELECT event_id, {_south("lat")} AS s, {_west("lon")} AS w FROM points),
k AS (SELECT event_id, CASE WHEN s >= 0 THEN 1 ELSE -1 END AS ks, CASE WHEN w >= 0 THEN 1 ELSE -1 END AS kw, {_band("s")} AS ns, {_band("w")} AS ew FROM p),
i AS (SELECT *, (ns + 1) || CASE WHEN ks > 0 THEN 'S' ELSE 'N' END || (ew + 1) || CASE WHEN kw > 0 THEN 'W' ELSE 'E' END AS chi_id FROM k),
{_by_band("i", dialect, "banded")}
SELECT event_id, {_naming("av", "st", "chi_id", dialect)} FROM banded"""


def _edges(ring: list[tuple[float, float]]) -> list[tuple]:
    return [(*a, *b) for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)]


_BOX = f"lon - {MO} / 2 AS w, lat - {ML} / 2 AS s, lon + {MO} / 2 AS e, lat + {ML} / 2 AS n"
_LEFT_OF = "((e.y1 > {y}) <> (e.y2 > {y}) AND {x} < e.x1 + ({y} - e.y1) * (e.x2 - e.x1) / nullif(e.y2 - e.y1, 0))"

_CROSS = "((({bx}) - ({ax})) * (({cy}) - ({ay})) - (({by}) - ({ay})) * (({cx}) - ({ax})))"


def _orient(a: tuple[str, str], b: tuple[str, str], c: tuple[str, str]) -> str:
    return f"sign({_CROSS.format(ax=a[0], ay=a[1], bx=b[0], by=b[1], cx=c[0], cy=c[1])})"


def _segments_cross(p: tuple[str, str], q: tuple[str, str]) -> str:
    a, b = ("e.x1", "e.y1"), ("e.x2", "e.y2")
    return f"({_orient(a, b, p)} * {_orient(a, b, q)} <= 0 AND {_orient(p, q, a)} * {_orient(p, q, b)} <= 0)"


_SIDES = [(("c.w", "c.s"), ("c.e", "c.s")), (("c.e", "c.s"), ("c.e", "c.n")), (("c.e", "c.n"), ("c.w", "c.n")), (("c.w", "c.n"), ("c.w", "c.s"))]
CITY_EDGES = f"edges(x1, y1, x2, y2) AS ({_values(_edges(CITY))})"
_HEX = _values([(i, *p, *HEXAGON[(i + 1) % len(HEXAGON)]) for i, p in enumerate(HEXAGON)])
NATIONS = f"""hexagon(i, px, py, qx, qy) AS ({_HEX}),
edges AS (
  SELECT n_nationkey, {CORNER_X} + px AS x1, {CORNER_Y} + py AS y1, {CORNER_X} + qx AS x2, {CORNER_Y} + qy AS y2 FROM nation, hexagon
)"""
LATTICE_POLYGON = f"""WITH {CELLS}, {NATIONS},
boxes AS (SELECT chi_id, lat, lon, {_BOX} FROM cells)
SELECT chi_id FROM boxes AS c WHERE
  EXISTS (SELECT 1 FROM edges AS e WHERE (x1 BETWEEN c.w AND c.e AND y1 BETWEEN c.s AND c.n) OR {" OR ".join(_segments_cross(p, q) for p, q in _SIDES)})
  OR (SELECT count(*) FROM edges AS e WHERE {_LEFT_OF.format(x="c.lon", y="c.lat")}) % 2 = 1"""

PLACES = f"""placed AS (
  SELECT CAST(event_id AS VARCHAR) AS poi_id, {CATEGORY} AS category, {PLACE_NAME} AS name, {_ordinate(PLACE_LAT, POINT["lon"])} AS ord
  FROM events WHERE ({PLACE_LAT}) IS NOT NULL
),
ranked AS (
  SELECT replace(ord, 'χ:', '') AS chi_id, poi_id, category,
         row_number() OVER (PARTITION BY ord ORDER BY coalesce(category, ''), coalesce(name, ''), poi_id) AS rank
  FROM placed
)"""

TYPES = "|".join(C.ROAD_TYPES)
_BASE = f"trim(regexp_replace(lower(trim(%s)), '\\s+({TYPES})$', ''))"


def _vertices(skip: bool) -> str:
    ok = f"WHERE trim(coalesce(class, '')) NOT IN ({', '.join(map(_q, C.SKIPPED_CLASSES))})" if skip else ""
    return f"""roads(r, street_name, class) AS ({_values(ROADS)}),
v AS (
  SELECT {_BASE % "street_name"} AS base, {ROAD_SEQ} AS seq, {ROAD_LON} AS lon, {ROAD_LAT} AS lat
  FROM lineitem JOIN roads ON r = l_partkey % 40 {ok}
)"""


SPANS = """spans AS (
  SELECT base, min(seq) AS seq, count(*) AS n, min(lat) AS lat_lo, max(lat) AS lat_hi, min(lon) AS lon_lo, max(lon) AS lon_hi FROM v GROUP BY base
)"""
MEDIANS = """medians AS (
  SELECT base, list_sort(list(lon))[count(*) // 2 + 1] AS med_lon, list_sort(list(lat))[count(*) // 2 + 1] AS med_lat FROM v GROUP BY base
)"""


def _pretty_rows() -> list[tuple[str, str]]:
    import re

    out = {}
    for _, name, _ in ROADS:
        base = re.sub(rf"\s+({TYPES})$", "", name.strip().lower()).strip()
        pretty = " ".join(w if w[0].isdigit() else w[0].upper() + w[1:] for w in base.split(" "))
        out[base] = {"O'hare": "O'Hare", "Mcclurg Ct": "McClurg Ct"}.get(pretty, pretty)
    return sorted(out.items())


_AV = ", ".join(_q(n.lower()) for n in (*C.AVENUES_WEST, *C.AVENUES_EAST, *C.DIAGONALS))
_ST = ", ".join(_q(n.lower()) for n in (*C.STREETS_SOUTH, *C.STREETS_NORTH))
_MILE_NS, _MILE_EW = (", ".join(_q(n.lower()) for n in t) for t in (C.MILE_ROADS_NS, C.MILE_ROADS_EW))
RECORDS = f"""{_vertices(True)}, {SPANS}, {MEDIANS}, pretty(base, name) AS ({_values(_pretty_rows())}),
full_spans AS (
  SELECT *, (lat_hi - lat_lo) / {ML} AS lat_span, (lon_hi - lon_lo) / {MO} AS lon_span
  FROM spans JOIN medians USING (base) JOIN pretty USING (base)
),
records AS (
  SELECT 'avenue' AS axis, CASE WHEN base IN ({_AV}) THEN 0 ELSE 1 END AS tier, seq, name, med_lon AS med, lat_lo AS lo, lat_hi AS hi FROM full_spans
  WHERE base IN ({_AV}) OR (base NOT IN ({_MILE_NS}) AND lat_span >= lon_span AND lat_span >= 1)
  UNION ALL
  SELECT 'street', CASE WHEN base IN ({_ST}) THEN 0 ELSE 1 END, seq, name, med_lat, lon_lo, lon_hi FROM full_spans
  WHERE base IN ({_ST}) OR (base NOT IN ({_MILE_EW}) AND lon_span > lat_span AND lon_span >= 1)
)"""


def _pass(axis: str, number: int, tiers: str, miles: float) -> str:
    """One sequential pass of the namer over all cells."""
    x, a, ux, ua = ("lon", "lat", MO, ML) if axis == "avenue" else ("lat", "lon", ML, MO)
    return f"""{axis}_{number} AS (
  SELECT chi_id, name FROM (
    SELECT chi_id, name, row_number() OVER (PARTITION BY chi_id ORDER BY abs(med - {x}), tier, seq) AS k
    FROM cells JOIN records ON axis = '{axis}' AND tier IN ({tiers})
      AND lo - {_d(C.SPAN_MILES)} * {ua} <= {a} AND {a} <= hi + {_d(C.SPAN_MILES)} * {ua} AND abs(med - {x}) < {_d(miles)} * {ux}
  ) WHERE k = 1
)"""


NAMER = (
    f"{CELLS}, {RECORDS}, "
    + ", ".join(_pass(axis, k, *p) for axis in ("avenue", "street") for k, p in enumerate((("0", C.NAME_MILES), ("1", C.NAME_MILES), ("0, 1", C.WIDE_MILES))))
    + ", near AS (SELECT c.chi_id, "
    + ", ".join(f"coalesce({a}_0.name, {a}_1.name, {a}_2.name) AS {a}" for a in ("avenue", "street"))
    + " FROM cells AS c "
    + " ".join(f"LEFT JOIN {a}_{k} ON {a}_{k}.chi_id = c.chi_id" for a in ("avenue", "street") for k in range(3))
    + ")"
)


def _fit_sql(anchor: list[tuple], clip: bool) -> str:
    """Least squares by explicit sums about the origin."""
    inside = (
        f"(north IS NULL OR {_south('lat')} >= north) AND (south IS NULL OR {_south('lat')} <= south) AND (cap IS NULL OR {_west('lon')} <= cap)" if clip else "true"
    )
    x, y = f"CASE WHEN axis = 'ns' THEN lat - {LAT0} ELSE lon - {LON0} END", f"CASE WHEN axis = 'ns' THEN lon - {LON0} ELSE lat - {LAT0} END"
    return f"""WITH {_vertices(False)}, anchors(axis, idx, base, north, south, cap) AS ({_values(anchor)}),
m AS (SELECT axis, idx, {inside} AS inside, {x} AS x, {y} AS y FROM v JOIN anchors USING (base)),
k AS (SELECT *, count(*) OVER p AS n, count(*) FILTER (inside) OVER p AS n_in FROM m WINDOW p AS (PARTITION BY axis, idx)),
s AS (
  SELECT axis, idx, CAST(count(*) AS DOUBLE) AS n, avg(x) AS ax, avg(y) AS ay, sum(x * y) AS xy, sum(x * x) AS xx
  FROM k WHERE n >= 6 AND (inside OR n_in < 6) GROUP BY axis, idx
),
f AS (SELECT axis, idx, (xy - n * ax * ay) / (xx - n * ax * ax) AS m, ax, ay FROM s)
SELECT axis, CAST(idx AS INTEGER) AS idx, round(m, 5) AS slope,
       round(ay - m * ax + CASE WHEN axis = 'ns' THEN {LON0} - m * {LAT0} ELSE {LAT0} - m * {LON0} END, 3) AS intercept
FROM f"""


_ANCHORS = [(a, i, b, None, None, None) for a, t in (("ns", C.ANCHORS_NS), ("ew", C.ANCHORS_EW)) for i, b in t.items()]
_CLIPPED = [
    ("ns", 0, "state", None, 6.0, None), ("ns", 1, "halsted", 200.0, None, None), ("ns", 2, "ashland", 2.0, 9.0, None),
    ("ew", 0, "madison", None, None, 8.0), ("ew", 7, "63rd", None, None, -50.0),
]

_WINDOWED = [("ns", i, b, *C.FIT_WINDOWS.get(b, (None, None)), None) for i, b in C.ANCHORS_NS.items()]
_WINDOWED += [("ew", i, b, None, None, C.WEST_CAPS.get(b, C.WEST_CAP)) for i, b in C.ANCHORS_EW.items()]

COMPLETE = f"""fits AS (SELECT {", ".join(f"{e} AS {c}" for c, e in FIT.items())} FROM nation WHERE {FITTED}),
every AS (SELECT axis, unnest(range(min(idx), max(idx) + 1)) AS idx FROM fits GROUP BY axis),
around AS (
  SELECT axis, idx, (SELECT max(f.idx) FROM fits AS f WHERE f.axis = e.axis AND f.idx <= e.idx) AS b,
         (SELECT min(f.idx) FROM fits AS f WHERE f.axis = e.axis AND f.idx >= e.idx) AS a
  FROM every AS e
),
complete AS (
  SELECT e.axis, e.idx, e.a = e.b AS fitted,
         lo.slope + CASE WHEN a = b THEN 0 ELSE CAST(e.idx - b AS DOUBLE) / (a - b) END * (hi.slope - lo.slope) AS slope,
         lo.intercept + CASE WHEN a = b THEN 0 ELSE CAST(e.idx - b AS DOUBLE) / (a - b) END * (hi.intercept - lo.intercept) AS intercept
  FROM around AS e JOIN fits AS lo ON lo.axis = e.axis AND lo.idx = b JOIN fits AS hi ON hi.axis = e.axis AND hi.idx = a
)"""

FRAME = f"""{SEEN},
b AS (SELECT min(lon) - {MO} / 2 AS min_x, max(lon) + {MO} / 2 AS max_x, min(lat) - {ML} / 2 AS min_y, max(lat) + {ML} / 2 AS max_y FROM cells),
frame AS (
  SELECT *, {MO} AS cell_lon, 744e0 / (max_x - min_x) AS sx, (max_y - min_y) * 744e0 / (max_x - min_x) + 16e0 AS height FROM b
)"""

_SEARCHES = ("5S3W", " damen ", "43rd", "χ:2s", "Dam43", "no such cell", " ")
_PIXEL = "printf('%.1f,%.1f', 8e0 + ({x} - min_x) * sx, height - 8e0 - ({y} - min_y) * sx)"
_CORNERS = [("w", "s"), ("e", "s"), ("e", "n"), ("w", "n"), ("w", "s")]



def _clipped(source: str, out: str, side: str) -> str:
    """Rings of ``source`` clipped, edge after edge, to where ``side`` of a point isn't negative."""
    a, b = "r[i]", "r[i % len(r) + 1]"
    at = lambda p: side.format(x=f"{p}.x", y=f"{p}.y")
    t = f"(({at(a)}) / (({at(a)}) - ({at(b)})))"
    cross = f"{{'x': {a}.x + {t} * ({b}.x - {a}.x), 'y': {a}.y + {t} * ({b}.y - {a}.y)}}"
    kept = f"CASE WHEN {at(a)} >= 0 AND {at(b)} >= 0 THEN [{b}] WHEN {at(a)} >= 0 THEN [{cross}] WHEN {at(b)} >= 0 THEN [{cross}, {b}] ELSE [] END"
    return f"{out} AS (SELECT * REPLACE (flatten(list_transform(range(1, len(r) + 1), lambda i : {kept})) AS r) FROM {source})"


_NS_COUNT, _EW_COUNT = CUT["ns"][0], CUT["ew"][0]
_RING_AREA = "abs(list_sum(list_transform(range(1, len({r}) + 1), lambda i : ({r}[i].x - {r}[1].x) * ({r}[i % len({r}) + 1].y - {r}[1].y) - ({r}[i % len({r}) + 1].x - {r}[1].x) * ({r}[i].y - {r}[1].y)))) / 2"
#: The convex outline clipped to each strip and row by half-planes.  A face is inner if
#: clipping a far larger square gives the same area.
OVERLAY_CONVEX = f"""WITH {", ".join(f"{a} AS (SELECT n_nationkey AS k, {_d(m)} AS m, {c} AS c FROM nation WHERE n_nationkey < {n})" for a, (n, m, c) in CUT.items())},
rings AS (
  SELECT true AS city, [{", ".join(f"{{'x': {_d(x)}, 'y': {_d(y)}}}" for x, y in CONVEX)}] AS r
  UNION ALL SELECT false, [{", ".join(f"{{'x': {_d(x)}, 'y': {_d(y)}}}" for x, y in ((-90.0, 39.0), (-85.0, 39.0), (-85.0, 44.0), (-90.0, 44.0)))}]
),
strips AS (
  SELECT city, r, i AS strip, j, coalesce(a.m, 0e0) AS am, coalesce(a.c, -1e3) AS ac, coalesce(b.m, 0e0) AS bm, coalesce(b.c, 1e3) AS bc,
         coalesce(s.m, 0e0) AS sm, coalesce(s.c, -1e3) AS sc, coalesce(n.m, 0e0) AS nm, coalesce(n.c, 1e3) AS nc
  FROM rings, range({_NS_COUNT + 1}) AS x(i), range({_EW_COUNT + 1}) AS y(j)
  LEFT JOIN ns AS a ON a.k = i - 1 LEFT JOIN ns AS b ON b.k = i LEFT JOIN ew AS s ON s.k = j - 1 LEFT JOIN ew AS n ON n.k = j
),
{_clipped("strips", "c1", "{x} - (am * {y} + ac)")}, {_clipped("c1", "c2", "(bm * {y} + bc) - {x}")},
{_clipped("c2", "c3", "{y} - (sm * {x} + sc)")}, {_clipped("c3", "c4", "(nm * {x} + nc) - {y}")},
areas AS (SELECT city, strip, j, {_RING_AREA.format(r="r")} AS area FROM c4 WHERE len(r) > 2),
faces AS (
  SELECT f.strip, f.area, round(f.area / ({ML} * {MO}), 3) AS area_sqmi, NOT (abs(f.area - w.area) < 1e-13 AND f.strip BETWEEN 1 AND {_NS_COUNT - 1} AND f.j BETWEEN 1 AND {_EW_COUNT - 1}) AS edge
  FROM areas AS f JOIN areas AS w ON w.strip = f.strip AND w.j = f.j AND NOT w.city WHERE f.city AND f.area > 1e-16
)
SELECT CAST(strip AS INTEGER) AS strip, round(area, 10) AS area, area_sqmi, edge, NOT edge AND (area_sqmi < 0.9e0 OR area_sqmi > 1.1e0) AS flag FROM faces"""

ORACLE_SQL: dict[str, str] = {
    "miles_bands": f"""WITH {POINTS} SELECT event_id, round({_south("lat")}, 6) AS south, round({_west("lon")}, 6) AS west,
{_band(_south("lat"))} AS ns_band, {_band(_west("lon"))} AS ew_band FROM points""",
    "ordinate_counts": f"""WITH {POINTS} SELECT {_ordinate("lat", "lon")} AS chi_ordinate, replace({_ordinate("lat", "lon")}, 'χ:', '') AS chi_id, count(*) AS n
FROM points GROUP BY ALL""",
    "names_full": _point_names("full"),
    "names_simple": _point_names("simple"),
    "label_tokens": f"""WITH t AS (SELECT p_partkey, {PART_ROAD} AS road FROM part) SELECT p_partkey, road, {_token("road", "full")} AS full_token, {_token("road", "simple")} AS simple_token FROM t""",
    "lattice_default": f"WITH {SEEN} SELECT ks, kw, 'χ:' || chi_id AS chi_ordinate, chi_id, round(lat, 6) AS center_lat, round(lon, 6) AS center_lon FROM cells",
    "lattice_phased": f"""WITH {POINTS}, steps AS (
  SELECT ks, kw, {LAT0} - (0e0 + ks) * {ML} AS lat, {LON0} - (0.25e0 + kw) * {MO} AS lon
  FROM (SELECT unnest(range(CAST(floor({_south("max(lat)")}) AS BIGINT) - 1, CAST(ceil({_south("min(lat)")}) AS BIGINT) + 2)) AS ks FROM points),
       (SELECT unnest(range(CAST(floor({_west("max(lon)")} - 0.25) AS BIGINT) - 1, CAST(ceil({_west("min(lon)")} - 0.25) AS BIGINT) + 2)) AS kw FROM points)
),
keyed AS (SELECT *, replace({_ordinate("lat", "lon")}, 'χ:', '') AS chi_id FROM steps)
SELECT ks, kw, chi_id, round(lat, 6) AS center_lat, round(lon, 6) AS center_lon
FROM (SELECT *, row_number() OVER (PARTITION BY chi_id ORDER BY ks, kw) AS k FROM keyed) WHERE k = 1""",
    "lattice_boxed": f"""WITH {POINTS}, {CELLS}, boxes AS (SELECT chi_id, {_BOX} FROM cells),
b AS (SELECT min(lat) + 1e-1 AS south, max(lat) - 1e-1 AS north, min(lon) + 1e-1 AS west, max(lon) - 1e-1 AS east FROM points)
SELECT chi_id FROM boxes, b WHERE w <= east AND e >= west AND s <= north AND n >= south""",
    "lattice_polygon": LATTICE_POLYGON,
    "lattice_empty_boundary": "SELECT count(*) AS cells FROM nation WHERE n_nationkey < 0",
    "cell_rings": f"""WITH {SEEN}, boxes AS (SELECT chi_id, {_BOX} FROM cells)
{" UNION ALL ".join(f"SELECT chi_id, CAST({i} AS BIGINT) AS seq, round({x}, 9) AS lon, round({y}, 9) AS lat FROM boxes" for i, (x, y) in enumerate(_CORNERS))}""",
    "point_to_cell_join": f"WITH {POINTS} SELECT event_id, replace({_ordinate('lat', 'lon')}, 'χ:', '') AS chi_id FROM points",
    "chi_lookup": f"""WITH {CELLS}, boxes AS (SELECT chi_id, {_BOX} FROM cells), asked AS (SELECT c_custkey, {LOOKUP["lat"]} AS y, {LOOKUP["lon"]} AS x FROM customer),
first AS (SELECT c_custkey, min(chi_id) AS chi_id FROM asked JOIN boxes ON x BETWEEN w AND e AND y BETWEEN s AND n GROUP BY c_custkey)
SELECT asked.c_custkey, 'χ:' || chi_id AS chi_ordinate FROM asked LEFT JOIN first ON first.c_custkey = asked.c_custkey""",
    "region_pip": f"""WITH {POINTS}, {NATIONS},
met AS (
  SELECT event_id, n_nationkey, count(*) FILTER ({_LEFT_OF.format(x="p.lon", y="p.lat")}) AS crossings
  FROM points AS p, edges AS e GROUP BY event_id, n_nationkey
)
SELECT event_id, min(n_nationkey) AS n_nationkey FROM met WHERE crossings % 2 = 1 GROUP BY event_id""",
    "shoelace_area": f"WITH {NATIONS} SELECT n_nationkey, round(abs(sum(x1 * y2 - x2 * y1)) / 2 / ({ML} * {MO}), 3) AS area_sqmi FROM edges GROUP BY n_nationkey",
    "places_counts": f"WITH {PLACES} SELECT chi_id, category, count(*) AS n FROM ranked WHERE coalesce(category, '') <> '' GROUP BY ALL",
    "places_counts_map": f"WITH {PLACES} SELECT chi_id, category, count(*) AS n FROM ranked WHERE coalesce(category, '') <> '' GROUP BY ALL",
    "places_ids": f"""WITH {PLACES}, {_named("simple")},
listed AS (
  SELECT chi_id, string_agg(poi_id, ',' ORDER BY rank) AS ids, string_agg(poi_id, ',' ORDER BY rank) FILTER (rank <= 8) AS featured FROM ranked GROUP BY chi_id
)
SELECT c.chi_id, name, coalesce(ids, '') AS ids, coalesce(featured, '') AS featured FROM named_simple AS c LEFT JOIN listed ON listed.chi_id = c.chi_id""",
    "places_top8": f"WITH {PLACES} SELECT chi_id, rank, poi_id FROM ranked WHERE rank <= 8",
    "places_zero_cells": f"WITH {CELLS}, {PLACES} SELECT chi_id FROM cells WHERE chi_id NOT IN (SELECT chi_id FROM ranked)",
    "profiles": f"WITH {_named('simple', SEEN)} SELECT chi_id, name, 'χ:' || chi_id AS chi_ordinate, label FROM named_simple",
    "region_labels": f"""WITH {_named("simple", SEEN)}, regions(o, region, s, n, w, e, n_origin, w_origin) AS ({_values([(o, name, *box, a, b) for o, name, box, a, b in REGIONS])}),
k AS (
  SELECT c.ks, c.kw, r.region || '-' || CAST(n_origin - CASE WHEN c.ks >= 0 THEN c.ks + 1 ELSE -c.ks END + 1 AS BIGINT)
         || chr(CAST(65 + w_origin - CASE WHEN c.kw >= 0 THEN c.kw + 1 ELSE -c.kw END AS INTEGER)) AS own,
         row_number() OVER (PARTITION BY c.ks, c.kw ORDER BY o) AS k
  FROM named_simple AS c JOIN regions AS r
    ON c.lon - {MO} / 2 <= r.e AND c.lon + {MO} / 2 >= r.w AND c.lat - {ML} / 2 <= r.n AND c.lat + {ML} / 2 >= r.s
)
SELECT chi_id, CASE WHEN starts_with(name, 'χ:') THEN coalesce(own, name) ELSE name END AS name,
       CASE WHEN starts_with(name, 'χ:') THEN coalesce(own, label) ELSE label END AS label
FROM named_simple AS c LEFT JOIN k ON k.ks = c.ks AND k.kw = c.kw AND k.k = 1""",
    "region_members": """SELECT n_nationkey FROM nation
WHERE n_nationkey % 4 <> 1
  AND ((n_nationkey % 3 <> 0 AND n_nationkey % 5 = 0) OR n_nationkey % 6 = 0 OR n_nationkey = 76 OR n_nationkey % 7 = 0 OR lower(n_name) LIKE '%hare%')""",
    "road_base_names": f"""SELECT p_partkey, {_BASE % "p_name || CASE p_partkey % 5 WHEN 0 THEN ' Ave' WHEN 1 THEN ' STREET' WHEN 2 THEN '' WHEN 3 THEN ' Rd ' ELSE ' Court Place' END"} AS base FROM part""",
    "road_pretty_names": f"""WITH heads(i, head, pretty) AS ({_values([(i, *p) for i, p in enumerate(PRETTY)])}),
tails AS (SELECT p_partkey, p_name, array_to_string(list_transform(string_split(p_name, ' '), lambda w : upper(left(w, 1)) || substr(w, 2)), ' ') AS tail FROM part)
SELECT p_partkey, head || ' ' || p_name AS base, pretty || ' ' || tail AS pretty FROM tails JOIN heads ON i = p_partkey % {len(PRETTY)}""",
    "road_spans": f"WITH {_vertices(True)}, {SPANS} SELECT * FROM spans",
    "road_upper_median": f"WITH {_vertices(True)}, {MEDIANS} SELECT * FROM medians",
    "road_tiers": f"WITH {RECORDS} SELECT axis, CAST(tier AS INTEGER) AS tier, seq, name, med, lo, hi FROM records",
    "namer_avenue": f"WITH {NAMER} SELECT chi_id, avenue FROM near WHERE avenue IS NOT NULL",
    "namer_street": f"WITH {NAMER} SELECT chi_id, street FROM near WHERE street IS NOT NULL",
    "namer_fallback": f"""WITH {NAMER}, {_bands("full")}, {_by_band("cells", "full", "banded")},
mixed AS (SELECT b.chi_id, coalesce(avenue, av) AS a, coalesce(street, st) AS s FROM banded AS b JOIN near USING (chi_id))
SELECT chi_id, {_naming("a", "s", "chi_id", "full")} FROM mixed""",
    "dual_names": f"""WITH {NAMER}, {_bands("full")}, {_by_band("cells", "full", "banded")},
canon AS (SELECT chi_id, {_naming("av", "st", "chi_id", "full")} FROM banded),
local AS (SELECT chi_id, {_naming("avenue", "street", "chi_id", "full")} FROM near WHERE avenue IS NOT NULL AND street IS NOT NULL)
SELECT c.chi_id, coalesce(l.name, c.name) AS name, coalesce(l.label, c.label) AS label, c.name AS name_canon, c.label AS label_canon
FROM canon AS c LEFT JOIN local AS l ON l.chi_id = c.chi_id""",
    "road_semi": f"""WITH {_vertices(False)} SELECT base, count(*) AS n, min(seq) AS first_seq FROM v
WHERE EXISTS (SELECT 1 FROM ({_values([(b,) for b in sorted({*C.ANCHORS_NS.values(), *C.ANCHORS_EW.values()})])}) AS a(b) WHERE b = base) GROUP BY base""",
    "fit_lines": _fit_sql(_ANCHORS, False),
    "fit_lines_clipped": _fit_sql(_CLIPPED, True),
    "interpolate_lines": f"WITH {COMPLETE} SELECT axis, CAST(idx AS INTEGER) AS idx, round(slope, 9) AS slope, round(intercept, 9) AS intercept, fitted FROM complete",
    "extrapolate_lines": f"""WITH {COMPLETE}, ends AS (SELECT axis, min(idx) AS lo, max(idx) AS hi FROM complete GROUP BY axis),
more AS (
  SELECT e.axis, e.hi + n AS idx, a.slope + n * (a.slope - b.slope) AS slope, a.intercept + n * (a.intercept - b.intercept) AS intercept
  FROM ends AS e, range(1, 5) AS r(n), complete AS a, complete AS b
  WHERE a.axis = e.axis AND b.axis = e.axis AND a.idx = e.hi AND b.idx = e.hi - 1
  UNION ALL
  SELECT e.axis, e.lo - n, a.slope - n * (b.slope - a.slope), a.intercept - n * (b.intercept - a.intercept)
  FROM ends AS e, range(1, 5) AS r(n), complete AS a, complete AS b
  WHERE a.axis = e.axis AND b.axis = e.axis AND a.idx = e.lo AND b.idx = e.lo + 1
)
SELECT axis, CAST(idx AS INTEGER) AS idx, round(slope, 9) AS slope, round(intercept, 9) AS intercept
FROM (SELECT axis, idx, slope, intercept FROM complete UNION ALL SELECT * FROM more)""",
    "grid_bounds": f"""WITH {FRAME} SELECT round(min_x, 6) AS min_x, round(max_x, 6) AS max_x, round(min_y, 6) AS min_y, round(max_y, 6) AS max_y,
round(cell_lon, 6) AS cell_lon, round(sx, 6) AS sx, round(height, 6) AS height, round(greatest(4e0, least(8e0, sx * cell_lon / 5.5e0)), 6) AS font_px FROM frame""",
    "area_flags": f"""WITH f AS (SELECT {", ".join(f"{e} AS {c}" for c, e in FACE.items())} FROM supplier), r AS (SELECT face_id, round(sqmi, 3) AS a, near <= 1e-5 AS edge FROM f)
SELECT CAST(face_id AS INTEGER) AS face_id, a AS area_sqmi, edge, CASE WHEN edge THEN false ELSE a < 0.9e0 OR a > 1.1e0 END AS flag FROM r""",
    "ordinate_merge": f"WITH {SEEN} SELECT 'χ:' || chi_id AS chi_ordinate, 1e0 AS area_sqmi, CAST(4 AS BIGINT) AS parts, false AS flag FROM cells",
    "search_first_hit": f"""WITH {_named("simple", SEEN)}, asked(query) AS ({_values([(s,) for s in _SEARCHES])})
SELECT query, min(chi_id) AS chi_id FROM asked JOIN named_simple
  ON trim(query) <> '' AND (lower(chi_id) = lower(trim(query)) OR contains(lower(name), lower(trim(query))) OR contains(lower(label), lower(trim(query))))
GROUP BY query""",
    "select_by_ordinate": f"WITH {_named('simple', SEEN)} SELECT chi_id, name, label FROM named_simple WHERE chi_id = '5S3W'",
    "detail_card": f"""WITH {_named("full", SEEN)}
SELECT chi_id, 'χ:' || chi_id AS ordinate, name, CASE WHEN kw % 2 = 0 THEN 'Own' ELSE label END AS label,
       CASE WHEN kw % 2 = 0 THEN label END AS canonical, printf('%.4f, %.4f', round(lat, 6), round(lon, 6)) AS center,
       CASE WHEN ks % 2 = 0 THEN '0.88 sq mi' ELSE '1 sq mile' END AS cell, CASE WHEN ks > 3 THEN 'city-clipped' END AS edge_note
FROM named_full""",
    "deep_link": f"WITH {SEEN} SELECT chi_id, '#chi=' || chi_id AS link, 'χ:' || chi_id AS parsed, CAST(NULL AS VARCHAR) AS absent FROM cells",
    "label_text": f"WITH {_named('simple', SEEN)} SELECT chi_id, label AS token FROM named_simple",
    "point_strings": f"""WITH {FRAME}, boxes AS (SELECT chi_id, {_BOX} FROM cells)
SELECT chi_id, {" || ' ' || ".join(_PIXEL.format(x=x, y=y) for x, y in _CORNERS)} AS points FROM boxes, frame""",
    "outer_ring_parts": f"WITH {SEEN} SELECT chi_id, CAST(abs(kw) % 3 + 1 AS BIGINT) AS rings, round(lon + {MO} / 2, 6) AS east FROM cells",
    "version_join": f"""WITH {_named("simple", SEEN)}, {_named("full", cells="")}
SELECT coalesce(a.chi_id, b.chi_id) AS chi_id, a.name AS name_a, a.label AS label_a, b.name AS name_b, b.label AS label_b
FROM (SELECT * FROM named_simple WHERE ks > -5) AS a FULL JOIN (SELECT * FROM named_full WHERE ks < 12) AS b ON a.chi_id = b.chi_id""",
    "flat_table": f"WITH {_named('simple', SEEN)} SELECT 'χ:' || chi_id AS chi_ordinate, chi_id, name, label, round(lat, 6) AS center_lat, round(lon, 6) AS center_lon FROM named_simple",
    "named_grid": f"""WITH {NAMER}, {_bands("full")}, {_by_band("cells", "full", "banded")},
mixed AS (SELECT b.chi_id, coalesce(avenue, av) AS a, coalesce(street, st) AS s FROM banded AS b JOIN near USING (chi_id)),
inside AS ({textwrap.dedent(LATTICE_POLYGON.replace(f"{CELLS}, {NATIONS}", CITY_EDGES))})
SELECT chi_id, {_naming("a", "s", "chi_id", "full")} FROM mixed WHERE chi_id IN (SELECT chi_id FROM inside)""",
    "geojson_lines": f"""WITH roads(r, street_name, class) AS ({_values(ROADS)})
SELECT street_name, CAST(sum(CASE WHEN ({ROAD_SEQ}) % 3 = 1 THEN 2 ELSE 1 END) AS BIGINT) AS vertices
FROM lineitem JOIN roads ON r = l_partkey % 40 WHERE ({ROAD_SEQ}) % 3 = 1 OR (({ROAD_SEQ}) % 3 = 0 AND ({ROAD_SEQ}) % 7 <> 0) GROUP BY street_name""",
    "boundary_edges": f"""WITH {NATIONS} SELECT n_nationkey, count(*) * CASE WHEN n_nationkey % 2 = 0 THEN 2 ELSE 1 END AS edges, round(min(y1), 6) AS south
FROM edges GROUP BY n_nationkey""",
    "dissolved_outline": f"""WITH {CELLS}, inside AS ({LATTICE_POLYGON}),
kept AS (SELECT ks, kw FROM cells WHERE chi_id IN (SELECT chi_id FROM inside)),
sides AS (
  SELECT 2 * ks AS y1, 2 * ks + 2 AS y2, 2 * kw AS x1, 2 * kw AS x2 FROM kept UNION ALL SELECT 2 * ks, 2 * ks + 2, 2 * kw + 2, 2 * kw + 2 FROM kept
  UNION ALL SELECT 2 * ks, 2 * ks, 2 * kw, 2 * kw + 2 FROM kept UNION ALL SELECT 2 * ks + 2, 2 * ks + 2, 2 * kw, 2 * kw + 2 FROM kept
),
once AS (SELECT x1, x2, y1, y2 FROM sides GROUP BY ALL HAVING count(*) = 1)
SELECT round({LON0} - x2 / 2 * {MO}, 6) AS x_low, round({LON0} - x1 / 2 * {MO}, 6) AS x_high,
       round({LAT0} - y2 / 2 * {ML}, 6) AS y_low, round({LAT0} - y1 / 2 * {ML}, 6) AS y_high FROM once""",
    "outline_rings": f"""WITH {CELLS}, n AS (
  SELECT CASE WHEN n_nationkey < 15 THEN 0 ELSE 1 END AS block, n_nationkey // 5 + CASE WHEN n_nationkey >= 15 THEN 4 ELSE 0 END AS ks, n_nationkey % 5 AS kw
  FROM nation WHERE n_nationkey < 25 AND n_nationkey NOT IN (7, 18, 19)
),
k AS (SELECT n.block, n.ks, n.kw, lat, lon FROM cells JOIN n ON n.ks = cells.ks AND n.kw = cells.kw)
SELECT CAST(block AS BIGINT) AS part, CAST(2 * (count(DISTINCT ks) + count(DISTINCT kw)) + 1 AS BIGINT) AS vertices,
       CAST(count(*) + CASE WHEN block = 0 THEN 1 ELSE 0 END AS DOUBLE) AS area_sqmi, round(min(lon) - {MO} / 2, 6) AS west, round(min(lat) - {ML} / 2, 6) AS south,
       round(max(lon) + {MO} / 2, 6) AS east, round(max(lat) + {ML} / 2, 6) AS north FROM k GROUP BY block""",
    "overlay_convex": OVERLAY_CONVEX,
    "overlay_merged": f"""WITH {SEEN} SELECT 'χ:' || chi_id AS chi_ordinate, round({MO} * {ML}, 10) AS area,
  round(CASE WHEN ks % 2 = 0 THEN lat - 3 * {ML} / 8 ELSE lat - {ML} / 4 END, 6) AS lat, kw = 0 AS edge, false AS flag, CAST(2 AS BIGINT) AS parts FROM cells""",
    "overlay_dissolved": f"""WITH {SEEN} SELECT 'χ:' || chi_id AS chi_ordinate, CAST(1 AS BIGINT) AS parts, CAST(7 AS BIGINT) AS vertices, round({MO} * {ML}, 8) AS area FROM cells""",
    "airport_labels": f"""WITH {_named("simple")}, {NATIONS}, own AS (SELECT * FROM edges WHERE n_nationkey % 5 = 2 OR n_nationkey = 13 OR n_nationkey = 76),
boxes AS (SELECT *, {_BOX} FROM cells),
met AS (
  SELECT chi_id FROM boxes AS c WHERE
    EXISTS (SELECT 1 FROM own AS e WHERE (x1 BETWEEN c.w AND c.e AND y1 BETWEEN c.s AND c.n) OR {" OR ".join(_segments_cross(p, q) for p, q in _SIDES)})
    OR (SELECT count(*) FROM own AS e WHERE {_LEFT_OF.format(x="c.lon", y="c.lat")}) % 2 = 1
),
k AS (
  SELECT chi_id, 'OHare-' || CAST(9 - CASE WHEN ks >= 0 THEN ks + 1 ELSE -ks END + 1 AS BIGINT) || chr(CAST(65 + 17 - CASE WHEN kw >= 0 THEN kw + 1 ELSE -kw END AS INTEGER)) AS own
  FROM cells WHERE chi_id IN (SELECT chi_id FROM met)
)
SELECT c.chi_id, CASE WHEN starts_with(name, 'χ:') THEN coalesce(own, name) ELSE name END AS name,
       CASE WHEN starts_with(name, 'χ:') THEN coalesce(own, label) ELSE label END AS label
FROM named_simple AS c LEFT JOIN k ON k.chi_id = c.chi_id""",
    "fit_lines_windows": _fit_sql(_WINDOWED, True),
    "anchor_windows": f"""WITH {_vertices(False)}
SELECT axis, CAST(idx AS INTEGER) AS idx, base, north, south, cap FROM ({_values(_WINDOWED)}) AS t(axis, idx, base, north, south, cap) WHERE base IN (SELECT base FROM v)""",
    "geojson_features": f"""WITH {_named("full", SEEN)}
SELECT chi_id, 'χ:' || chi_id AS chi_ordinate, name, label, round(lon, 6) AS lon, round(lat, 6) AS lat, 'Feature' AS kind, 'Polygon' AS shape,
       CAST(5 AS BIGINT) AS vertices, round(lon - {MO} / 2, 6) AS west FROM named_full""",
    "geojson_collection": f"""WITH {_named("simple", SEEN)}
SELECT CAST(row_number() OVER (ORDER BY chi_id) - 1 AS INTEGER) AS seq, chi_id, name, label, CAST(1 AS BIGINT) AS polygons FROM named_simple""",
    "collection_head": f"""WITH {SEEN} SELECT 'FeatureCollection' AS kind, CAST(1 AS BIGINT) AS cell_miles, count(*) AS cells FROM cells WHERE ks > 3
UNION ALL SELECT 'FeatureCollection', 2, 0""",
    "shapes_of_parts": f"""WITH {SEEN} SELECT chi_id, CASE WHEN ks % 3 = 0 THEN 'MultiPolygon' ELSE 'Polygon' END AS kind,
CAST(CASE WHEN ks % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS parts FROM cells""",
    "boundary_read": f"""WITH {NATIONS}
SELECT CAST(n_nationkey AS BIGINT) * 100000 AS part, count(*) AS filled, count(*) + CASE WHEN n_nationkey % 3 = 0 THEN 3 ELSE 0 END AS edges,
       round((abs(sum(x1 * y2 - x2 * y1)) / 2 - CASE WHEN n_nationkey % 3 = 0 THEN 2e-4 ELSE 0e0 END) / ({ML} * {MO}), 3) AS area_sqmi
FROM edges GROUP BY n_nationkey""",
    "centerlines_read": f"""WITH roads(r, street_name, class) AS ({_values(ROADS)})
SELECT street_name, class, count(*) AS vertices, round(min({ROAD_LON}), 6) AS west, round(max({ROAD_LON}), 6) AS east
FROM lineitem JOIN roads ON r = l_partkey % 40 GROUP BY street_name, class""",
    "grid_csv_read": f"""WITH {_named("full", SEEN)}
SELECT 'χ:' || chi_id AS chi_ordinate, chi_id, name, label, name AS name_canon, label AS label_canon, round(lat, 6) AS center_lat, round(lon, 6) AS center_lon,
       CASE WHEN ks % 2 = 0 THEN 1.05e0 ELSE 0.875e0 END AS area_sqmi, kw % 3 = 0 AS edge, kw % 3 <> 0 AND ks % 2 <> 0 AS flag FROM named_full""",
    "boundary_repaired": """SELECT CAST(row_number() OVER (ORDER BY n_nationkey) - 1 AS BIGINT) AS place, CAST(CASE WHEN n_nationkey % 3 = 1 THEN 1 ELSE 2 END AS BIGINT) AS parts,
       round((n_nationkey % 7 * 1000 + 12000)::DOUBLE * (n_nationkey % 4 * 2000 + 8000) / CASE WHEN n_nationkey % 3 = 0 THEN 2 ELSE 1 END / 1e6, 3) AS area FROM nation""",
    "boundary_union": """WITH b AS (
  SELECT s_nationkey AS n, s_suppkey * 7919 % 61 AS w, s_suppkey * 104729 % 53 AS s, s_suppkey * 7919 % 61 + s_suppkey % 13 + 4 AS e, s_suppkey * 104729 % 53 + s_suppkey % 11 + 4 AS t FROM supplier
),
squares AS (SELECT DISTINCT n, x, y FROM (SELECT n, s, t, unnest(range(w, e)) AS x FROM b) AS c, LATERAL (SELECT unnest(range(c.s, c.t)) AS y) AS r)
SELECT n AS s_nationkey, CAST(count(*) AS DOUBLE) AS area FROM squares GROUP BY n""",
    "boundary_closed": """WITH k AS (SELECT n_nationkey, (n_nationkey % 4 + 1) * 500 AS gap FROM nation)
SELECT n_nationkey, CAST(CASE WHEN n_nationkey % 2 = 0 AND gap > 1200 THEN 2 ELSE 1 END AS BIGINT) AS parts,
       CAST(CASE WHEN n_nationkey % 2 = 0 THEN 144 + CASE WHEN gap < 1200 THEN gap * 9 // 1000 ELSE 0 END ELSE 144 - CASE WHEN gap < 1200 THEN 0 ELSE gap * 10 // 1000 END END AS DOUBLE) AS area FROM k""",
    "lines_polygonized": """WITH
x AS (SELECT n, v, lead(v) OVER (PARTITION BY n ORDER BY v) AS after FROM (SELECT DISTINCT s_nationkey AS n, s_suppkey * 7919 % 97 AS v FROM supplier)),
y AS (SELECT n, v, lead(v) OVER (PARTITION BY n ORDER BY v) AS after FROM (SELECT DISTINCT s_nationkey AS n, s_suppkey * 104729 % 89 AS v FROM supplier))
SELECT x.n AS s_nationkey, round((x.v * 1000 - 87900000)::DOUBLE / 1e6, 6) AS west, CAST((x.after - x.v) * (y.after - y.v) AS DOUBLE) AS area, CAST(1 AS BIGINT) AS rings
FROM x JOIN y ON x.n = y.n WHERE x.after IS NOT NULL AND y.after IS NOT NULL""",
    "region_pip_long": """WITH
coast AS (SELECT event_id AS i, event_id * 7919 % 1000 + 500 AS y, lead(event_id * 7919 % 1000 + 500) OVER (ORDER BY event_id) AS after FROM events),
spots AS (SELECT l_orderkey, l_linenumber, l_orderkey * 31 + l_linenumber * 7919 AS n FROM lineitem),
p AS (SELECT l_orderkey, l_linenumber, n * 17 % (SELECT count(*) * 20 FROM events) AS x, n % 1700 - 100 AS y FROM spots)
SELECT l_orderkey, l_linenumber FROM p JOIN coast ON i = x // 20
WHERE p.y >= 0 AND CASE WHEN after IS NULL THEN x % 20 = 0 AND p.y <= coast.y ELSE p.y * 20 <= coast.y * (20 - x % 20) + after * (x % 20) END""",
    "shapes_meeting": """WITH
s AS (SELECT s_suppkey AS a, s_suppkey * 7919 % 400 * 1000 - 87900000 AS x, s_suppkey * 104729 % 320 * 1000 + 41640000 AS y, s_suppkey % 9 * 4000 + 2000 AS w, s_suppkey % 7 * 5000 + 2000 AS h FROM supplier),
n AS (SELECT n_nationkey AS b, n_nationkey % 5 * 70000 - 87900000 AS x, n_nationkey // 5 * 60000 + 41650000 AS y FROM nation),
sv AS (SELECT a, 1 AS i, x, y FROM s UNION ALL SELECT a, 2, x + w, y + h FROM s UNION ALL SELECT a, 3, x - w, y + h * 2 FROM s),
nv AS (SELECT b, o.i, x + dx AS x, y + dy AS y FROM n, (VALUES (1, 0, 0), (2, 80000, 0), (3, 80000, 70000), (4, 40000, 30000), (5, 20000, 70000), (6, 0, 50000)) AS o(i, dx, dy)),
se AS (SELECT p.a, p.x AS x1, p.y AS y1, q.x AS x2, q.y AS y2 FROM sv AS p JOIN sv AS q ON p.a = q.a AND q.i = p.i % 3 + 1),
ne AS (SELECT p.b, p.x AS u1, p.y AS v1, q.x AS u2, q.y AS v2 FROM nv AS p JOIN nv AS q ON p.b = q.b AND q.i = p.i % 6 + 1),
crossing AS (
  SELECT DISTINCT a, b FROM se JOIN ne ON greatest(x1, x2) >= least(u1, u2) AND greatest(u1, u2) >= least(x1, x2) AND greatest(y1, y2) >= least(v1, v2) AND greatest(v1, v2) >= least(y1, y2)
  WHERE sign(CAST((x2 - x1) * (v1 - y1) - (y2 - y1) * (u1 - x1) AS DOUBLE)) * sign(CAST((x2 - x1) * (v2 - y1) - (y2 - y1) * (u2 - x1) AS DOUBLE)) <= 0
    AND sign(CAST((u2 - u1) * (y1 - v1) - (v2 - v1) * (x1 - u1) AS DOUBLE)) * sign(CAST((u2 - u1) * (y2 - v1) - (v2 - v1) * (x2 - u1) AS DOUBLE)) <= 0
),
within AS (
  SELECT a, b FROM (SELECT * FROM sv WHERE i = 1) AS p JOIN ne ON (v1 > y) <> (v2 > y) AND x < u1 + (y - v1)::DOUBLE * (u2 - u1) / (v2 - v1) GROUP BY a, b HAVING count(*) % 2 = 1
  UNION ALL
  SELECT a, b FROM (SELECT * FROM nv WHERE i = 1) AS p JOIN se ON (y1 > y) <> (y2 > y) AND x < x1 + (y - y1)::DOUBLE * (x2 - x1) / (y2 - y1) GROUP BY a, b HAVING count(*) % 2 = 1
)
SELECT a AS s_suppkey, b AS n_nationkey FROM crossing UNION SELECT a, b FROM within""",
    "faces_within": """WITH b AS (
  SELECT s_suppkey, s_suppkey * 7919 % 110 - 5 AS w, s_suppkey * 104729 % 160 - 5 AS s, s_suppkey % 5 * 2 + 5 AS wide, s_suppkey % 3 * 5 + 5 AS high FROM supplier
),
-- Blocks 0 and 1 of a row are one shape, and so are 3 and 4.
runs AS (SELECT n_nationkey // 5 * 30 AS low, CASE WHEN n_nationkey % 5 < 2 THEN 0 ELSE 60 END AS west, min(n_nationkey % 5) * 20 AS first, (max(n_nationkey % 5) + 1) * 20 AS after
  FROM nation WHERE n_nationkey % 5 <> 2 GROUP BY 1, 2)
SELECT s_suppkey FROM b JOIN runs ON w >= first AND w + wide <= after AND s >= low AND s + high <= low + 20""",
}
