"""Fixed values of the grid: its origin, its scale, and the roads that name it.

The road tables are data of the published grid and must equal it for right
results; see NOTICE for their licence.
"""

from __future__ import annotations

import math

# Fixed values.
ORIGIN_LAT, ORIGIN_LON = 41.88197, -87.62768
MILE_LAT = 1.0 / 69.0
MILE_LON = MILE_LAT / math.cos(math.radians(ORIGIN_LAT))
PREFIX = "χ:"
BAND_SLACK = 1e-9
#: Extent without a boundary: south, north, west, east.
DEFAULT_EXTENT = (41.62, 42.06, -87.95, -87.50)

# Roads by mile band from the origin.
AVENUES_WEST = (
    "River", "Racine", "Damen", "California", "Central Park", "Kostner", "Laramie", "Austin", "Oak Park", "Oriole", "Cumberland",
)
AVENUES_EAST = ("Martin Luther King", "Woodlawn", "Jeffery", "Burnham", "Avenue L")
STREETS_SOUTH = (
    "Congress", "16th", "26th", "35th", "43rd", "51st", "59th", "67th", "75th", "83rd", "91st", "99th", "107th", "115th", "123rd", "130th",
)
STREETS_NORTH = ("Kinzie", "Division", "Armitage", "Diversey", "Addison", "Montrose", "Foster", "Peterson", "Pratt", "Howard")
SHORT_OVERRIDES = {"Division": "Divi", "Diversey": "Dive"}

# Roads that bound cells, and roads off the grid that may name avenues.
MILE_ROADS_NS = ("State", "Halsted", "Ashland", "Western", "Kedzie", "Pulaski", "Cicero", "Central", "Harlem")
MILE_ROADS_EW = (
    "Madison", "Roosevelt", "Cermak", "31st", "Pershing", "47th", "Garfield", "63rd",
    "North", "Fullerton", "Belmont", "Irving Park", "Lawrence", "Bryn Mawr", "Devon", "Chicago",
)
DIAGONALS = (
    "broadway", "sheridan", "clark", "lincoln", "milwaukee", "clybourn", "elston", "ridge", "blue island",
    "indianapolis", "brainard", "avenue o", "archer", "ogden", "grand",
)
ROAD_TYPES = (
    "avenue", "street", "boulevard", "road", "drive", "place", "parkway", "court", "terrace", "lane", "way",
    "ave", "st", "blvd", "rd", "dr", "pl",
)
SKIPPED_CLASSES = ("1", "5", "9", "99", "RIV", "E", "S", "")

# Mile roads by signed mile, west and south positive.
ANCHORS_NS = {
    0: "state", 1: "halsted", 2: "ashland", 3: "western", 4: "kedzie", 5: "pulaski", 6: "cicero", 7: "central",
    8: "narragansett", 9: "harlem", 11: "east river", 13: "mannheim",
    -1: "cottage grove", -2: "stony island", -3: "yates", -4: "burley",
}
ANCHORS_EW = {
    0: "madison", -1: "chicago", -2: "north", -3: "fullerton", -4: "belmont", -5: "irving park",
    -6: "lawrence", -7: "bryn mawr", -8: "devon", -9: "touhy", -10: "howard",
    1: "roosevelt", 2: "cermak", 3: "31st", 4: "pershing", 5: "47th", 6: "garfield", 7: "63rd",
    8: "71st", 9: "79th", 10: "87th", 11: "95th", 12: "103rd", 13: "111th", 14: "119th",
    15: "127th", 16: "135th",
}
#: Miles south (north end, south end) of the run that is fitted.
FIT_WINDOWS = {"stony island": (None, 12.0), "cottage grove": (4.0, 11.0)}
#: Miles west up to which an E/W road is fitted.
WEST_CAP, WEST_CAPS = 12.0, {"bryn mawr": 9.5}
FIT_LEAST = 6
EXTEND = 4
AREA_TOLERANCE = (0.9, 1.1)
#: Miles: reach of a name, slack at a road's ends, least run of a through road, reach at the edges.
NAME_MILES, SPAN_MILES, BROAD_MILES, WIDE_MILES = 0.6, 0.2, 1.0, 1.6
OHARE = {"name": "OHare", "n_origin": 9, "w_origin": 17, "area_id": "76", "like": "hare"}
FEATURED = 8

#: Degrees that a boundary is grown and shrunk by, to close the seams of its parts.
CLOSE_DEGREES = 0.0006
