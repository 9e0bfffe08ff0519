"""Names, labels and road names as column expressions.

Two dialects: ``full`` is the library's; ``simple`` leaves the first western and
the first southern band unnamed and knows no exceptions in labels.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quadrille import constants as C
from quadrille.functions.coords import band, miles_south, miles_west, ordinate

FULL, SIMPLE = "full", "simple"


def _road(table: tuple[str, ...], at: Column) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(r) for r in table]), at.cast("int")), F.lit(""))


def band_roads(lat: Column, lon: Column, dialect: str = FULL) -> tuple[Column, Column]:
    """(avenue, street) of the bands that a point lies in; empty where there is none."""
    s, w = miles_south(lat), miles_west(lon)
    west, south = C.AVENUES_WEST, C.STREETS_SOUTH
    if dialect == SIMPLE:
        west, south = ("", *west[1:]), ("", *south[1:])
    avenue = F.when(w >= 0, _road(west, band(w))).otherwise(_road(C.AVENUES_EAST, band(w)))
    street = F.when(s >= 0, _road(south, band(s))).otherwise(_road(C.STREETS_NORTH, band(s)))
    return avenue, street


def short_token(name: Column, dialect: str = FULL) -> Column:
    """The part of a label that stands for a road."""
    parts = F.split(F.trim(name), r"\s+")
    head = F.get(parts, F.lit(0))
    token = F.when(head.rlike(r"^\d"), F.regexp_replace(head, r"\D", "")).otherwise(F.substring(head, 1, 3))
    if dialect == SIMPLE:
        return token
    lettered = F.startswith(name, F.lit("Avenue ")) & (F.size(parts) == 2)
    out = F.when(lettered, F.get(parts, F.lit(1))).otherwise(token)
    for road, short in C.SHORT_OVERRIDES.items():
        out = F.when(name == road, F.lit(short)).otherwise(out)
    return out


def named(avenue: Column, street: Column, ord_: Column, dialect: str = FULL) -> tuple[Column, Column]:
    """(name, label) of a cell from its two roads, or from its ordinate if either is empty or null."""
    both = (F.coalesce(avenue, F.lit("")) != "") & (F.coalesce(street, F.lit("")) != "")
    name = F.when(both, F.concat(avenue, F.lit("–"), street, F.lit(" chi"))).otherwise(F.concat(ord_, F.lit(" chi")))
    label = F.when(both, F.concat(short_token(avenue, dialect), short_token(street, dialect))).otherwise(ord_)
    return name, label


def name_and_label(lat: Column, lon: Column, dialect: str = FULL) -> tuple[Column, Column]:
    """(name, label) by the bands of a point."""
    avenue, street = band_roads(lat, lon, dialect)
    return named(avenue, street, ordinate(lat, lon), dialect)


def base_road_name(name: Column) -> Column:
    """Lower case, stripped, without one trailing road type; empty for null."""
    strip = lambda c: F.regexp_replace(c, r"^\s+|\s+$", "")
    low = strip(F.lower(F.coalesce(name.cast("string"), F.lit(""))))
    return strip(F.regexp_replace(low, rf"\s+({'|'.join(C.ROAD_TYPES)})$", ""))


def pretty_road_name(base: Column) -> Column:
    """Each run of letters capitalised, but ordinals as in 43rd and Mc names as in McClurg."""
    runs = F.regexp_extract_all(base, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))

    def title(run: Column, i: Column) -> Column:
        before = F.coalesce(F.get(runs, i - 1), F.lit(""))
        up = F.initcap(run)
        ordinal = run.rlike(r"(?i)^(st|nd|rd|th)$") & before.rlike(r"\d$")
        ordinal &= ~F.coalesce(F.get(runs, i + 1), F.lit("")).rlike(r"^[\d_]")
        scots = up.rlike("^Mc[a-z]") & ~before.rlike(r"[\d_]$")
        return F.when(ordinal, F.lower(run)).when(scots, F.concat(F.lit("Mc"), F.initcap(F.substring(up, 3, 999)))).otherwise(up)

    return F.array_join(F.transform(runs, title), "")
