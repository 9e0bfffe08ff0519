"""Grids from files: GeoJSON on standard output, the number of cells on standard error.

    python -m quadrille regular [--boundary PATH]
    python -m quadrille streets --boundary PATH --centerlines PATH
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from quadrille.constants import CLOSE_DEGREES
from quadrille.plans import grids
from quadrille.sources import geojson

REGULAR = ["chi_id", "chi_ordinate", "name", "label", "center"]
STREETS = ["chi_id", "chi_ordinate", "name", "label", "name_canon", "label_canon", "center", "area_sqmi", "edge", "flag"]


def collection(spark: SparkSession, args: argparse.Namespace) -> tuple[DataFrame, DataFrame]:
    """(one row with the whole collection as ``json``, its cells)."""
    if args.kind == "regular":
        edges = grids.boundary_edges(geojson.read_boundary(spark, args.boundary)) if args.boundary else None
        cells = grids.regular_grid(spark, edges, dialect="simple")
        head = {"system": "square mile grid", "origin": "State & Madison", "cell_miles": 1}
        return geojson.feature_collection(geojson.feature_json(cells, REGULAR), head), cells
    cells = grids.street_grid(geojson.read_boundary(spark, args.boundary), geojson.read_centerlines(spark, args.centerlines), close=CLOSE_DEGREES, dissolve=True)
    head = {"system": "square mile grid", "origin": "State & Madison", "aligned": "mile_roads", "edges": "straight_fit"}
    return geojson.feature_collection(geojson.feature_json(cells, STREETS, "MultiPolygon"), head), cells


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="quadrille", description=__doc__)
    kinds = parser.add_subparsers(dest="kind", required=True)
    kinds.add_parser("regular").add_argument("--boundary")
    streets = kinds.add_parser("streets")
    streets.add_argument("--boundary", required=True)
    streets.add_argument("--centerlines", required=True)
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("quadrille").getOrCreate()
    whole, cells = collection(spark, args)
    text = whole.first()["json"]
    # Regular grids are indented by one; both are unescaped.
    print(json.dumps(json.loads(text), ensure_ascii=False, indent=1) if args.kind == "regular" else text)
    print(f"wrote {cells.count()} cells", file=sys.stderr)


if __name__ == "__main__":
    main()
