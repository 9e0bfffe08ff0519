"""Connected components by alternating large-star and small-star rounds.

Every round is two aggregations (with map-side combine, so a hub node costs a
row per task) and two joins; edges stay distributed throughout.  The number of
rounds grows with the logarithm of the longest path.  Only one count and one
checksum per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrille.llm._store import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (
        both.join(least, "u")
        .where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m")))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (
        edges.join(least, "u")
        .where(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("u", "v")).alias("x"),
    ).first()
    return row["n"], row["x"]


def connected_components(edges: DataFrame, scratch: Scratch, label: str = "cc") -> DataFrame:
    """Edges ``(a, b)`` of any ordered type -> ``(node, component)``.

    ``component`` is the smallest node that can be reached.  Nodes without an
    edge to another node are absent.  Null ends and self-loops are ignored; an
    empty input gives an empty result.
    """
    now = scratch.save(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        f"{label}-0",
    )
    state, turn = _state(now), 0
    while state[0]:
        turn += 1
        after = scratch.save(_small_star(_large_star(now)), f"{label}-{turn}")
        if turn > 1:
            scratch.drop(f"{label}-{turn - 1}")
        now, before, state = after, state, _state(after)
        if state == before:
            break
    return (
        now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        .unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")))
        .distinct()
    )
