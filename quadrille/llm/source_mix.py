"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is wanted ``target / source_size`` times.  The whole
part is taken outright; the fraction is a copy probability.  Fractions are
rounded in pairs: mass (probability times words) moves from one document of a
pair to the other, in a direction drawn so that expectations stay, until one of
the two is integral.  The other goes on to the next pair.  Blocks of documents
fold in parallel, each leaving at most one fractional document, and a reduction
tree with ``fan_in`` children per node folds those until a source has one.  The
moved mass is conserved in every pair, so a source misses its target by less
than its last document.

DataFrame functions only; texts are read once, to count words, and not moved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm._store import Scratch, running_sums

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, cap: float) -> DataFrame:
    """One row per source: source, source_size, n, target.

    Sources in code-point order, null last, take ``weights`` in turn and share
    ``share`` times all words; no target exceeds ``cap`` times its source.  The
    excess of capped sources is shared again by weight, round by round, until
    none is above; a round is one aggregation over the sources, and each caps
    one more at least.
    """
    scratch = Scratch(sizes.sparkSession, "targets")
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    numbered = running_sums(scratch, per, [F.col("source").isNull(), F.col("source")], F.lit(1).cast("long"), "by-name")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("before") % len(weights) + 1).cast("int"))
    per = numbered.withColumn("weight", weight).withColumn("top", F.col("source_size") * F.lit(float(cap))).drop("before")
    per = scratch.save(per, "weighed")
    level, before = 0.0, -1
    while True:
        # Whether a source is capped at the level of the round before.
        capped = F.lit(level) * F.col("weight") >= F.col("top")
        found = per.agg(
            F.sum("source_size").alias("all"),
            F.count_if(capped).alias("n"),
            F.sum(F.when(capped, F.col("top"))).alias("top"),
            F.sum(F.when(~capped, F.col("weight"))).alias("open"),
        ).first()
        if found["n"] == before or not found["open"]:
            break
        level, before = ((found["all"] or 0) * share - (found["top"] or 0.0)) / found["open"], found["n"]
    return per.select("source", "source_size", "n", F.when(capped, F.col("top")).otherwise(F.lit(level) * F.col("weight")).alias("target"))


def _uniform(*cols: Column) -> Column:
    """A number in [0, 1) that depends on nothing but the columns."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11) * F.lit(2.0**-53)


def _fold(units: Column, seed: int, level: int) -> Column:
    """Sorted units -> struct(carry, done): pairs them until one is left."""
    unit = "struct<doc_id:bigint,nth:bigint,size:bigint,base:bigint,mass:double>"
    done = "array<struct<doc_id:bigint,size:bigint,copies:bigint>>"
    start = F.struct(F.lit(None).cast(unit).alias("carry"), F.array().cast(done).alias("done"))

    def unit_of(x: Column, mass: Column) -> Column:
        return F.struct(*[x[c].alias(c) for c in ("doc_id", "nth", "size", "base")], mass.alias("mass"))

    def close(acc: Column, x: Column, extra: int) -> Column:
        return F.concat(
            acc["done"],
            F.array(F.struct(x["doc_id"].alias("doc_id"), x["size"].alias("size"), (x["base"] + extra).alias("copies"))),
        )

    def step(acc: Column, b: Column) -> Column:
        a = acc["carry"]
        room_a, room_b = a["size"] - a["mass"], b["size"] - b["mass"]
        gain_a, gain_b = F.least(room_a, b["mass"]), F.least(a["mass"], room_b)
        draw = _uniform(F.lit(seed), F.lit(level), *[x[c] for x in (a, b) for c in ("doc_id", "nth")])
        to_a = draw * (gain_a + gain_b) < gain_b

        def out(carry: Column, closed: Column) -> Column:
            return F.struct(carry.alias("carry"), closed.alias("done"))

        return (
            F.when(a.isNull(), out(unit_of(b, b["mass"]), acc["done"]))
            .when(to_a & (room_a <= b["mass"]), out(unit_of(b, b["mass"] - room_a), close(acc, a, 1)))
            .when(to_a, out(unit_of(a, a["mass"] + b["mass"]), close(acc, b, 0)))
            .when(room_b <= a["mass"], out(unit_of(a, a["mass"] - room_b), close(acc, b, 1)))
            .otherwise(out(unit_of(b, b["mass"] + a["mass"]), close(acc, a, 0)))
        )

    return F.aggregate(units, start, step)


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    cap: float = 2.0,
    fan_in: int = 256,
    seed: int = 20240229,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.

    ``copies`` is how often the mix takes the document and ``taken`` is
    ``copies * size``.  Null or empty texts have size 0 and are taken 0 times.
    Null sources form one source, the last.  Texts of any length are counted
    whole.  Rows repeated with one id are units of their own and fall into blocks
    of their own; ties of size are broken by hashes.  Draws are hashes of ids and ``seed``, so reruns agree,
    whatever the partitioning.  Other columns are ignored; an empty table gives
    an empty result.  ``copies`` never exceeds the least whole number that is
    at least ``target / source_size``.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    sizes = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")
    )
    # Rows alike in all of these are told apart by a number, however they are partitioned.
    sizes = scratch.save(sizes.groupBy("source", "doc_id", "size").agg(F.count("*").alias("alike")), "sizes")
    sizes = sizes.select("source", "doc_id", "size", F.explode(F.sequence(F.lit(1).cast("long"), "alike")).alias("nth"))
    targets = scratch.save(source_targets(sizes, weights, share, cap), "targets")
    most = targets.agg(F.max("n")).first()[0] or 0

    t = targets.select(F.col("source").alias("__source"), "source_size", "target", "n")
    units = sizes.join(t, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    units = units.withColumn("base", F.floor(rate)).withColumn("mass", (rate - F.floor(rate)) * F.col("size"))
    keys = ["source", "source_size", "target"]
    whole = (F.col("size") == 0) | (F.col("mass") <= 0)
    ready = units.where(whole).select("doc_id", "size", F.when(F.col("size") > 0, F.col("base")).otherwise(0).cast("long").alias("copies"), *keys)

    blocks = F.ceil(F.col("n") / fan_in)
    fractional = units.where(~whole).withColumn("block", F.pmod(F.xxhash64("doc_id", "nth", "size", F.lit(seed)), blocks))
    width, level = -(-most // fan_in), 0
    while True:
        packed = fractional.groupBy(*keys, "block").agg(
            F.array_sort(
                F.collect_list(F.struct((-F.col("size")).alias("o"), F.xxhash64("doc_id", "nth", F.lit(seed + 1)).alias("h"), "doc_id", "nth", "size", "base", "mass"))
            ).alias("units")
        )
        folded = scratch.save(packed.select(*keys, "block", _fold(F.col("units"), seed, level).alias("f")), f"level-{level}")
        ready = ready.unionByName(folded.select(*keys, F.explode("f.done").alias("d")).select("d.*", *keys))
        left = folded.select(*keys, "block", "f.carry.*")
        if width <= 1:
            break
        fractional = left.withColumn("block", F.expr(f"block div {fan_in}"))
        width, level = -(-width // fan_in), level + 1

    last = _uniform(F.lit(seed), F.lit(-1), F.col("doc_id"), F.col("nth")) * F.col("size") < F.col("mass")
    ready = ready.unionByName(left.select("doc_id", "size", (F.col("base") + last.cast("long")).alias("copies"), *keys))
    return ready.select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
