"""Importance resampling towards a target: documents drawn by how much likelier their n-grams are there.

The position table has a row for each word; ``lead`` over a document's rows
appends the words that follow, and each run of words is hashed to one of a fixed
number of buckets.  A document's rows stay where the document is: whole documents
are dealt out by a row number ahead of ``posexplode``, so that neither the window nor
the sums by document shuffle a word.  Counts of buckets and their gains are tables
of at most ``buckets`` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm._store import Scratch, running_sums

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def position_table(rows: DataFrame, orders: int, buckets: int) -> DataFrame:
    """(row, doc_id, b1 .. bn) of (row, doc_id, text): for each word the buckets of the runs that begin with it.

    A run that would pass the end of the text is null.  A text without words has
    one row, of nulls.  ``row`` must tell all rows apart.
    """
    dealt = rows.repartition("row").sortWithinPartitions("row")
    words = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(WORD), F.lit(0))
    placed = dealt.select("row", "doc_id", F.posexplode_outer(words).alias("pos", "w1"))
    inside = Window.partitionBy("row").orderBy("pos")
    placed = placed.select("row", "doc_id", "w1", *[F.lead("w1", k).over(inside).alias(f"w{k + 1}") for k in range(1, orders)])

    def bucket(n: int) -> Column:
        run = F.concat(F.col("w1"), *[x for k in range(2, n + 1) for x in (F.lit(" "), F.col(f"w{k}"))])
        return (F.crc32(run.cast("binary")) % buckets).cast("int").alias(f"b{n}")

    return placed.select("row", "doc_id", *[bucket(n) for n in range(1, orders + 1)])


def _runs(positions: DataFrame, orders: int) -> DataFrame:
    """(row, bucket) of every run."""
    every = F.explode(F.array(*[f"b{n}" for n in range(1, orders + 1)])).alias("bucket")
    return positions.select("row", every).where("bucket IS NOT NULL")


def _counts(positions: DataFrame, orders: int) -> DataFrame:
    return _runs(positions, orders).groupBy("bucket").agg(F.count("*").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) from counts (bucket, n) of both sides: thousandfold log of the smoothed ratio, rounded down.

    Every bucket has a row, also one that neither side has.
    """
    total = lambda counts: counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    raw_total, target_total = total(raw), total(target)
    held = raw.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    held = held.join(raw.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    plus = lambda c: F.coalesce(c, F.lit(0)).cast("double") + 1.0
    ratio = plus("t") * F.lit(float(raw_total + buckets)) / (plus("s") * F.lit(float(target_total + buckets)))
    return held.select("bucket", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("gain"))


def draw_noise(doc_id: Column, seed: int) -> Column:
    """A thousandfold Gumbel value of the id, rounded down; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    orders: int = 3,
    buckets: int = 10_000,
    least_words: int = 20,
    percent: int = 5,
    seed: int = 42,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_features, weight, score, rank.

    Words are runs of letters and digits beyond ASCII too, A-Z in lower case;
    features are all runs of 1 to ``orders`` words, repeats counted, hashed to
    ``buckets``.  A bucket's gain compares its smoothed share of ``target`` with that of
    ``docs``; ``weight`` sums the gains of a document's features.  ``score`` adds noise
    that depends on seed and id alone, so reruns draw the same documents.  Of the
    documents with ``least_words`` or more, ``percent`` in a hundred (rounded down)
    are drawn, the highest scores first: ``rank`` is 1, 2, 3 and so on, and null
    for the others.  Of equal scores the smaller id comes first, null ids last, and
    of equal ids the larger weight.

    Null texts and texts without words have no features and weigh 0.  Every row is
    a document, also one that repeats an id.  Texts of any length are read whole.
    Other columns are neither read nor returned.  An empty target gives gains from
    ``docs`` alone; an empty table an empty result.
    """
    scratch = Scratch(docs.sparkSession, "resampling")
    numbered = lambda df, of, text: df.select(F.monotonically_increasing_id().alias("row"), of.alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    positions = scratch.save(position_table(numbered(docs, F.col(f"`{id_col}`"), text_col), orders, buckets), "positions")
    wanted = position_table(numbered(target, F.lit(None).cast("string"), target_text_col), orders, buckets)
    raw, aim = scratch.save(_counts(positions, orders), "raw"), scratch.save(_counts(wanted, orders), "target")
    # As many rows as there are buckets, whatever the size of the tables.
    gains = F.broadcast(scratch.save(bucket_gains(raw, aim, buckets), "gains"))
    at = lambda n: gains.select(F.col("bucket").alias(f"b{n}"), F.col("gain").alias(f"g{n}"))
    known = positions
    for n in range(1, orders + 1):
        known = known.join(at(n), f"b{n}", "left")
    gain = sum((F.coalesce(f"g{n}", F.lit(0).cast("long")) for n in range(2, orders + 1)), F.coalesce("g1", F.lit(0).cast("long")))
    present = sum((F.col(f"b{n}").isNotNull().cast("long") for n in range(2, orders + 1)), F.col("b1").isNotNull().cast("long"))
    weighed = known.groupBy("row", "doc_id").agg(F.sum(F.col("b1").isNotNull().cast("long")).alias("n_words"), F.sum(present).alias("n_features"), F.sum(gain).alias("weight"))
    weighed = scratch.save(weighed.withColumn("score", F.col("weight") + draw_noise(F.col("doc_id"), seed)), "weights")
    scratch.drop("positions")
    able = weighed.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("row")]
    ranked = running_sums(scratch, able, order, F.lit(1).cast("long"), "ranked").withColumn("rank", F.col("before") + 1).drop("before")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = weighed.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    out = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return ranked.withColumn("rank", rank).select(*out).unionByName(rest.select(*out))
