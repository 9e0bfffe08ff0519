"""Exact duplicates with a heavy-hitter split, in DataFrame functions only.

1. Each row gets the SHA-256 of its normalised text; ids, digests and a number
   for every row are written once, texts are not moved.
2. A Misra-Gries sketch (Spark's ``approx_top_k``, which merges per-task
   frequent-item sketches) proposes frequent digests.
3. The proposals are verified: their exact sizes and smallest ids come from
   one aggregation with map-side combine.  These winners number at most
   ``heavy_k``, so their broadcast has a fixed bound.
4. Rows of verified digests are resolved map-side against the broadcast.
5. The other digests are aggregated, again with map-side combine, and joined
   back to their rows.  A group that the sketch missed, or one past the
   ``heavy_k``-th, is one row per task in the aggregation, and the join splits
   it if it is large; no task ever holds a whole group.

The split decides only where a row is resolved, never its result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm._marks import marks, with_mark
from quadrille.llm._store import Scratch, plainly_named

SPACES = r"[\x20\x09-\x0D]+"


def text_digest(text: F.Column) -> F.Column:
    """Lowercase hex SHA-256 of the text with every run of spaces as one space."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "), 256)


def mark_exact_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    heavy_k: int = 256,
    heavy_min: int = 64,
    tracked: int = 8192,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the smallest id is kept.  Null text counts as
    empty.  Null ids sort last; a group of only null ids has a null ``keep_id``
    and still keeps one row.  Of rows repeated with one id and one text exactly
    one is kept.  Texts of any length are compared whole.  Other columns of ``docs`` are neither read nor returned.  An
    empty table gives an empty result.

    ``heavy_k``, ``heavy_min`` and ``tracked`` set which groups take the
    map-side way; they change the plan's cost and not its rows.
    """
    return _marked(docs, id_col, text_col, heavy_k, heavy_min, tracked)[0].select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _marked(docs: DataFrame, id_col: str, text_col: str, heavy_k: int, heavy_min: int, tracked: int) -> tuple[DataFrame, DataFrame, Scratch]:
    """(rows with sha, keep_id, group_size, kept; verified winners; where they are written)."""
    scratch = Scratch(docs.sparkSession, "exact")
    rows = scratch.save(
        docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("sha"), F.monotonically_increasing_id().alias("row")),
        "digests",
    )
    proposed = (
        rows.agg(F.expr(f"approx_top_k(sha, {heavy_k}, {tracked})").alias("top"))
        .select(F.explode("top").alias("t"))
        .where(F.col("t.count") >= heavy_min)
        .select(F.col("t.item").alias("sha"))
    )
    # Of rows that carry the smallest id the one with the smallest row number wins.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    size_of = [F.count("*").alias("group_size"), first.alias("first")]
    winners = rows.join(F.broadcast(proposed), "sha").groupBy("sha").agg(*size_of)
    winners = scratch.save(winners.coalesce(1), "winners")
    light = rows.join(F.broadcast(winners.select("sha")), "sha", "left_anti")
    found = rows.join(F.broadcast(winners), "sha").unionByName(light.join(light.groupBy("sha").agg(*size_of), "sha"))
    marked = found.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
    return marked, winners, scratch


def drop_exact_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    heavy_k: int = 256,
    heavy_min: int = 64,
    tracked: int = 8192,
) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns of ``docs``.

    Same rules as :func:`mark_exact_duplicates`: null texts count as empty, null
    ids sort last, and rows equal in id and text leave exactly one row, whatever
    their other columns hold, and whatever their names.  Texts of any length are
    compared whole.

    Rows whose id no dropped row has pass without a shuffle, by a filter of
    fixed size; the losers of verified frequent digests go map-side; what is
    left meets the dropped pairs of id and digest in a join.
    """
    names = docs.columns
    id_col, text_col, docs = f"c{names.index(id_col)}", f"c{names.index(text_col)}", plainly_named(docs)
    marked, winners, scratch = _marked(docs, id_col, text_col, heavy_k, heavy_min, tracked)
    key = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    lost = marked.where("not kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__lost"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("__again")
    )
    lost = scratch.save(lost, "lost")
    own = [F.col(c) for c in docs.columns]
    flagged = with_mark(docs, key(f"`{id_col}`"), marks(lost, key("__id")), "__maybe")
    sure = flagged.where("not __maybe").select(*own)
    rest = flagged.where("__maybe").withColumn("__digest", text_digest(F.col(f"`{text_col}`")))
    best = winners.select(F.col("sha").alias("__won"), F.col("first.doc_id").alias("__best"))
    rest = rest.join(F.broadcast(best), F.col("__digest") == F.col("__won"), "left")
    rest = rest.where(F.col("__won").isNull() | F.col(f"`{id_col}`").eqNullSafe(F.col("__best")))
    # A lost pair may be the kept row's own, where that is repeated: then one of its rows stays.
    pair = lambda digest, of: F.concat_ws(":", F.col(digest), F.col(of).cast("string"))
    pairs = lost.join(F.broadcast(best), (F.col("__lost") == F.col("__won")) & ~F.col("__again"), "left_anti")
    pairs = pairs.select(pair("__lost", "__id").alias("__pair"), "__again").distinct()
    rest = rest.withColumn("__own", pair("__digest", f"`{id_col}`")).join(pairs, F.col("__own") == F.col("__pair"), "left")
    nth = F.row_number().over(Window.partitionBy("__own").orderBy("__own"))
    rest = rest.withColumn("__nth", nth).where(F.col("__again").isNull() | (F.col("__again") & (F.col("__nth") == 1)))
    return sure.unionByName(rest.select(*own)).toDF(*names)
