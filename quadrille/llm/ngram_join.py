"""Grouped prefix join on the Jaccard similarity of word-shingle sets.

A global order of the shingles (the commonest last, else by hash) gives each
document a prefix that any linked document must meet.  Then

1. documents with equal sets form classes, and classes with identical prefixes
   and sizes form groups; only groups have postings;
2. the postings of each shingle are read in one sorted stream (those of common
   shingles, which may be any number, are aggregated and joined instead), and
   each group is tied to the shingle's pivot, the group in which it comes earliest;
3. those pairs, and the classes of a group against its first, are verified on
   whole sets: the links that hold large groups of copies together cost one
   pair per copy and shingle;
4. the exact rest: pairs of groups that share a prefix shingle and a bucket of
   sizes (or neighbouring ones), pass the size and position bounds and aren't yet in one component are expanded to their
   classes and verified.

Components of the links of 3 and 4 are those of all links: a pair left out is
either below the threshold or joins what is joined already.

Only the order depends on the sketch of common shingles, which has a fixed
greatest size; a poorer sketch makes the join slower and its rows no different.
Sets are compared as 64-bit hashes of shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm._bytes import NOT_SPACE, chain, digest, hashes, texts, words
from quadrille.llm._components import connected_components
from quadrille.llm._marks import marks, with_mark
from quadrille.llm._store import Scratch, lean, plainly_named

#: Link when 100 * intersection >= 75 * union, that is 7 * intersection >= 3 * (sum of sizes).
LEAST = (75, 100)

#: Shingles that the order puts last, and how many of them one task proposes.
COMMON, COMMON_PER_TASK, COMMON_MIN = 1 << 18, 1 << 14, 8
_FLUSH = 1 << 20


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sorted distinct shingle hashes of the rows from there on)."""
    for t in texts(column):
        w = words(t, NOT_SPACE)
        h = hashes(t.data, w.starts, w.ends)
        every = chain(h, size)
        out = []
        for a, b in zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True):
            out.append(np.unique(every[a : b - size + 1] if b - a >= size else chain(h[a:b], max(1, b - a))))
        yield t.first, out


def _common(size: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, counts, waiting, n = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def merge(most: int) -> None:
            nonlocal tokens, counts, waiting, n
            new, new_counts = np.unique(np.concatenate(waiting), return_counts=True) if waiting else (tokens[:0], counts[:0])
            both, place = np.unique(np.concatenate([tokens, new]), return_inverse=True)
            total = np.bincount(place, np.concatenate([counts, new_counts]), len(both)).astype(np.int64)
            top = np.flatnonzero(total > 1)
            if len(top) > most:
                top = top[np.argpartition(-total[top], most)[:most]]
            tokens, counts, waiting, n = both[top], total[top], [], 0

        for batch in lean(batches):
            for _, sets in shingle_sets(batch.column(0), size):
                waiting += sets
                n += sum(map(len, sets))
                if n >= _FLUSH:
                    merge(4 * COMMON_PER_TASK)
        merge(COMMON_PER_TASK)
        yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(counts)], ["token", "n"])

    return count


def common_shingles(docs: DataFrame, size: int) -> np.ndarray:
    """Hashes of the commonest shingles, sorted; at most COMMON of them."""
    found = (
        docs.select("text")
        .mapInArrow(_common(size), "token bigint, n bigint")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= COMMON_MIN)
        .orderBy(F.desc("n"), "token")
        .limit(COMMON)
        .select("token")
        .toArrow()
    )
    return np.sort(found.column(0).to_numpy().view(np.uint64))


class _Order:
    """The global order of shingles: those of a sorted array come last."""

    def __init__(self, last: np.ndarray) -> None:
        self.last = last
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(last >> np.uint64(42)).astype(np.int64)] = True

    def prefix(self, s: np.ndarray) -> tuple[np.ndarray, int]:
        """The prefix of a set, and how many of it aren't common."""
        size = len(s) - -(-LEAST[0] * len(s) // LEAST[1]) + 1
        late = self.maybe[(s >> np.uint64(42)).astype(np.int64)]
        some = np.flatnonzero(late)
        if len(some):
            at = np.minimum(np.searchsorted(self.last, s[some]), len(self.last) - 1)
            late[some] = self.last[at] == s[some]
            s = np.concatenate([s[~late], s[late]])
        return s[:size], min(size, len(late) - int(late.sum()))


_SETS = "doc_id bigint, n bigint, d1 bigint, d2 bigint, p1 bigint, p2 bigint, own bigint, prefix array<bigint>"


def _describe(size: int, shared):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = _Order(shared.value)
        for batch in lean(batches):
            for first, sets in shingle_sets(batch.column(1), size):
                heads, own = zip(*[order.prefix(s) if len(s) else (s, 0) for s in sets], strict=True)
                n = np.array([len(s) for s in sets], np.int64)
                keys = np.array([digest(s) for s in sets], np.int64).reshape(-1, 2)
                groups = np.array([digest(np.append(p, np.uint64(k))) for p, k in zip(heads, n.tolist(), strict=True)], np.int64)
                groups = groups.reshape(-1, 2)
                edges = np.concatenate([[0], np.cumsum([len(p) for p in heads])]).astype(np.int32)
                tokens = np.concatenate(heads).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        pa.array(n),
                        pa.array(keys[:, 0]),
                        pa.array(keys[:, 1]),
                        pa.array(groups[:, 0]),
                        pa.array(groups[:, 1]),
                        pa.array(np.array(own, np.int64)),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(tokens)),
                    ],
                    [f.split()[0] for f in _SETS.split(", ")],
                )

    return describe


def _pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Postings sorted by (token, meta) -> those of shingles that two groups or more share, with their pivots.

    Streams: of a shingle's postings only the first is remembered.  ``meta`` is
    position * 2**32 + size; ``near`` says whether the bounds allow a link to the pivot.
    """
    first, known = None, False  # the open run's first posting; whether it has been given
    for batch in lean(batches):
        token, grp, meta = (batch.column(k).to_numpy() for k in range(3))
        if not len(token):
            continue
        carried = first is not None
        if carried:
            token, grp, meta = (np.concatenate([[x], y]) for x, y in zip(first, (token, grp, meta), strict=True))
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        sizes = np.diff(np.append(starts, len(token)))
        head = np.repeat(starts, sizes)
        give = np.repeat(sizes > 1, sizes)
        if carried and known:
            give[0] = False
        known = bool(sizes[-1] > 1 or (known and carried and len(starts) == 1))
        first = (token[starts[-1]], grp[starts[-1]], meta[starts[-1]])
        rows = np.flatnonzero(give)
        n, pos = meta & 0xFFFFFFFF, meta >> 32
        near = 7 * np.minimum(n - pos, (n - pos)[head]) >= 3 * (n + n[head])
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[rows]) for x in (token, grp, n, pos, grp[head], near)], ["token", "grp", "n", "pos", "pivot", "near"]
        )


def _verify(size: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            left = [s for _, sets in shingle_sets(batch.column(2), size) for s in sets]
            right = [s for _, sets in shingle_sets(batch.column(3), size) for s in sets]
            met = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right, strict=True)], np.int64)
            total = np.array([len(x) + len(y) for x, y in zip(left, right, strict=True)], np.int64) - met
            ok = pa.array((LEAST[1] * met >= LEAST[0] * total) & (total > 0))
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(ok) for k in range(2)], ["a", "b"])

    return verify


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is in ``ids``; a filter of fixed size keeps most others out of the shuffle."""
    flagged = with_mark(docs, F.col("doc_id"), marks(ids, F.col("doc_id")), "__maybe")
    return flagged.where("__maybe").drop("__maybe").join(ids, "doc_id", "left_semi")


def link_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, class_id, component_id.

    Words are runs of anything but spaces, A-Z in lower case; a text's set holds
    its distinct shingles of ``shingle`` words, or the whole sequence if it has
    fewer.  Two texts link when their sets' Jaccard similarity is 0.75 or more.
    ``class_id`` is the smallest id of an equal set, ``component_id`` the
    smallest id reachable by links.  Texts that are null or have no words have
    size 0 and are alone.  Rows with a null id link nothing: their ids come back
    null.  Rows repeated with one id and text are one document and each get
    their row; an id that has several texts links by each of them.  Of ties the
    smallest id names the class.  Texts of any length are read whole.  Ids are integers; other columns are ignored; an empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    late = spark.sparkContext.broadcast(common_shingles(given, shingle))
    sets = scratch.save(
        given.mapInArrow(_describe(shingle, late), _SETS),
        "sets",
    )
    real = sets.where("n > 0 and doc_id is not null")
    # Sets and groups are told apart by 128 bits of their digests.  A group's name is one
    # half of them, or where groups share that a hash of both; the written list of such
    # halves is all but empty and its size known to the optimiser.
    key = F.struct("p2", "n")
    clashes = scratch.save(real.groupBy("p1").agg((F.min(key) != F.max(key)).alias("c")).where("c").select(F.col("p1").alias("__p1")), "clashes")
    real = real.join(clashes, F.col("p1") == F.col("__p1"), "left")
    real = real.withColumn("grp", F.when(F.col("__p1").isNull(), F.col("p1")).otherwise(F.xxhash64("p1", "p2", "n")))
    classes = scratch.save(real.groupBy("d1", "d2", "n", "grp").agg(F.min("doc_id").alias("cls")), "classes")

    # Postings of groups, and what pairs they propose.
    groups = real.groupBy("grp", "n").agg(F.any_value(F.struct("own", "prefix")).alias("of"))
    postings = groups.select("grp", "n", F.col("of.own").alias("own"), F.posexplode("of.prefix").alias("pos", "token"))
    postings = postings.select("token", "grp", F.expr("shiftleft(cast(pos as bigint), 32) | n").alias("meta"), (F.col("pos") >= F.col("own")).alias("common"))
    rare = (
        postings.where("not common").drop("common").repartition("token")
        .sortWithinPartitions("token", "meta", "grp")
        .mapInArrow(_pivots, "token bigint, grp bigint, n bigint, pos bigint, pivot bigint, near boolean")
    )
    # A common shingle's postings may be any number: its pivot comes from an aggregation,
    # which has a row per task, and the join back to them is one that can be split.
    common = postings.where("common").drop("common")
    pivots = common.groupBy("token").agg(F.min(F.struct("meta", "grp")).alias("p"), F.min("grp").alias("lo"), F.max("grp").alias("hi"))
    # Written, so that the join's two sides are dealt out for it alone and can be split.
    pivots = scratch.save(pivots.where("lo <> hi").select("token", F.col("p.grp").alias("pivot"), F.col("p.meta").alias("pm")), "pivots")
    low, high = "({0} & 4294967295)", "({0} >> 32)"
    near = f"7 * least({low.format('meta')} - {high.format('meta')}, {low.format('pm')} - {high.format('pm')}) >= 3 * ({low.format('meta')} + {low.format('pm')})"
    common = common.join(pivots, "token").select(
        "token", "grp", F.expr(low.format("meta")).alias("n"), F.expr(high.format("meta")).alias("pos"), "pivot", F.expr(near).alias("near")
    )
    shared = scratch.save(rare, "shared").unionByName(scratch.save(common, "shared-common"))
    firsts = classes.groupBy("grp").agg(F.min("cls").alias("head"), F.count("*").alias("width"))
    heads = scratch.save(firsts, "heads")
    star = (
        shared.where("near and grp <> pivot")
        .select("grp", "pivot")
        .distinct()
        .join(heads.select("grp", F.col("head").alias("x")), "grp")
        .join(heads.select(F.col("grp").alias("pivot"), F.col("head").alias("y")), "pivot")
        .select("x", "y")
    )
    inner = (
        heads.where("width > 1").join(classes, "grp").where("cls <> head").select(F.col("cls").alias("x"), F.col("head").alias("y"))
    )
    pairs = scratch.save(
        star.unionByName(inner).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "pairs"
    )

    members = classes.join(shared.select("grp").unionByName(heads.where("width > 1").select("grp")).distinct(), "grp", "left_semi")
    members = scratch.save(members.select("cls", "grp"), "members")

    def verified(candidates: DataFrame, name: str) -> DataFrame:
        ends = candidates.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        wanted = scratch.save(_texts_of(given, scratch.save(ends, f"{name}-ids")), f"{name}-texts")
        left = wanted.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        right = wanted.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
        both = candidates.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
        found = scratch.save(both.mapInArrow(_verify(shingle), "a bigint, b bigint").distinct(), name)
        # Copies of texts don't outlive their use.
        scratch.drop(f"{name}-texts")
        return found

    links = verified(pairs, "links")
    found = scratch.save(connected_components(links, scratch, "cc"), "components")

    # What the stars leave open.
    of_class = members.join(found.withColumnRenamed("node", "cls"), "cls", "left").select(
        "cls", "grp", F.coalesce("component", "cls").alias("comp")
    )
    of_class = scratch.save(of_class, "of-class")
    of_group = of_class.groupBy("grp").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    open_tokens = (
        shared.join(of_group, "grp")
        .groupBy("token")
        .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        .where("lo <> hi")
        .select("token")
    )
    still = scratch.save(shared.join(of_group, "grp").join(open_tokens, "token", "left_semi").drop("pivot", "near"), "open-shingles")
    beyond = F.expr("(3 * n + 3) div 4 - 1")
    own = still.groupBy("grp").agg(
        F.max("n").alias("n"),
        F.collect_list("token").alias("tokens"),
        *[F.bit_or(F.expr(f"if(token >> 6 & 3 = {k}, shiftleft(1L, cast(token & 63 as int)), 0L)")).alias(f"s{k}") for k in range(4)],
    )
    own = scratch.save(own.withColumn("beyond", beyond), "open-groups")
    order = Window.partitionBy("grp").orderBy("pos")
    still = (
        still.join(own.select("grp", F.size("tokens").alias("held"), "beyond", "s0", "s1", "s2", "s3"), "grp")
        .withColumn("nth", F.row_number().over(order) - 1)
        .withColumn("before", F.lag("token").over(order))
    )
    # Sizes of linked sets differ by a third at most, so partners are in the same bucket of sizes or the next.
    bucket = F.floor(F.log("n") / float(np.log(LEAST[1] / LEAST[0]) * (1 + 1e-9)))
    still = scratch.save(still.withColumn("bucket", bucket), "open")
    x = still.alias("x")
    y = still.withColumn("own_bucket", F.col("bucket")).withColumn("bucket", F.explode(F.array("bucket", F.col("bucket") - 1))).alias("y")
    # Two sets meet in shingles that both prefixes hold, which are open, and beyond
    # the prefix that ends first.  Each bit that one group's signature has alone is
    # at least one open shingle that the other lacks.  No link follows if a bound
    # fails at any common shingle; of neighbouring common shingles the first is
    # enough to find the pair.

    def held(a: str, b: str) -> str:
        return f"{a}.held - " + " - ".join(f"bit_count({a}.s{k} & ~{b}.s{k})" for k in range(4))

    near = (
        "x.token = y.token and x.bucket = y.bucket and (y.own_bucket > x.bucket or x.grp < y.grp) and (x.lo <> x.hi or y.lo <> y.hi or x.lo <> y.lo)"
        f" and 7 * (least({held('x', 'y')}, {held('y', 'x')}) + greatest(x.beyond, y.beyond)) >= 3 * (x.n + y.n)"
        " and 7 * (least(x.nth, y.nth) + least(x.n - x.pos, y.n - y.pos)) >= 3 * (x.n + y.n)"
        " and not coalesce(x.before = y.before, false)"
    )
    rest = x.join(y, F.expr(near)).select(F.least("x.grp", "y.grp").alias("p"), F.greatest("x.grp", "y.grp").alias("q")).distinct()
    # The same bound with the shingles that the two really share.
    p, q = (own.select(F.col("grp").alias(k), F.struct("n", "tokens", "beyond").alias(f"of_{k}")) for k in "pq")
    rest = (
        rest.join(p, "p")
        .join(q, "q")
        .where(
            "7 * (size(array_intersect(of_p.tokens, of_q.tokens)) + greatest(of_p.beyond, of_q.beyond)) >= 3 * (of_p.n + of_q.n)"
        )
        .select("p", "q")
        .unionByName(of_group.where("lo <> hi").select(F.col("grp").alias("p"), F.col("grp").alias("q")))
    )
    one = of_class.select(F.col("grp").alias("p"), F.col("cls").alias("x"), F.col("comp").alias("cx"))
    two = of_class.select(F.col("grp").alias("q"), F.col("cls").alias("y"), F.col("comp").alias("cy"))
    rest = (
        rest.join(one, "p")
        .join(two, "q")
        .where("cx <> cy")
        .select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
        .distinct()
        .join(pairs, ["a", "b"], "left_anti")
    )
    more = verified(scratch.save(rest, "rest"), "more-links")
    if more.limit(1).count():
        found = scratch.save(connected_components(links.unionByName(more), scratch, "cc-all"), "components-all")

    named = classes.join(found.withColumnRenamed("node", "cls"), "cls", "left").select(
        "d1", "d2", "n", "cls", F.coalesce("component", "cls").alias("component_id")
    )
    named = scratch.save(named, "named")
    alone = F.col("n") == 0
    return sets.select("doc_id", "d1", "d2", "n").join(named, ["d1", "d2", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("cls")).alias("class_id"),
        F.when(alone | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with the columns of ``docs``.

    Cases as in :func:`link_components`: texts without words and rows without an
    id all stay, and so do rows repeated with the id that stays.  Other columns may
    have any names.
    """
    names = docs.columns
    id_col, text_col, docs = f"c{names.index(id_col)}", f"c{names.index(text_col)}", plainly_named(docs)
    gone = (
        link_components(docs, id_col=id_col, text_col=text_col)
        .where("component_id <> doc_id")
        .select(F.col("doc_id").alias("__gone"))
        .distinct()
    )
    gone = Scratch(docs.sparkSession, "near").save(gone, "gone")
    # Rows whose id surely isn't among them pass without a shuffle.
    flagged = with_mark(docs, F.col(f"`{id_col}`").cast("long"), marks(gone, F.col("__gone")), "__maybe")
    rest = flagged.where("__maybe").join(gone, F.col(f"`{id_col}`") == F.col("__gone"), "left_anti")
    return flagged.where("not __maybe").unionByName(rest).drop("__maybe").toDF(*names)
