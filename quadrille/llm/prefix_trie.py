"""Prefix tries of conversations, by chained SHA-256 digests.

1. Turns become digests of role and text; from here on texts are not moved.
2. The digests of a conversation are chained in order: the digest of a prefix is
   that of the prefix before it and of its last turn.  One sorted stream, of a few
   dozen bytes a turn; a task holds one digest at a time, however long the
   conversation.
3. Every prefix is a row; rows are grouped by depth and digest, with map-side
   combine, to nodes.
4. Sums over subtrees: the nodes of which a conversation is the smallest member lie
   at the end of its path, one below the other.  Such a chain is taken to all
   nodes above it, and to its own, as one row each: as many rows as prefixes, not
   as pairs of nodes.  These rows are grouped by depth and digest again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille.llm._store import Scratch

ROOT = hashlib.sha256(b"").digest()
#: Characters of joined ids that are handed on at once.
PIECE = 1 << 16

PREFIX = "conv_id bigint, depth bigint, digest binary, parent binary, turn binary, bytes bigint, before bigint, last boolean"


class Trie(NamedTuple):
    #: digest, depth, parent (a digest; null for the root), turn (digest of the last turn), bytes (of its text),
    #: conv_id (the smallest member), parent_conv_id, n_convs, n_children, n_leaves, saved.
    nodes: DataFrame
    #: digest, conv_id: the node at which each conversation ends.
    ends: DataFrame


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of a role and a text, as 32 bytes; null counts as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, bytes): digests of the turns, numbered from 1 by ``turn``, null first.

    Turns of one number are in the order of their digests, so that repeated rows
    are turns of their own.  Rows with a null conv_id are left out.  Columns other
    than conv_id, turn, role and text are not read.
    """
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", F.col("turn").alias("n"), turn_digest(F.col("role"), F.col("text")).alias("turn"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("n").asc_nulls_first(), "turn")
    return turns.select("conv_id", F.row_number().over(order).cast("long").alias("pos"), "turn", "bytes")


def shared_starts(turns: DataFrame, group: int = 5, longest: int = 8) -> DataFrame:
    """(conv_id, pos, turn, bytes) of rebuilt conversations, with a row of pos 0 for each.

    Conversation c begins with the first h turns of conversation c - c % group (all
    if it has fewer, none if it is absent) and goes on with its own turns after the
    first h; h is the unsigned crc32 of its decimal id modulo ``longest`` + 1.
    A conversation gives turns to 2 * group - 1 others at most, ``longest`` to each.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    ids = turns.select("conv_id").distinct()
    given = turns.where(F.col("pos") <= longest).select(F.col("conv_id").alias("from"), "pos", "turn", "bytes")
    starts = ids.withColumn("from", F.col("conv_id") - F.col("conv_id") % group).join(given, "from").where(F.col("pos") <= taken)
    root = ids.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("long").alias("bytes"))
    own = turns.where(F.col("pos") > taken)
    return root.unionByName(starts.select(*root.columns)).unionByName(own.select(*root.columns))


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by conv_id and pos -> a row for each prefix.  A row waits for the next one, which tells whether it is the last."""
    names = [f.split()[0] for f in PREFIX.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()]
    waiting, digest, before = None, b"", 0
    for batch in batches:
        out: list[tuple] = []
        for conv, turn, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "bytes")), strict=True):
            if waiting is not None:
                out.append((*waiting, waiting[0] != conv))
            if waiting is None or waiting[0] != conv:
                digest, parent, before, depth = ROOT, None, 0, 0
            else:
                parent, before, depth = digest, before + waiting[5], depth + 1
                digest = hashlib.sha256(parent + turn).digest()
            waiting = (conv, depth, digest, parent, turn, size, before)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
    if waiting is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip((*waiting, True), kinds, strict=True)], names=names)


def build_trie(rows: DataFrame) -> Trie:
    """The trie of (conv_id, pos, turn, bytes); each conversation has one row of pos 0, the root, without a turn.

    ``saved`` sums, over a node's subtree with itself, the members but one times the
    bytes of the last turn's text: what need not be computed twice.  ``n_leaves``
    counts the childless nodes there.  Without conversations there is no node, not
    even the root.
    """
    scratch = Scratch(rows.sparkSession, "trie")
    prefixes = scratch.save(rows.repartition("conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_chain, PREFIX), "prefixes")
    # All that follows from the digest is a grouping column: buffers of numbers alone can be hashed.
    members = [F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")]
    nodes = scratch.save(prefixes.groupBy("depth", "digest", "parent", "turn", "bytes", "before").agg(*members), "members")
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("digest")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("digest").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(children, "digest", "left").join(above, "parent", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    nodes = scratch.save(nodes, "nodes")
    # Bytes above the first node that is a conversation's own; a copy has none of its own.
    chains = nodes.groupBy("conv_id").agg(F.min("before").alias("shared"), F.max((F.col("n_children") == 0).cast("int")).alias("leaf"))
    whole = prefixes.where("last").select("conv_id", (F.col("before") + F.col("bytes")).alias("total")).join(chains, "conv_id", "left")
    chains = whole.select("conv_id", F.coalesce("shared", "total").alias("shared"), F.coalesce("leaf", F.lit(0)).alias("leaf"))
    upward = prefixes.select("conv_id", "depth", "digest", "before").join(chains, "conv_id")
    sums = upward.groupBy("depth", "digest").agg(
        F.sum("leaf").cast("long").alias("n_leaves"), F.sum(F.greatest(F.col("shared") - F.col("before"), F.lit(0).cast("long"))).alias("saved")
    )
    return Trie(nodes.join(sums, ["depth", "digest"]).drop("before"), prefixes.where("last").select("digest", "conv_id"))


def with_texts(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` with role and text of their last turns; null for the root."""
    said = conversations.select(turn_digest(F.col("role"), F.col("text")).alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return nodes.join(said.dropDuplicates(["turn"]), "turn", "left")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by digest and conv_id -> joined ids of one node, PIECE characters or so at a time."""
    node, first, ids, size = None, None, [], 0

    def piece() -> tuple:
        return (node, first, ",".join(ids))

    for batch in batches:
        out = []
        for digest, conv in zip(batch.column("digest").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if node is not None and (digest != node or size >= PIECE):
                out.append(piece())
                ids, size = [], 0
            if not ids:
                node, first = digest, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(("digest", "first", "ids"), o, strict=True)) for o in out], _PIECES)
    if ids:
        yield pa.RecordBatch.from_pylist([dict(zip(("digest", "first", "ids"), piece(), strict=True))], _PIECES)


_PIECES = pa.schema([("digest", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
_HASHES = pa.schema([("digest", pa.binary()), ("ends_sha256", pa.string())])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces by digest and first id -> the hash of all pieces of a node, joined."""
    node, state = None, None
    for batch in batches:
        out = []
        for digest, ids in zip(batch.column("digest").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if digest != node:
                if node is not None:
                    out.append({"digest": node, "ends_sha256": state.hexdigest()})
                node, state = digest, hashlib.sha256(ids.encode())
            else:
                state.update(f",{ids}".encode())
        if out:
            yield pa.RecordBatch.from_pylist(out, _HASHES)
    if node is not None:
        yield pa.RecordBatch.from_pylist([{"digest": node, "ends_sha256": state.hexdigest()}], _HASHES)


def end_hashes(ends: DataFrame) -> DataFrame:
    """(digest, ends_sha256): SHA-256 of the ids that end at a node, ascending and joined by commas.

    The ids of a node may be a large share of all.  They are joined where they
    lie, in ranges that may cut a node, and one task hashes the joined pieces of a
    node one after the other, holding one.
    """
    pieces = ends.repartitionByRange("digest", "conv_id").sortWithinPartitions("digest", "conv_id").mapInArrow(_pieces, "digest binary, first bigint, ids string")
    return pieces.repartition("digest").sortWithinPartitions("digest", "first").mapInArrow(_hashed, "digest binary, ends_sha256 string")
