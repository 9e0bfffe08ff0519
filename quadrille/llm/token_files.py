"""Token counts of documents in flat, unindexed token files.

A file is nothing but token ids of a fixed width, little-endian, with an id that
ends each document.  Files are cut into byte ranges, which are read and searched
for that id with vector comparisons by tasks of their own.  A block yields its
whole documents at once, and the pieces at its two ends.  A prefix scan over the
numbers of end ids in the blocks, by file and offset, numbers the documents;
pieces with one number are the parts of one document, however many blocks or
files it runs through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrille.llm._bytes import NOT_SPACE, hashes, texts, words
from quadrille.llm._store import Scratch, lean, running_sums

_PIECES = "path string, block bigint, piece bigint, start bigint, n bigint, closed boolean, last boolean, head array<bigint>"


#: Tasks that the blocks are dealt out to, if there are as many.
MOST_TASKS = 20_000


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    if "://" not in path:
        path = re.sub(r"^file:/*|^(?=/)", "file:///", path).replace("file:////", "file:///")
    return fs.FileSystem.from_uri(path)


def _read(path: str, offset: int, size: int) -> pa.Buffer:
    system, at = _opened(path)
    with system.open_input_file(at) as file:
        file.seek(offset)
        return file.read_buffer(size)


def _pieces(width: int, end_id: int, header: int):
    """Rows of (path, block, offset, size) -> the pieces of each block, in the order of its ids."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            for path, block, offset, size in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                ids = np.frombuffer(_read(path, offset, size), f"<u{width}")
                if len(ids) * width != size:
                    raise OSError(f"{path}: {size} bytes from {offset} on were announced, {len(ids) * width} came")
                ends = np.flatnonzero(ids == end_id)
                starts = np.concatenate([[0], ends + 1])
                # The last piece is what follows the last end id; it may be empty.
                n = np.append(ends, len(ids)) - starts
                take = np.minimum(n, header)
                edges = np.concatenate([[0], np.cumsum(take)])
                at = np.repeat(starts - edges[:-1], take) + np.arange(edges[-1])
                number = np.arange(len(n))
                # Ids of 64 bits come as the signed numbers of those bits.
                heads = pa.array(ids[at].astype(np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([path] * len(n), pa.string()),
                        pa.array(np.full(len(n), block)),
                        pa.array(number),
                        pa.array(starts + offset // width),
                        pa.array(n),
                        pa.array(number < len(ends)),
                        pa.array(number == len(ends)),
                        pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), heads),
                    ],
                    ["path", "block", "piece", "start", "n", "closed", "last", "head"],
                )

    return scan


def blocks_of(spark: SparkSession, folder: str, width: int, block: int) -> DataFrame:
    """(path, block, offset, size): byte ranges of at most ``block`` ids of every file; contents aren't read."""
    files = spark.read.format("binaryFile").load(folder).select("path", "length")
    wrong = F.raise_error(F.concat("path", F.lit(": "), F.col("length").cast("string"), F.lit(f" bytes are no whole number of ids of {width} bytes")))
    size = F.lit(block * width)
    ranges = files.where("length > 0").select("path", F.when(F.col("length") % width != 0, wrong.cast("bigint")).otherwise(F.col("length")).alias("length"))
    ranges = ranges.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / size))).alias("block"))
    return ranges.select("path", "block", (F.col("block") * size).alias("offset"), F.least(size, F.col("length") - F.col("block") * size).alias("size"))


def count_tokens(
    spark: SparkSession,
    folder: str,
    *,
    width: int = 2,
    end_id: int = 0,
    header: int = 0,
    one_stream: bool = False,
    block: int = 1 << 22,
) -> DataFrame:
    """One row per document: path, start, n_tokens, head.

    ``path`` and ``start`` (in ids) tell where the document begins; ``n_tokens``
    leaves its end id out; ``head`` has its first ``header`` ids.  Documents may
    be empty: two end ids in a row give one of 0 tokens.  Ids after a file's
    last end id form a document too, if there are any.  With ``one_stream`` the
    files, by path, are one sequence, and a document may run from one into the
    next.  A file whose size is no multiple of ``width`` raises an error; empty
    files hold nothing.  Files of any size are read in ranges of ``block`` ids,
    a document may span any number of them, and memory depends on ``block``
    alone.  The files are read once, before this returns.  ``folder`` is on a file system that pyarrow opens by its uri (local
    and shared folders, S3, GCS, HDFS).
    """
    scratch = Scratch(spark, "token-blocks")
    ranges = scratch.save(blocks_of(spark, folder, width, block), "ranges")
    # A given number of partitions is not merged: the rows are small, the work behind each is not.
    ranges = ranges.repartition(min(MOST_TASKS, max(1, ranges.count())), "path", "block")
    pieces = scratch.save(ranges.mapInArrow(_pieces(width, end_id, header), _PIECES), "pieces")
    # Closed pieces between two end ids of a block are whole documents; one edge at each end of a block is left.
    inner = pieces.where("closed and piece > 0").select("path", "start", F.col("n").alias("n_tokens"), "head")
    edges = pieces.where("piece = 0 or last")
    ended = pieces.groupBy("path", "block").agg(F.count_if("closed").alias("ended"))
    if one_stream:
        ended = running_sums(scratch, ended, [F.col("path"), F.col("block")], F.col("ended"), "ended")
        stream = F.lit("")
    else:
        ahead = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        ended = ended.withColumn("before", F.coalesce(F.sum("ended").over(ahead), F.lit(0)))
        stream = F.col("path")
    edges = edges.join(ended.select(F.col("path").alias("__path"), F.col("block").alias("__block"), "before"), F.expr("path = __path and block = __block"))
    part = F.struct("path", "block", "piece", "start")
    begins = F.coalesce(F.min(F.when(F.col("n") > 0, part)), F.max(part))
    stitched = edges.groupBy(stream.alias("stream"), (F.col("before") + F.col("piece")).alias("number")).agg(
        begins.alias("at"),
        F.sum("n").alias("n_tokens"),
        F.bool_or("closed").alias("closed"),
        _first_ids(header).alias("head"),
    )
    stitched = stitched.where("closed or n_tokens > 0").select("at.path", "at.start", "n_tokens", "head")
    return inner.unionByName(stitched)


def _first_ids(header: int) -> Column:
    """The first ``header`` ids of a document from its parts.

    Each part, of which there is one for every block that the document meets,
    brings ``header`` ids at most.
    """
    if not header:
        return F.first(F.array().cast("array<bigint>"))
    held = F.transform(
        F.col("head"),
        lambda x, i: F.struct(F.col("path").alias("path"), F.col("block").alias("block"), F.col("piece").alias("piece"), i.alias("i"), x.alias("x")),
    )
    return F.transform(F.slice(F.array_sort(F.flatten(F.collect_list(F.when(F.col("n") > 0, held)))), 1, header), lambda t: t["x"])


#: Ids that tell a document's id, ahead of its tokens: five times 13 of its 64 bits, plus 1; MISSING in all for none.
ID_DIGITS, ID_BITS = 5, 13
MISSING = (1 << ID_BITS) + 1
#: Word ids run from 1 to this.
WORD_IDS = 65535


def write_word_ids(docs: DataFrame, folder: str, *, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Flat files of 16-bit ids: the document's id in five digits, an id per word, and 0 at the end.

    Stands in for a tokenizer's dump: a word's id is its hash, from 1 to 65535.
    Words are runs of anything but spaces; null and empty texts have none.  Ids
    are any 64-bit integers; a null id has the digits of none.  Texts of any
    length are written whole; repeated rows are each written.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lean(batches):
            ids, missing = batch.column(0).fill_null(0).to_numpy(), batch.column(0).is_null().to_numpy(zero_copy_only=False)
            for t in texts(batch.column(1)):
                w = words(t, NOT_SPACE)
                tokens = (hashes(t.data, w.starts, w.ends) % np.uint64(WORD_IDS)).astype(np.uint16) + np.uint16(1)
                rows = len(t.offsets) - 1
                own = ids[t.first : t.first + rows].astype(np.int64).view(np.uint64)
                heads = np.empty((rows, ID_DIGITS), np.uint16)
                for k in range(ID_DIGITS):
                    heads[:, k] = (own >> np.uint64(ID_BITS * k)) % np.uint64(1 << ID_BITS) + np.uint64(1)
                heads[missing[t.first : t.first + rows]] = MISSING
                bounds = w.bounds.tolist()
                out = [heads[i].tobytes() + tokens[bounds[i] : bounds[i + 1]].tobytes() for i in range(rows)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(encode, "ids binary")
    # The text sink writes a row's bytes as they are and then the separator: here the end id.
    rows.select(F.col("ids").cast("string").alias("value")).write.option("lineSep", "\0\0").text(folder)


def told_id(head: str = "head") -> Column:
    """The document id that :func:`write_word_ids` put ahead of the tokens."""
    value = F.lit(0).cast("long")
    for k in range(ID_DIGITS):
        value = value.bitwiseOR(F.shiftleft(F.element_at(head, k + 1) - 1, ID_BITS * k))
    return F.when(F.element_at(head, 1) != MISSING, value)
