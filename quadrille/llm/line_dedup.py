"""Lines that many documents share, by levelled sorted runs of line hashes; DataFrame functions only.

1. Every line becomes a key (ends stripped, A-Z in lower case) of 128 hash bits.
   The lines of a table are written once as hashes; texts are not moved.
2. Documents come in batches.  A batch counts its keys by document, with map-side
   combine, merge-anti-joins the runs for keys that are settled already (found in
   enough documents), and adds the others as a run of its own: (key, documents),
   bucketed and sorted by key, so that later merges don't shuffle it.
3. As soon as a level has ``fanout`` runs, they are compacted into one run of the
   next level.  A key is common if its counts over all runs reach the bound.
4. The lines that have common keys come from one semi-join of hashes.  Only
   documents that have some meet their numbers in a shuffle, by a hash of the text.

A run is named after the batches that it covers.  A compaction that is interrupted
leaves either the old runs, or both; then the wider one counts.  Adding a batch
again does nothing.  So a lost executor or driver never counts a batch twice.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrille.llm._marks import marks, with_mark
from quadrille.llm._store import Scratch

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["hi", "lo"]


def line_key(line: Column) -> Column:
    """The line without spaces at its ends and with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


def _hash(value: Column) -> tuple[Column, Column]:
    """128 bits: two hashes of different seeds."""
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


class LineRuns:
    """Runs of (hi, lo, n): in how many documents of some batches a key was found.

    ``path`` is a folder that all executors share; it may hold the runs of an
    earlier session.  ``least_docs``, ``fanout`` and ``buckets`` must be the same
    in all of them.  A key that is settled in one run is not added to others.
    """

    def __init__(self, spark: SparkSession, path: str, *, least_docs: int = 10, fanout: int = 3, buckets: int | None = None) -> None:
        self.spark, self.path, self.least_docs, self.fanout = spark, path.rstrip("/"), least_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _files(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def live(self) -> list[tuple[int, int]]:
        """(first, last) batch of each run that counts, in order."""
        at, fs = self._files(self.path)
        if not fs.exists(at):
            return []
        named = [re.fullmatch(r"run-(\d+)-(\d+)", s.getPath().getName()) for s in fs.listStatus(at)]
        found = [(int(m[1]), int(m[2])) for m in named if m and fs.exists(self._files(f"{self.path}/{m[0]}/_SUCCESS")[0])]
        return sorted(r for r in found if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in found))

    def _name(self, run: tuple[int, int]) -> tuple[str, str]:
        path = f"{self.path}/run-{run[0]:08d}-{run[1]:08d}"
        return path, "quadrille_run_" + hashlib.sha256(path.encode()).hexdigest()[:24]

    def read(self, run: tuple[int, int]) -> DataFrame:
        path, name = self._name(run)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (hi BIGINT, lo BIGINT, n BIGINT) USING parquet "
            f"CLUSTERED BY (hi, lo) SORTED BY (hi, lo) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        return self.spark.table(name)

    def _write(self, rows: DataFrame, run: tuple[int, int]) -> None:
        path, name = self._name(run)
        # Dealt out by the key as buckets are, each task writes one of them.
        dealt = rows.select(*KEY, "n").repartition(self.buckets, *KEY)
        dealt.write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", path).mode("overwrite").saveAsTable(name)

    def _drop(self, run: tuple[int, int]) -> None:
        path, name = self._name(run)
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        at, fs = self._files(path)
        fs.delete(at, True)

    def _summed(self, runs: list[tuple[int, int]]) -> DataFrame:
        # As plain files: Spark 4.1 takes a union of bucketed scans for dealt out by key, but chains their partitions.
        rows = self.spark.read.schema("hi bigint, lo bigint, n bigint").parquet(*[self._name(r)[0] for r in runs])
        return rows.groupBy(*KEY).agg(F.sum("n").alias("n"))

    def add(self, keys: DataFrame, batch: int | None = None) -> int:
        """Adds a batch: (hi, lo), a row for each document and key of it.  Returns its number.

        ``batch`` is the next number if left out; a number that is there already
        is passed over.
        """
        runs = self.live()
        following = runs[-1][1] + 1 if runs else 0
        batch = following if batch is None else batch
        if batch < following:
            return batch
        if batch > following:
            raise ValueError(f"batch {following} comes before batch {batch}")
        counts = keys.groupBy(*KEY).agg(F.count("*").alias("n"))
        for run in runs:
            counts = counts.join(self.read(run).where(F.col("n") >= self.least_docs).select(*KEY), KEY, "left_anti")
        self._write(counts, (batch, batch))
        self._compact()
        return batch

    def _compact(self) -> None:
        while True:
            runs = self.live()
            ends, width = runs[-self.fanout :], lambda r: r[1] - r[0]
            if len(ends) < self.fanout or len({width(r) for r in ends}) > 1:
                return
            self._write(self._summed(ends), (ends[0][0], ends[-1][1]))
            for run in ends:
                self._drop(run)

    def common(self) -> DataFrame:
        """(hi, lo) of the keys that are found in ``least_docs`` documents of all batches or more."""
        runs = self.live()
        if not runs:
            return self.spark.createDataFrame([], "hi bigint, lo bigint")
        return self._summed(runs).where(F.col("n") >= self.least_docs).select(*KEY)

    def close(self, delete: bool = False) -> None:
        """Forgets the tables of this session; with ``delete`` their files too."""
        for run in self.live():
            if delete:
                self._drop(run)
            else:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._name(run)[1]}")


def _line_hashes(texts: DataFrame, least_length: int, batches: int) -> DataFrame:
    """(batch, text_hi, text_lo, hi, lo, pos, first) of (text): a row for each line whose key is long enough.

    ``first`` marks one line of each key of a document.  Hashes are sorted
    within the document, so its cost is that of sorting its own lines.
    """
    split = texts.select("text", F.transform(F.split("text", "\n", -1), line_key).alias("keys"))

    def hashed(k: Column, i: Column) -> Column:
        hi, lo = _hash(k)
        return F.when(F.char_length(k) >= least_length, F.struct(hi.alias("hi"), lo.alias("lo"), (i + 1).alias("pos")))

    hi, lo = _hash(F.col("text"))
    hashes = split.select(hi.alias("text_hi"), lo.alias("text_lo"), F.array_sort(F.filter(F.transform("keys", hashed), lambda x: x.isNotNull())).alias("lines"))

    def marked(x: Column, i: Column) -> Column:
        before = F.get("lines", i - 1)
        first = (i == 0) | (before["hi"] != x["hi"]) | (before["lo"] != x["lo"])
        return F.struct(x["hi"].alias("hi"), x["lo"].alias("lo"), x["pos"].alias("pos"), first.alias("first"))

    batch = F.pmod(F.monotonically_increasing_id(), F.lit(batches)).cast("int")
    lines = hashes.withColumn("batch", batch).select("batch", "text_hi", "text_lo", F.transform("lines", marked).alias("lines"))
    return lines.select("batch", "text_hi", "text_lo", F.inline("lines"))


def _cleaned(rows: DataFrame, least_docs: int, least_length: int, batches: int, fanout: int, runs: LineRuns | None) -> DataFrame:
    """(row, text) -> (row, n_lines, n_dropped, kept)."""
    scratch = Scratch(rows.sparkSession, "lines")
    lines = scratch.save(_line_hashes(rows.select("text"), least_length, 1 if runs else batches), "lines", by="batch")
    own = runs or LineRuns(rows.sparkSession, scratch.path("runs"), least_docs=least_docs, fanout=fanout)
    for batch in range(1 if runs else batches):
        own.add(lines.where((F.col("batch") == batch) & F.col("first")).select(*KEY))
    common = scratch.save(own.common(), "common")
    own.close(delete=runs is None)
    # Equal texts lose equal lines, so that one list of line numbers does for all copies.
    hits = lines.join(common, KEY, "left_semi").groupBy("text_hi", "text_lo").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    hits = scratch.save(hits, "hits")
    scratch.drop("lines")
    hi, lo = _hash(F.col("text"))
    flagged = with_mark(rows.withColumn("hi", hi).withColumn("lo", lo), F.col("hi"), marks(hits, F.col("text_hi")), "maybe")
    met = flagged.where("maybe").join(hits, (F.col("hi") == F.col("text_hi")) & (F.col("lo") == F.col("text_lo")), "left").select("row", "text", "gone")
    whole = flagged.where("not maybe").select("row", "text").unionByName(met.where("gone IS NULL").select("row", "text"))
    feeds = F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit("")))
    whole = whole.select("row", (feeds + 1).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.col("text").alias("kept"))
    cut = met.where("gone IS NOT NULL").select("row", F.split("text", "\n", -1).alias("lines"), "gone")
    # What stays lies between the lines that go.
    before = lambda i: F.when(i == 0, 0).otherwise(F.get("gone", i - 1))
    between = F.transform("gone", lambda to, i: F.slice("lines", before(i) + 1, to - before(i) - 1))
    last = F.slice("lines", F.element_at("gone", -1) + 1, F.size("lines"))
    cut = cut.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.array_join(F.concat(F.flatten(between), last), "\n").alias("kept"),
    )
    return whole.unionByName(cut)


def mark_common_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    least_docs: int = 10,
    least_length: int = 1,
    batches: int = 4,
    fanout: int = 3,
    runs: LineRuns | None = None,
) -> DataFrame:
    """One row per input row: doc_id, n_lines (before), n_dropped, kept (the text that is left).

    A line's key is the line with spaces stripped at both ends and A-Z in lower
    case.  Keys of ``least_length`` code points or more that are found in
    ``least_docs`` documents or more lose all their lines, in every document;
    shorter keys never do.  What stays is joined by line feeds; if nothing
    stays, ``kept`` is empty, as it is for a text that is one empty line.  Every
    row is a document, also one repeated with its id; repeats within a document
    count once.  Null text is one empty line; null ids are ids like others.
    Texts of any length are read whole.  Other columns are neither read nor
    returned.  An empty table gives an empty result.

    The table is dealt into ``batches``.  With ``runs`` it is one batch that is
    added to the runs of earlier ones: their counts and bound then decide, and
    documents of earlier batches are not cleaned again.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("row"), text.alias("text"))
    return _cleaned(rows, least_docs, least_length, batches, fanout, runs).withColumnRenamed("row", "doc_id")


def drop_common_lines(docs: DataFrame, *, text_col: str = "text", **settings) -> DataFrame:
    """``docs`` with all their columns, whatever their names, and their texts without the lines that are common.

    Rules and settings are those of :func:`mark_common_lines`.  Every row stays;
    a null text becomes empty.
    """
    given = {"least_docs": 10, "least_length": 1, "batches": 4, "fanout": 3, "runs": None} | settings
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return _cleaned(whole, **given).select("row.*", F.col("kept").alias(text_col)).select(*[f"`{c}`" for c in docs.columns])
