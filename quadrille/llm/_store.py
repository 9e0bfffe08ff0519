"""Tables written to the shared folder to cut lineage.

The folder is the session's ``spark.checkpoint.dir``.  Only when that is unset in
local mode (tests, notebooks) is a temporary folder made and set, once for the
session; elsewhere it is an error.  A written table survives the loss of
executors, and reading it again starts a new plan whose joins the adaptive
optimiser can split.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadrille.sources.shared import new_path

#: Rows that Spark hands to Python at once: texts are long, and default batches of them are large.
ARROW_ROWS = 2000


def lean(batches: Iterator) -> Iterator:
    """Arrow batches; after each the worker gives back the memory that it doesn't need any more.

    Workers live on between stages, and an executor's limit holds for them and the JVM together.
    """
    try:
        trim = ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # not glibc
        trim = None
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if trim:
            trim(0)


def in_turn(shared: list) -> Iterator:
    """Values of broadcasts, one after the other; a worker holds one of them at a time."""
    for b in shared:
        yield b.value
        if len(shared) > 1:
            # Forgotten by the worker; the executor has the bytes and unpacks them again for the next.
            vars(b).pop("_value", None)


class Scratch:
    """Tables of one run of an operator, under one folder of their own.

    Also holds the session to small Arrow batches.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, ARROW_ROWS + 1):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
        self.root = new_path(spark, label)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        """Write ``df``, in folders by the values of a column if one is given, and return the written table."""
        (df.write.partitionBy(by) if by else df.write).parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Delete a table that nothing will read again."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def plainly_named(docs: DataFrame) -> DataFrame:
    """``docs`` with columns c0, c1 and so on, which no operator uses inside."""
    return docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])


def running_sums(scratch: Scratch, rows: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """``rows`` with a column ``before``: the sum of ``value`` over all rows ahead of each in the order, which must be total.

    The rows are dealt out by ranges and written; each range is summed by
    itself, and only one total per range reaches the driver.
    """
    placed = rows.withColumn("__value", value).repartitionByRange(*order).withColumn("__range", F.spark_partition_id())
    placed = scratch.save(placed, name)
    totals = sorted((r["__range"], r["t"]) for r in placed.groupBy("__range").agg(F.sum("__value").alias("t")).collect())
    ahead, so_far = [], 0
    for at, total in totals:
        ahead.append((at, so_far))
        so_far += total
    ahead = scratch.spark.createDataFrame(ahead, "__at int, __ahead bigint")
    within = Window.partitionBy("__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("before", F.coalesce(F.sum("__value").over(within), F.lit(0)))
        .join(F.broadcast(ahead), F.col("__range") == F.col("__at"))
        .withColumn("before", F.col("before") + F.col("__ahead"))
        .drop("__value", "__range", "__at", "__ahead")
    )
