"""The folder that the driver and all executors share, for tables that are written and read again."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset and the session is local, a temporary folder, made once."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jvm_dir.get() if jvm_dir.isDefined() else None
    if not found:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is unset: on a cluster it must name a folder that all executors share")
        made = tempfile.mkdtemp(prefix="quadrille-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(made)
        found = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path there that nothing else has."""
    return f"{shared_dir(spark)}/quadrille-{label}-{uuid.uuid4().hex}"


class Written:
    """Tables of one run, under a folder of their own; a written table cuts the lineage and survives lost executors."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.root = spark, new_path(spark, label)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Delete a table that nothing will read again."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
