"""Table reads and written intermediates shared by the operators."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read through Spark so any store it knows works."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def set_aside(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all but the ``used`` columns under neutral names, so that none
    can clash with what an operator adds, and what selects the columns back."""
    names = [c if c in used else f"_c{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda df: df.select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Local sessions without the setting (tests) get a scratch folder; on a
    cluster a missing setting is an error, since local disks are not shared.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master != "local" and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="martlet-llm-"))
    return spark.sparkContext.getCheckpointDir()


class Scratch:
    """Written tables of one operator call: ``keep`` cuts lineage, ``drop`` frees disk."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back; a lost executor costs a reread only."""
        path = f"{self.root}/{name}"
        df.write.mode("errorifexists").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Free the shuffle files of frames that nothing holds any more.

        Spark deletes them when the driver's JVM collects those frames (every
        ``spark.cleaner.periodicGC.interval`` at the latest); this asks for it now.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, name: str) -> None:
        """Delete a table that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
