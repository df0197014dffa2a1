"""Session settings for tests and the bench; library code never builds one.

On a cluster the session comes from the caller. The settings below are the
ones that matter at scale: adaptive execution (runtime partition coalescing,
skew-join splitting, shuffle-join to broadcast-join demotion when a side turns
out small), ANSI arithmetic, UTC session clock, and no web UI.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    cpus: int | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str = "8g",
    app: str = "martlet",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or cpus)
    conf["spark.driver.memory"] = driver_memory
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: the cluster's ``spark.checkpoint.dir``.

    A local session without the setting (tests) gets a scratch folder. On a
    cluster its absence is an error: checkpoints on one machine's disk are
    lost to the others.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by driver and executors")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="martlet-ckpt-"))
    return sc.getCheckpointDir()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path on the storage of ``checkpoint_dir``, for a written intermediate."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
