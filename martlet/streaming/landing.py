"""Run the staged incremental load on raw files as they land.

A file stream over a folder of raw order-item Parquet files takes what has
landed (``Trigger.AvailableNow``) and hands each micro-batch to a run:

* the batch is first kept, under its number, in a raw table partitioned by
  update day;
* the run stages the window ``[cutoff, target)`` of that whole table, so rows
  held back by an earlier target are taken when the target has passed them,
  and besides every row of the batch that lies under the cutoff, so a late
  file, or one delivered out of order, is never lost;
* batch ``n`` reads state ``n - 1`` and writes state ``n``. A batch that is
  replayed after a failure writes its raw rows and its state again.

How many files a batch takes changes the number of runs, not the rows loaded.
Rows without an update date are kept in the raw table and never staged.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from martlet.operators.merge import now_los_angeles
from martlet.operators.staging import INITIAL_LOAD, TimestampLike
from martlet.plans.incremental import RunReport, run_incremental
from martlet.schemas import RAW_ORDER_ITEMS
from martlet.sources.landing import LANDED, write_landing


def state_path(store: str, batch_id: int) -> str:
    return f"{store.rstrip('/')}/state={batch_id}"


def _remove(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def start_landing_stream(
    spark: SparkSession,
    landing_dir: str,
    store: str,
    src: str,
    tgt: str,
    checkpoint: str,
    target_cutoff: TimestampLike | None = None,
    clock=None,
    initial_load: TimestampLike = INITIAL_LOAD,
    max_files_per_trigger: int | None = None,
    reports: list[RunReport] | None = None,
) -> StreamingQuery:
    """Start the stream; call ``awaitTermination()`` on the result.

    ``store`` and ``checkpoint`` are folders on shared storage that stay the
    same over restarts. ``target_cutoff`` defaults to the clock at each batch.
    Two states are kept, the newest and the one before.
    """
    raw_path = f"{store.rstrip('/')}/raw"
    kept = T.StructType([*LANDED.fields, T.StructField("batch", T.LongType())])

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        now = clock if isinstance(clock, dt.datetime) else (clock or now_los_angeles)()
        write_landing(batch, f"{raw_path}/batch={batch_id}", mode="overwrite")
        landed = spark.read.schema(kept).option("basePath", raw_path).parquet(raw_path)
        report = run_incremental(
            spark,
            state_path(store, batch_id - 1) if batch_id else None,
            state_path(store, batch_id),
            landed.where(F.col("batch") <= batch_id),
            src,
            tgt,
            now if target_cutoff is None else target_cutoff,
            clock=now,
            initial_load=initial_load,
            late=landed.where(F.col("batch") == batch_id),
        )
        _remove(spark, state_path(store, batch_id - 2))
        if reports is not None:
            reports.append(report)

    files = spark.readStream.schema(RAW_ORDER_ITEMS)
    if max_files_per_trigger:
        files = files.option("maxFilesPerTrigger", max_files_per_trigger)
    return (
        files.parquet(landing_dir)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


__all__ = ["start_landing_stream", "state_path"]
