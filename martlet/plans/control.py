"""Control-table operations: cutoff registration, run lineage, reset.

These tables hold one row per source/target pair or per run, so each change
is a small DataFrame transformation; the store writes the result as a new
version (see ``warehouse``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.operators.staging import TimestampLike, ts
from martlet.schemas import ETL_CUTOFF


def init_cutoff(cutoffs: DataFrame, src_table: str, tgt_table: str) -> DataFrame:
    """Register a pair with a NULL cutoff (P12); an existing pair is left as is."""
    spark = cutoffs.sparkSession
    new = spark.createDataFrame([(src_table, tgt_table, None)], ETL_CUTOFF)
    return cutoffs.unionByName(new.join(cutoffs, ["src_table_name", "tgt_table_name"], "left_anti"))


def reset_cutoff(cutoffs: DataFrame, src_table: str) -> DataFrame:
    """UPDATE ... SET cutoff_time = NULL WHERE src_table_name = src (reset step)."""
    return cutoffs.withColumn(
        "cutoff_time", F.when(F.col("src_table_name") == src_table, ts(None)).otherwise(F.col("cutoff_time"))
    )


def new_lineage_key() -> str:
    """GENERATE_UUID(), drawn once on the driver so a recomputed plan keeps it."""
    return str(uuid.uuid4())


def open_run(
    lineage: DataFrame,
    lineage_key: str,
    src_table: str,
    tgt_table: str,
    cutoff: TimestampLike,
    clock: TimestampLike,
) -> DataFrame:
    """Append the open audit row: completed NULL, was_successful false (P7)."""
    spark = lineage.sparkSession
    row = spark.range(1).select(
        F.lit(lineage_key).alias("lineage_key"),
        ts(clock).alias("data_load_started"),
        F.lit(src_table).alias("src_table_name"),
        F.lit(tgt_table).alias("tgt_table_name"),
        ts(None).alias("data_load_completed"),
        F.lit(False).alias("was_successful"),
        ts(cutoff).alias("source_sys_cutoff_time"),
    )
    return lineage.unionByName(row)


def close_run(lineage: DataFrame, lineage_key: str, clock: TimestampLike) -> DataFrame:
    """Mark one run completed and successful (P10)."""
    hit = F.col("lineage_key") == lineage_key
    return lineage.withColumns(
        {
            "data_load_completed": F.when(hit, ts(clock)).otherwise(F.col("data_load_completed")),
            "was_successful": F.when(hit, F.lit(True)).otherwise(F.col("was_successful")),
        }
    )


def open_runs(lineage: DataFrame, src_table: str) -> DataFrame:
    """Runs of a source still open (data_load_completed IS NULL)."""
    return lineage.where((F.col("src_table_name") == src_table) & F.col("data_load_completed").isNull())


def newest_open_run_key(lineage: DataFrame, src_table: str) -> str | None:
    """The reference's lookup: the highest key among open runs of ``src_table``.

    Keys are random UUIDs, so "highest" is not "latest"; ``run_incremental``
    carries its own key instead and this exists for audit parity.
    """
    row = open_runs(lineage, src_table).agg(F.max("lineage_key").alias("k")).first()
    return row["k"] if row else None
