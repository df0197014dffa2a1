"""The staged incremental load (P13) between two plain Parquet states.

A state is a folder with four tables: ``fact``, ``staging``, ``lineage`` and
``cutoff``. A run reads one state and writes the next into a path that the
caller chooses, in this order:

  1. lineage with the run opened (P7, the pair registered by P12);
  2. staging: the rows of the window (P8), replacing what was staged before;
  3. fact: the merge of the staged rows into the old fact (P9), by order month;
  4. lineage with the run closed (P10);
  5. cutoff, advanced (P11). With it the state is complete.

Nothing is changed in place, so a run killed at any step leaves the old state
as it was, and the same call again writes the whole new state. The fact is
rewritten as a whole: plain Parquet has no row-level update, and replacing
single month folders in place would lose rows if the run died between removing
and renaming one. A cluster with a table format would hand the same merge plan
to it instead.

Only the cutoff, the run's counts and control rows reach the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.operators.merge import Rule, now_los_angeles, plan_merge
from martlet.operators.staging import INITIAL_LOAD, TimestampLike, advance_cutoff, stage_updates, ts
from martlet.plans.control import close_run, init_cutoff, new_lineage_key, open_run, reset_cutoff
from martlet.schemas import ETL_CUTOFF, FACT_ORDER_DETAIL, LINEAGE, STAGED_ORDER_ITEMS, empty
from martlet.session import checkpoint_dir

Clock = Callable[[], dt.datetime]
MONTH = "order_month"
_LAYOUT = {
    "fact": FACT_ORDER_DETAIL,
    "staging": STAGED_ORDER_ITEMS,
    "lineage": LINEAGE,
    "cutoff": ETL_CUTOFF,
}


@dataclass(frozen=True)
class RunReport:
    lineage_key: str
    staged: int
    inserted: int
    updated: int
    unchanged: int
    cutoff_before: dt.datetime | None
    cutoff_after: dt.datetime | None


def read_table(spark: SparkSession, state: str | None, name: str) -> DataFrame:
    """A table of a state; empty when there is no state yet."""
    schema = _LAYOUT[name]
    if state is None:
        return empty(spark, schema)
    stored = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())]) if name == "fact" else schema
    return spark.read.schema(stored).parquet(f"{state.rstrip('/')}/{name}").select(*schema.fieldNames())


def is_complete(spark: SparkSession, state: str) -> bool:
    """Whether a run (or reset) has written all of ``state``; its cutoff comes last."""
    try:
        return bool(spark.read.parquet(f"{state.rstrip('/')}/cutoff").limit(1).count())
    except AnalysisException:
        return False


def _write(df: DataFrame, state: str, name: str, small: bool = False) -> None:
    out = df.coalesce(1) if small else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if name == "fact":
        month = F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit("none"))
        # Rebalancing gives a month few files, and a hot month more than one task.
        writer = (
            df.withColumn(MONTH, month).hint("rebalance", MONTH).write.mode("overwrite")
            .option("partitionOverwriteMode", "static").partitionBy(MONTH)
        )
    writer.parquet(f"{state.rstrip('/')}/{name}")


def _clock(clock: Clock | dt.datetime | None) -> Clock:
    if clock is None:
        return now_los_angeles
    return (lambda: clock) if isinstance(clock, dt.datetime) else clock


def pair_cutoff(cutoffs: DataFrame, src: str, tgt: str) -> dt.datetime | None:
    """The pair's cutoff: NULL if absent, an error if repeated."""
    rows = cutoffs.where((F.col("src_table_name") == src) & (F.col("tgt_table_name") == tgt)).limit(2).collect()
    if len(rows) > 1:
        raise ValueError(f"cutoff table holds more than one row for {src} -> {tgt}")
    return rows[0]["cutoff_time"] if rows else None


def run_incremental(
    spark: SparkSession,
    before: str | None,
    after: str,
    raw: DataFrame,
    src: str,
    tgt: str,
    target_cutoff: TimestampLike,
    clock: Clock | dt.datetime | None = None,
    initial_load: TimestampLike = INITIAL_LOAD,
    late: DataFrame | None = None,
    rule: Rule | None = None,
    move_all_targets: bool = False,
) -> RunReport:
    """One run from state ``before`` (None: nothing loaded yet) to state ``after``.

    ``late``: rows to be taken although they lie under the window, as a stream
    delivers them.
    """
    if before is not None and before.rstrip("/") == after.rstrip("/"):
        raise ValueError("a run must write a state of its own")
    now = _clock(clock)
    checkpoint_dir(spark)
    cutoffs = init_cutoff(read_table(spark, before, "cutoff"), src, tgt)
    cutoff = pair_cutoff(cutoffs, src, tgt)
    key = new_lineage_key()
    opened = open_run(read_table(spark, before, "lineage"), key, src, tgt, target_cutoff, now())
    _write(opened, after, "lineage", small=True)

    rows = stage_updates(raw, cutoff, target_cutoff, initial_load)
    if late is not None and cutoff is not None:
        # Rows older than the initial load are never taken, as in the first run's window.
        since = F.col("update_date") >= ts(initial_load)
        under = late.where(since & (F.col("update_date") < ts(cutoff)) & (F.col("update_date") < ts(target_cutoff)))
        rows = rows.unionByName(under.select(*rows.columns))
    _write(rows, after, "staging")
    staged = read_table(spark, after, "staging")

    fact = read_table(spark, before, "fact")
    plan = plan_merge(fact, staged, now(), rule)
    plan.updates = plan.updates.checkpoint()
    _write(plan.apply(fact), after, "fact")
    # Only inserts add rows, so their number follows from the row counts of the two facts; the merge is not run again for it.
    inserted = read_table(spark, after, "fact").count() - fact.count()
    counts = plan.counts(inserted).first()

    _write(close_run(opened, key, now()), after, "lineage", small=True)
    moved = advance_cutoff(cutoffs, staged, fact, src, None if move_all_targets else tgt)
    # A cutoff never falls back: late rows alone would lower it.
    hit = (F.col("src_table_name") == src) & (F.col("tgt_table_name") == tgt)
    moved = moved.withColumn(
        "cutoff_time", F.when(hit, F.greatest(F.col("cutoff_time"), ts(cutoff))).otherwise(F.col("cutoff_time"))
    )
    _write(moved, after, "cutoff", small=True)
    return RunReport(
        lineage_key=key,
        staged=counts["staged"],
        inserted=counts["inserted"],
        updated=counts["updated"],
        unchanged=counts["unchanged"],
        cutoff_before=cutoff,
        cutoff_after=pair_cutoff(read_table(spark, after, "cutoff"), src, tgt),
    )


def reset(spark: SparkSession, before: str, after: str, src: str) -> None:
    """P16: a state with no cutoff for ``src`` and empty staging, fact and lineage; raw untouched."""
    for name in ("staging", "fact", "lineage"):
        _write(empty(spark, _LAYOUT[name]), after, name)
    _write(reset_cutoff(read_table(spark, before, "cutoff"), src), after, "cutoff", small=True)


def audit_reads(spark: SparkSession, state: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P15: fact by detail_id, lineage newest first, cutoffs."""
    return (
        read_table(spark, state, "fact").orderBy("detail_id"),
        read_table(spark, state, "lineage").orderBy(F.col("data_load_started").desc()),
        read_table(spark, state, "cutoff"),
    )
