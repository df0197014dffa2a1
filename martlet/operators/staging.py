"""Change window, cutoff advance and row-count audit of the incremental load.

``stage_updates`` (P8) keeps raw rows with ``update_date`` in the half-open
window ``[COALESCE(last_cutoff, initial_load), target_cutoff)``. The lower
bound is inclusive, so the boundary row is staged again next run (a re-staged
unchanged row does not update anything). With literal bounds the window is a
pushed filter, and on a raw table landed by update day a partition filter, so
whole day folders are skipped; bounds that are scalar subqueries are applied
when they are known.

``advance_cutoff`` (P11): the new cutoff is the newest staged update, else the
newest fact update, else NULL. The fact as it was before the merge will do: the
fallback only applies when nothing is staged, and then the merge changes nothing.

Bounds may be Python values (driver scalars read from the cutoff table) or
Columns, e.g. ``df.scalar()`` subqueries, which keep a multi-run plan lazy.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.schemas import STAGED_ORDER_ITEMS, conform

TimestampLike = dt.datetime | str | Column | None

# Fixed value: first load date when a pair has no cutoff yet.
INITIAL_LOAD = "2025-09-01 00:00:00"


def ts(value: TimestampLike) -> Column:
    """A timestamp_ntz Column from a datetime, ISO string, Column or None."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def stage_updates(
    raw: DataFrame,
    last_cutoff: TimestampLike,
    target_cutoff: TimestampLike,
    initial_load: TimestampLike = INITIAL_LOAD,
) -> DataFrame:
    lower = F.coalesce(ts(last_cutoff), ts(initial_load))
    upper = ts(target_cutoff)
    upd = F.col("update_date")
    window = (upd >= lower) & (upd < upper)
    # Raw landed by update day or month: the same window on the partition
    # column leaves whole folders unopened.
    if "update_day" in raw.columns:
        day = F.col("update_day")
        window = window & (day >= F.to_date(lower)) & (day <= F.to_date(upper))
    if "update_month" in raw.columns:
        month = F.col("update_month")
        window = window & (month >= F.trunc(F.to_date(lower), "MM")) & (month <= F.to_date(upper))
    return conform(raw.where(window), STAGED_ORDER_ITEMS)


def cutoff_value(staged: DataFrame, fact: DataFrame) -> Column:
    """COALESCE(MAX(staged.update_date), MAX(fact.update_date)) as a scalar subquery."""
    return F.coalesce(
        staged.agg(F.max("update_date")).scalar(),
        fact.agg(F.max("update_date")).scalar(),
    )


def advance_cutoff(
    cutoffs: DataFrame,
    staged: DataFrame,
    fact: DataFrame,
    src_table: str,
    tgt_table: str | None = None,
) -> DataFrame:
    """The cutoff table with rows of ``src_table`` moved to the new cutoff.

    The reference filters on the source name only, so every target of that
    source moves; pass ``tgt_table`` to move just one pair.
    """
    hit = F.col("src_table_name") == src_table
    if tgt_table is not None:
        hit = hit & (F.col("tgt_table_name") == tgt_table)
    return cutoffs.withColumn(
        "cutoff_time", F.when(hit, cutoff_value(staged, fact)).otherwise(F.col("cutoff_time"))
    )


def row_count_audit(raw: DataFrame, staged: DataFrame, fact: DataFrame, inserts: DataFrame | None = None) -> DataFrame:
    """(table_name, record_count) for the raw, staged and fact tables (P14).

    A merge deletes nothing, so the merged fact need not be built to count it:
    pass the fact before the merge and the merge's ``inserts``.
    """

    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("table_name"), "record_count")

    rows = counted("fact_data", fact)
    if inserts is not None:
        added = inserts.agg(F.count(F.lit(1)).alias("n")).scalar()
        rows = rows.withColumn("record_count", F.col("record_count") + added)
    return counted("raw_data", raw).unionAll(counted("staged_data", staged)).unionAll(rows)
