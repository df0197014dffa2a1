"""Calendar expressions and the reporting period filter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DateLike = dt.date | str


def as_date(d: DateLike) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(d)


def day(c: str = "order_date") -> Column:
    """DATE(order_date) for a date or timestamp column."""
    return F.to_date(F.col(c))


def month_start(c: Column) -> Column:
    """DATE_TRUNC(d, MONTH) as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(c, "MM")


def year_month(c: Column) -> Column:
    """FORMAT_DATE('%Y-%m', d)."""
    return F.date_format(c, "yyyy-MM")


def month_name(c: Column) -> Column:
    """FORMAT_DATE('%B', d): full English month name."""
    return F.date_format(c, "MMMM")


def in_period(df: DataFrame, start: DateLike, end: DateLike, c: str = "order_date") -> Column:
    """DATE(c) BETWEEN start AND end, written so Parquet can prune on it.

    For a timestamp column the closed date range becomes the half-open range
    ``[start 00:00, end+1 00:00)`` on the raw column, which is what reaches the
    scan as a pushed filter.
    """
    lo, hi = as_date(start), as_date(end)
    dtype = df.schema[c].dataType
    col = F.col(c)
    if isinstance(dtype, T.DateType):
        return (col >= F.lit(lo)) & (col <= F.lit(hi))
    lo_ts = dt.datetime.combine(lo, dt.time())
    hi_ts = dt.datetime.combine(hi + dt.timedelta(days=1), dt.time())
    kind = "timestamp_ntz" if isinstance(dtype, T.TimestampNTZType) else "timestamp"
    return (col >= F.lit(str(lo_ts)).cast(kind)) & (col < F.lit(str(hi_ts)).cast(kind))
