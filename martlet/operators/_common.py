"""Shared pieces of the reporting marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.calendar import DateLike, in_period

ORDER = "order"


def order_lines(od: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """transaction_type = 'order' AND DATE(order_date) in [start, end]."""
    return od.where((F.col("transaction_type") == ORDER) & in_period(od, start, end))


def day_col(od: DataFrame):
    return F.to_date(F.col("order_date"))
