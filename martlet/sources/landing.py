"""Raw order-item landing table partitioned by update day (or month).

The change window of every incremental run is a range of ``update_date``; with
the raw rows stored under ``update_day=YYYY-MM-DD`` folders (or, for a long
history written at once, ``update_month=YYYY-MM-01``) the window's bounds
become partition filters, so a run lists and reads only what it stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.schemas import RAW_ORDER_ITEMS, conform

DAY, MONTH = "update_day", "update_month"
LANDED = T.StructType([*RAW_ORDER_ITEMS.fields, T.StructField(DAY, T.DateType())])
LANDED_BY_MONTH = T.StructType([*RAW_ORDER_ITEMS.fields, T.StructField(MONTH, T.DateType())])


def write_landing(raw: DataFrame, path: str, mode: str = "append", by: str = DAY) -> None:
    """Write raw rows under ``by`` partitions (right-sized files in each)."""
    day = F.to_date("update_date")
    keyed = conform(raw, RAW_ORDER_ITEMS).withColumn(by, day if by == DAY else F.trunc(day, "MM"))
    keyed.hint("rebalance", by).write.mode(mode).partitionBy(by).parquet(path)


def read_landing(spark: SparkSession, path: str, by: str = DAY) -> DataFrame:
    return spark.read.schema(LANDED if by == DAY else LANDED_BY_MONTH).parquet(path)
