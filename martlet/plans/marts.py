"""Publish every reporting mart and dimension as Parquet and as a named view.

The star join behind ``order_details`` is the expensive part of every mart.
``publish_marts`` writes all lines once, partitioned by order month (which also
cuts the lineage: a lost executor rereads files instead of repeating the
join), and computes everything from that copy; a mart's period then prunes
month folders.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions.calendar import DateLike, as_date
from martlet.operators.channels import channel_performance
from martlet.operators.daily_sales import daily_sales
from martlet.operators.dashboards import (
    channel_partner_matrix,
    daily_heatmap,
    partner_contribution,
    rolling_12m_revenue,
    top_products,
)
from martlet.operators.dimensions import dim_channel, dim_product
from martlet.operators.executive import executive_kpis, executive_kpis_simple
from martlet.operators.pricing import pricing_analysis
from martlet.operators.products import product_performance

MONTH = "order_month"

Mart = Callable[[DataFrame, DateLike, DateLike], DataFrame]

MARTS: dict[str, Mart] = {
    "daily_sales": daily_sales,
    "executive_kpis": executive_kpis,
    "pricing_analysis": pricing_analysis,
    "product_performance": product_performance,
    "channel_performance": channel_performance,
    "rolling_12m_revenue": rolling_12m_revenue,
    "top10_products": top_products,
    "channel_partner_matrix": channel_partner_matrix,
    "daily_heatmap_30d": daily_heatmap,
    "partner_contribution": partner_contribution,
}
DIMENSIONS: dict[str, Callable[[DataFrame], DataFrame]] = {"dim_product": dim_product, "dim_channel": dim_channel}


def store_order_details(od: DataFrame, path: str) -> None:
    """Write the lines by order month; a hot month is spread over several tasks."""
    lines = od.withColumn(MONTH, F.coalesce(F.date_format("order_date", "yyyy-MM"), F.lit("none")))
    lines.hint("rebalance", MONTH).write.mode("overwrite").partitionBy(MONTH).parquet(path)


def read_order_details(
    spark: SparkSession, path: str, schema: T.StructType, start: DateLike | None = None, end: DateLike | None = None
) -> DataFrame:
    """The stored lines, with the months outside ``start``..``end`` left unread."""
    lines = spark.read.schema(T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])).parquet(path)
    if start is not None and end is not None:
        first, last = f"{as_date(start):%Y-%m}", f"{as_date(end):%Y-%m}"
        lines = lines.where(F.col(MONTH).between(first, last))
    return lines.select(*schema.fieldNames())


def publish_marts(
    od: DataFrame,
    out_root: str,
    start: DateLike,
    end: DateLike,
    current_month: DateLike,
    previous_month: DateLike,
    names: list[str] | None = None,
    view_prefix: str = "tableau_",
) -> dict[str, str]:
    """Write each mart and dimension to ``<out_root>/<name>`` and register it
    as the view ``<view_prefix><name>``; return name -> path."""
    spark, root = od.sparkSession, out_root.rstrip("/")
    store_order_details(od, f"{root}/order_details")
    lines = read_order_details(spark, f"{root}/order_details", od.schema, start, end)
    whole = read_order_details(spark, f"{root}/order_details", od.schema)
    simple = partial(executive_kpis_simple, current_month=current_month, previous_month=previous_month)
    builds = {n: partial(f, lines, start, end) for n, f in {**MARTS, "executive_kpis_simple": simple}.items()}
    builds |= {n: partial(f, whole) for n, f in DIMENSIONS.items()}
    out = {}
    for name in names or list(builds):
        out[name] = f"{root}/{name}"
        builds[name]().write.mode("overwrite").parquet(out[name])
        spark.read.parquet(out[name]).createOrReplaceTempView(f"{view_prefix}{name}")
    return out
