"""Monthly channel economics (P6).

One scan, one aggregation. The two COUNT(DISTINCT) are planned by Catalyst as
an Expand: the first shuffle is keyed by (month, channel, distinct value), so a
hot channel still spreads over many tasks; the second shuffle carries one
partial row per group and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.calendar import DateLike, month_start, year_month
from martlet.functions.measures import Lines, money, safe_pct, safe_ratio
from martlet.operators._common import day_col, order_lines

# Columns of ``order_details`` that the mart reads.
COLUMNS = (
    "order_id", "customer_id", "order_date", "transaction_type", "marketing_channel", "adjusted_quantity",
    "line_revenue", "line_discount", "cost", "allocated_shipping", "allocated_duties",
)


def channel_performance(od: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    lines = order_lines(od, start, end)
    m = Lines(lines)
    # Group by the month's first day (a 4-byte date) and format after.
    monthly = lines.groupBy(month_start(day_col(lines)).alias("_month"), "marketing_channel").agg(
        F.count_distinct("customer_id").alias("unique_customers"),
        F.count_distinct("order_id").alias("total_orders"),
        F.sum("adjusted_quantity").alias("units_sold"),
        m.total(m.net).alias("_net"),
        m.total(m.gross_profit).alias("_gp"),
        m.total(m.contribution_profit).alias("_cp"),
    )
    return monthly.select(
        year_month(F.col("_month")).alias("year_month"),
        "marketing_channel",
        F.col("unique_customers").cast("bigint").alias("unique_customers"),
        F.col("total_orders").cast("bigint").alias("total_orders"),
        F.col("units_sold").cast("bigint").alias("units_sold"),
        money("_net").alias("net_revenue"),
        money("_gp").alias("gross_profit"),
        money("_cp").alias("contribution_profit"),
        safe_ratio("_net", "total_orders").alias("avg_order_value"),
        safe_ratio("units_sold", "total_orders").alias("units_per_order"),
        safe_pct("_gp", "_net").alias("gross_margin_pct"),
    )
