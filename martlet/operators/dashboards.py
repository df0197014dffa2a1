"""Dashboard data sets named in the reference README (no SQL there; the
definitions are ours and follow the marts' conventions).

R5 rolling 12-month net revenue, R6 top-10 products per month, R7 channel x
partner matrix, R8 30-day daily heat map, R11 partner ranking by contribution.
Un-partitioned windows here run on frames with one row per month, per day or
per partner, never on sales lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions.calendar import DateLike, month_start
from martlet.functions.measures import Lines, money, safe_pct, safe_ratio
from martlet.operators._common import day_col, order_lines
from martlet.operators.daily_sales import DIRECT
from martlet.operators.products import product_performance

# Columns of ``order_details`` that each data set reads.
ROLLING_COLUMNS = ("order_date", "transaction_type", "line_revenue", "line_discount")
HEATMAP_COLUMNS = (*ROLLING_COLUMNS, "order_id", "adjusted_quantity")
PARTNER_COLUMNS = (
    *ROLLING_COLUMNS, "order_id", "partner_name", "adjusted_quantity", "cost", "allocated_shipping", "allocated_duties",
)
MATRIX_COLUMNS = (*PARTNER_COLUMNS, "marketing_channel")

HEATMAP_DAYS = 30
TOP_N = 10
ROLLING_MONTHS = 12


def rolling_12m_revenue(od: DataFrame, start: DateLike, end: DateLike, months: int = ROLLING_MONTHS) -> DataFrame:
    """Monthly net revenue with the sum over the trailing ``months`` calendar months."""
    lines = order_lines(od, start, end)
    m = Lines(lines)
    monthly = lines.groupBy(month_start(day_col(lines)).alias("month")).agg(
        m.total(m.net).alias("net_revenue")
    )
    idx = F.year("month") * 12 + F.month("month")
    trailing = Window.orderBy(idx).rangeBetween(-(months - 1), 0)
    return monthly.select(
        "month",
        "net_revenue",
        F.sum("net_revenue").over(trailing).cast(monthly.schema["net_revenue"].dataType).alias("rolling_12m_net_revenue"),
        F.count(F.lit(1)).over(trailing).cast("bigint").alias("months_in_window"),
    )


def top_products(od: DataFrame, start: DateLike, end: DateLike, n: int = TOP_N) -> DataFrame:
    """Products ranked in the top ``n`` by net revenue in their month (ties kept)."""
    return product_performance(od, start, end).where(F.col("revenue_rank") <= n)


def channel_partner_matrix(od: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Profitability against order value per channel and partner."""
    lines = order_lines(od, start, end)
    m = Lines(lines)
    g = lines.groupBy(
        "marketing_channel", F.coalesce(F.col("partner_name"), F.lit(DIRECT)).alias("partner_name")
    ).agg(
        F.count_distinct("order_id").alias("_orders"),
        m.total(m.net).alias("_net"),
        m.total(m.gross_profit).alias("_gp"),
        m.total(m.contribution_profit).alias("_cp"),
    )
    return g.select(
        "marketing_channel",
        "partner_name",
        F.col("_orders").cast("bigint").alias("total_orders"),
        money("_net").alias("net_revenue"),
        money("_cp").alias("contribution_profit"),
        safe_ratio("_net", "_orders").alias("avg_order_value"),
        safe_pct("_gp", "_net").alias("gross_margin_pct"),
        safe_pct("_cp", "_net").alias("contribution_margin_pct"),
    )


def daily_heatmap(od: DataFrame, start: DateLike, end: DateLike, days: int = HEATMAP_DAYS) -> DataFrame:
    """Daily totals for the last ``days`` calendar days up to the newest sale.

    The newest day is a scalar subquery over two columns; the day filter then
    cuts the lines before the distinct count.
    """
    lines = order_lines(od, start, end)
    newest = lines.agg(F.max(day_col(lines))).scalar()
    lines = lines.where(day_col(lines) > F.date_sub(newest, days))
    m = Lines(lines)
    recent = lines.groupBy(day_col(lines).alias("order_date")).agg(
        m.total(m.net).alias("_net"),
        F.count_distinct("order_id").alias("_orders"),
        F.sum("adjusted_quantity").alias("_units"),
    )
    d = F.col("order_date")
    return recent.select(
        d,
        F.dayofweek(d).cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("weekday_name"),
        F.date_trunc("week", d).cast("date").alias("week_start"),
        money("_net").alias("net_revenue"),
        F.col("_orders").cast("bigint").alias("total_orders"),
        F.col("_units").cast("bigint").alias("units_sold"),
    )


def partner_contribution(od: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """Partners ranked by contribution profit (the README's ROI question; no
    spend data exists, so contribution stands in for return)."""
    lines = order_lines(od, start, end)
    m = Lines(lines)
    g = lines.groupBy(F.coalesce(F.col("partner_name"), F.lit(DIRECT)).alias("partner_name")).agg(
        F.count_distinct("order_id").alias("_orders"),
        m.total(m.net).alias("_net"),
        m.total(m.contribution_profit).alias("_cp"),
    )
    ranked = Window.orderBy(F.col("_cp").desc())
    return g.select(
        "partner_name",
        F.col("_orders").cast("bigint").alias("total_orders"),
        money("_net").alias("net_revenue"),
        money("_cp").alias("contribution_profit"),
        safe_pct("_cp", "_net").alias("contribution_margin_pct"),
        F.rank().over(ranked).cast("bigint").alias("partner_rank"),
    )
