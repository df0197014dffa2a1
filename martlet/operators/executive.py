"""Monthly executive KPIs (P2) and the fixed-label variant (P3).

The reference scans the sales table twice (once for the newest month, once
for the metrics). Here the newest month is a window max over the monthly
aggregate: same predicate, one scan, and no join at all. The monthly frame
has one row per month, so the un-partitioned windows (lag and max) work on a
calendar-bounded set however large the input is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions.calendar import DateLike, as_date, month_start
from martlet.functions.measures import Lines, money, unrounded_pct
from martlet.operators._common import day_col, order_lines

# Columns of ``order_details`` that the mart reads.
COLUMNS = ("order_id", "customer_id", "order_date", "transaction_type", "adjusted_quantity", "line_revenue", "line_discount", "cost")
# Fixed labels.
CURRENT_MONTH, PREVIOUS_MONTH, YEAR_AGO, HISTORICAL = "Current Month", "Previous Month", "Year Ago", "Historical"
CURRENT, PREVIOUS = "Current", "Previous"


def _monthly(od: DataFrame, start: DateLike, end: DateLike, *extra) -> DataFrame:
    lines = order_lines(od, start, end)
    m = Lines(lines)
    return lines.groupBy(month_start(day_col(lines)).alias("month")).agg(
        m.total(m.net).alias("_net"),
        m.total(m.gross_profit).alias("_gp"),
        F.sum("adjusted_quantity").cast("bigint").alias("units_sold"),
        F.count_distinct("customer_id").cast("bigint").alias("unique_customers"),
        *extra,
    )


def executive_kpis(od: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    monthly = _monthly(od, start, end)
    by_month = Window.orderBy("month")
    everything = by_month.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    net = F.col("_net")
    units = F.col("units_sold")
    with_lag = monthly.select(
        "month",
        "_net",
        "_gp",
        "units_sold",
        "unique_customers",
        unrounded_pct("_gp", "_net").alias("_gm"),
        F.lag(net, 12).over(by_month).alias("net_revenue_yoy"),
        F.lag(units, 12).over(by_month).alias("units_sold_yoy"),
        F.lag(net, 1).over(by_month).alias("net_revenue_mom"),
        F.lag(units, 1).over(by_month).alias("units_sold_mom"),
        F.max("month").over(everything).alias("_max_month"),
    )
    newest = F.col("_max_month")
    label = (
        F.when(F.col("month") == newest, CURRENT_MONTH)
        .when(F.col("month") == F.add_months(newest, -1), PREVIOUS_MONTH)
        .when(F.col("month") == F.add_months(newest, -12), YEAR_AGO)
        .otherwise(HISTORICAL)
    )
    return with_lag.select(
        "month",
        label.alias("period_label"),
        money("_net", 0).alias("net_revenue"),
        money("_gp", 0).alias("gross_profit"),
        money("_gm", 1).alias("gross_margin_pct"),
        "units_sold",
        "unique_customers",
        "net_revenue_yoy",
        "units_sold_yoy",
        "net_revenue_mom",
        "units_sold_mom",
    ).orderBy(F.col("month").desc())


def executive_kpis_simple(
    od: DataFrame,
    start: DateLike,
    end: DateLike,
    current_month: DateLike,
    previous_month: DateLike,
) -> DataFrame:
    monthly = _monthly(od, start, end, F.count_distinct("order_id").cast("bigint").alias("order_count"))
    month = F.col("month")
    period = (
        F.when(month == F.lit(as_date(current_month)), CURRENT)
        .when(month == F.lit(as_date(previous_month)), PREVIOUS)
        .otherwise(HISTORICAL)
    )
    return monthly.select(
        "month",
        money("_net", 0).alias("net_revenue"),
        money("_gp", 0).alias("gross_profit"),
        "units_sold",
        "unique_customers",
        "order_count",
        period.alias("period_type"),
    ).orderBy(month.desc())
