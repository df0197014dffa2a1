"""Daily sales mart with a lagged comparison (P1).

Aggregate first, then window: the lag runs over the daily grain (at most one
row per selling day per sku/channel/partner), so its partitions are bounded by
the calendar even when one sku holds a large share of the lines. All five
lagged expressions share one window spec, hence one shuffle and one sort.

The lag counts rows, not days: ``*_30d_ago`` is the value 30 selling days
back in that partition. ``product_name`` is an extra sort key so that two
names under one sku on the same day order deterministically.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions.calendar import DateLike, month_name, year_month
from martlet.functions.measures import Lines, money, safe_pct
from martlet.operators._common import day_col, order_lines

DIRECT = "Direct"
# A lag's series, and the order of its rows.
SERIES = ("product_sku", "marketing_channel", "partner_name")
SERIES_ORDER = ("order_date", "product_name")
MEASURED = (
    "order_id", "customer_id", "adjusted_quantity", "unit_price", "line_revenue", "line_discount", "cost",
    "allocated_shipping", "allocated_duties",
)


def _first_of(group: list[str], c: str):
    """1 on one line of each value of ``c`` in the group, else 0; NULL is no value."""
    place = F.row_number().over(Window.partitionBy(*group, c).orderBy(c))
    return F.when(F.col(c).isNotNull() & (place == 1), 1).otherwise(0)


def daily_grain(od: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    """The mart without its lagged columns: one row per day, product, channel and partner."""
    lines = order_lines(od, start, end)
    m = Lines(lines)
    keys = [
        day_col(lines).alias("order_date"),
        F.col("product_sku"),
        F.col("product_name"),
        F.col("marketing_channel"),
        F.coalesce(F.col("partner_name"), F.lit(DIRECT)).alias("partner_name"),
    ]
    names = ["order_date", "product_sku", "product_name", "marketing_channel", "partner_name"]
    rest = [c for c in MEASURED if c not in names]
    # The narrow lines are dealt once, by the group; within a group, the first
    # line of each order and of each customer is marked by a local sort, and
    # the marks are summed. COUNT(DISTINCT) would send every line three times.
    # Date parts depend on the day alone: group by the day, derive them after.
    dealt = lines.select(*keys, *rest).repartition(*names)
    firsts = {f"_first_{c}": _first_of(names, c) for c in ("order_id", "customer_id")}
    g = dealt.withColumns(firsts).groupBy(*names).agg(
        F.sum("adjusted_quantity").alias("_units"),
        F.sum("_first_order_id").alias("_orders"),
        F.sum("_first_customer_id").alias("_customers"),
        m.total(m.times_quantity("unit_price")).alias("_gross"),
        m.total(m.amount("line_discount")).alias("_disc"),
        m.total(m.net).alias("_net"),
        m.total(m.product_cost).alias("_pcost"),
        m.total(m.amount("allocated_shipping")).alias("_ship"),
        m.total(m.amount("allocated_duties")).alias("_duty"),
        m.total(m.gross_profit).alias("_gp"),
        m.total(m.contribution_profit).alias("_cp"),
        m.mean("unit_price").alias("_avg_price"),
        m.mean("cost").alias("_avg_cost"),
    )
    d = F.col("order_date")
    return g.select(
        d,
        F.year(d).cast("bigint").alias("year"),
        F.quarter(d).cast("bigint").alias("quarter"),
        F.month(d).cast("bigint").alias("month_num"),
        month_name(d).alias("month_name"),
        year_month(d).alias("year_month"),
        "product_sku",
        "product_name",
        "marketing_channel",
        "partner_name",
        F.col("_units").cast("bigint").alias("units_sold"),
        F.col("_orders").cast("bigint").alias("order_count"),
        F.col("_customers").cast("bigint").alias("customer_count"),
        money("_gross").alias("gross_revenue"),
        money("_disc").alias("discount_amount"),
        money("_net").alias("net_revenue"),
        money("_pcost").alias("product_cost"),
        money("_ship").alias("shipping_cost"),
        money("_duty").alias("duties_cost"),
        money("_gp").alias("gross_profit"),
        money("_cp").alias("contribution_profit"),
        safe_pct("_gp", "_net").alias("gross_margin_pct"),
        safe_pct("_cp", "_net").alias("contribution_margin_pct"),
        money("_avg_price").alias("avg_unit_price"),
        money("_avg_cost").alias("avg_unit_cost"),
    )


def with_lag(daily: DataFrame, lag_rows: int = 30) -> DataFrame:
    """``daily_grain`` rows with the values ``lag_rows`` rows back in their series."""
    w = Window.partitionBy(*SERIES).orderBy(*SERIES_ORDER)
    suffix = f"{lag_rows}d"
    lagged = daily.withColumns(
        {
            f"net_revenue_{suffix}_ago": F.lag("net_revenue", lag_rows).over(w),
            f"units_sold_{suffix}_ago": F.lag("units_sold", lag_rows).over(w),
        }
    )
    # The change is taken between the rounded values, as the mart shows them.
    prev = F.col(f"net_revenue_{suffix}_ago")
    return lagged.withColumn(
        f"revenue_change_{suffix}_pct", safe_pct(F.col("net_revenue") - prev, prev)
    )


def daily_sales(od: DataFrame, start: DateLike, end: DateLike, lag_rows: int = 30) -> DataFrame:
    return with_lag(daily_grain(od, start, end), lag_rows)
