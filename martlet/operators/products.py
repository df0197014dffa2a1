"""Monthly product performance: rank, tier and previous-row lag (P5).

Both windows run on the monthly aggregate. The lag window partitions by sku
(rows = months). A month's ranking would sort its whole catalogue in one task,
so it is taken in two levels: products fall into ``BANDS`` bands of net revenue
between quantiles of the month, ranks count within a band, and the products of
the bands above are added. Bands hold about equally many products however the
revenues are spread; equal revenues share a band.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.functions.calendar import DateLike, month_start, year_month
from martlet.functions.measures import Lines, safe_pct
from martlet.operators._common import day_col, order_lines

# Columns of ``order_details`` that the mart reads.
COLUMNS = (
    "order_date", "transaction_type", "product_sku", "product_name", "adjusted_quantity",
    "line_revenue", "line_discount", "cost",
)
# Fixed tier cut-offs, first match wins.
TIERS = ((5, "Top 5"), (10, "Top 10"), (20, "Top 20"))
OTHER = "Other"
#: Bands of net revenue that a month's ranking is split into.
BANDS = 64


def product_monthly(od: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    lines = order_lines(od, start, end)
    m = Lines(lines)
    return lines.groupBy("product_sku", "product_name", month_start(day_col(lines)).alias("_month")).agg(
        F.sum("adjusted_quantity").cast("bigint").alias("units_sold"),
        m.total(m.net).alias("net_revenue"),
        m.total(m.gross_profit).alias("gross_profit"),
    )


def ranked_in_month(monthly: DataFrame) -> DataFrame:
    """``monthly`` with ``revenue_rank``: RANK() by net revenue, largest first, NULLs last."""
    net = F.col("net_revenue").cast("double")
    cuts = [k / BANDS for k in range(1, BANDS)]
    bounds = monthly.groupBy("_month").agg(F.percentile_approx(net, cuts).alias("_cuts"))
    # The number of cuts above a revenue; quantiles need not be exact for the ranks to be.
    higher = F.size(F.filter("_cuts", lambda cut: cut > net))
    banded = monthly.join(bounds, "_month").withColumn("_band", F.when(net.isNull(), BANDS).otherwise(higher))
    above = Window.partitionBy("_month").orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    counts = banded.groupBy("_month", "_band").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_month", "_band", F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above"))
    in_band = Window.partitionBy("_month", "_band").orderBy(F.col("net_revenue").desc())
    rank = (F.col("_above") + F.rank().over(in_band)).cast("bigint")
    return banded.join(before, ["_month", "_band"]).withColumn("revenue_rank", rank)


def product_performance(od: DataFrame, start: DateLike, end: DateLike, with_lead: bool = False) -> DataFrame:
    return performance(product_monthly(od, start, end), with_lead)


def performance(monthly: DataFrame, with_lead: bool = False) -> DataFrame:
    """Ranks, tiers and lags of ``product_monthly`` rows."""
    by_sku = Window.partitionBy("product_sku").orderBy("_month", "product_name")
    tier = F.lit(OTHER)
    for cut, name in reversed(TIERS):
        tier = F.when(F.col("revenue_rank") <= cut, name).otherwise(tier)
    cols = [
        "product_sku",
        "product_name",
        year_month(F.col("_month")).alias("year_month"),
        "units_sold",
        "net_revenue",
        "gross_profit",
        safe_pct("gross_profit", "net_revenue").alias("gross_margin_pct"),
        "revenue_rank",
        tier.alias("product_tier"),
        F.lag("units_sold", 1).over(by_sku).alias("prev_month_units"),
        F.lag("net_revenue", 1).over(by_sku).alias("prev_month_revenue"),
    ]
    if with_lead:
        cols += [
            F.lead("units_sold", 1).over(by_sku).alias("next_month_units"),
            F.lead("net_revenue", 1).over(by_sku).alias("next_month_revenue"),
        ]
    return ranked_in_month(monthly).select(*cols)
