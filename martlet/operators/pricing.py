"""Two-level pricing and discount mart (P4).

Level 1 collapses lines to order x sku x day; level 2 to sku x day. The two
levels are kept apart on purpose: ``avg_list_price`` is the unweighted mean
of per-order means, which a single aggregation cannot give.

Level-2 keys are a subset of level-1 keys, but the first shuffle stays keyed
by all of them (order id included): a hot sku-day is then spread over many
tasks, and the second shuffle only moves one partial row per group and task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.functions.calendar import DateLike, year_month
from martlet.functions.measures import Lines, money, numeric_avg, safe_pct, safe_ratio
from martlet.operators._common import day_col, order_lines

# Columns of ``order_details`` that the mart reads.
COLUMNS = (
    "order_id", "order_date", "transaction_type", "product_sku", "product_name", "marketing_channel",
    "adjusted_quantity", "unit_price", "line_revenue", "line_discount",
)
DISCOUNTED, FULL_PRICE = "Discounted", "Full Price"


def order_level(od: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    lines = order_lines(od, start, end)
    m = Lines(lines)
    return lines.groupBy(
        day_col(lines).alias("order_date"), "product_sku", "product_name", "marketing_channel", "order_id"
    ).agg(
        F.sum("adjusted_quantity").alias("quantity"),
        # Money stays in the summing unit between the levels.
        m.units(m.amount("line_revenue")).alias("gross_units"),
        m.units(m.amount("line_discount")).alias("discount_units"),
        m.units(m.net).alias("net_units"),
        m.mean("unit_price").alias("mean_price"),
    )


def pricing_analysis(od: DataFrame, start: DateLike, end: DateLike) -> DataFrame:
    lvl1, m = order_level(od, start, end), Lines(od)
    lvl2 = lvl1.groupBy("order_date", "product_sku", "product_name", "marketing_channel").agg(
        m.value(F.sum("discount_units")).alias("_disc"),
        # order_id is a level-1 key, so it is already unique within the group.
        F.count("order_id").alias("_orders"),
        F.sum("quantity").alias("_units"),
        numeric_avg("mean_price").alias("_avg_list"),
        m.value(F.sum("net_units")).alias("_net"),
        m.value(F.sum("gross_units")).alias("_gross"),
    )
    return lvl2.select(
        "order_date",
        year_month(F.col("order_date")).alias("year_month"),
        "product_sku",
        "product_name",
        "marketing_channel",
        F.when(F.col("_disc") > 0, DISCOUNTED).otherwise(FULL_PRICE).alias("price_type"),
        F.col("_orders").cast("bigint").alias("order_count"),
        F.col("_units").cast("bigint").alias("units_sold"),
        money("_avg_list").alias("avg_list_price"),
        safe_ratio("_net", "_units").alias("avg_selling_price"),
        safe_pct("_disc", "_gross").alias("discount_rate"),
        money("_gross").alias("gross_revenue"),
        money("_disc").alias("total_discount"),
        money("_net").alias("net_revenue"),
    )
