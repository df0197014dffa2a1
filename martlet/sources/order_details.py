"""``order_details``: the sales-line table every reporting mart reads.

Derived from the star schema in the test data (lineitem x orders x part x
customer x supplier x nation x region, all inner, row count preserved).

Join plan at scale: lineitem and orders are both large, so they meet in a
shuffle join on the order key. The dimension sides carry no broadcast hint:
Spark's size check (``autoBroadcastJoinThreshold`` on each side's statistics,
then adaptive execution on real shuffle sizes) broadcasts a side only when it
is measured small and falls back to a shuffle join otherwise. Every dimension
is joined directly to the line stream, so each build side is a base table
whose size Spark knows from its files; a pre-joined supplier x nation x region
side would be estimated as the product of the three sizes and never pass the
check, forcing a shuffle of the whole line stream.

A mart names the columns it reads, and only the tables behind them are joined.
Catalyst cannot drop an inner join by itself, and at scale each needless one
would shuffle the whole line stream.

The frame is lazy: a mart's filters (``transaction_type``, date range) and its
column list are pushed through the joins into the scans.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.schemas import MONEY
from martlet.sources.tables import read_table

# Fixed values of the derivation.
CUSTOMER_NULL_EVERY = 50  # customer_id is NULL when o_custkey % 50 = 0
DIRECT_REGION_KEYS = (0, 1)  # supplier regions sold without a partner
COST_SHARE = "0.40"  # unit cost = retail price * 0.40
DUTY_RATE = "0.03"  # cross-border duty on line revenue


def _round_money(c):
    return F.round(c, 2).cast(MONEY)


def _columns() -> dict[str, tuple[Column, tuple[str, ...]]]:
    """Each column's expression and the dimension tables it needs."""
    line_revenue = F.col("l_extendedprice").cast(MONEY)
    unit_price = F.col("p_retailprice").cast(MONEY)
    duties = _round_money(line_revenue * F.lit(DUTY_RATE).cast("decimal(3,2)"))
    return {
        "order_id": (F.concat(F.lit("ORD-"), F.col("l_orderkey").cast("string")), ()),
        "customer_id": (
            F.when(F.col("o_custkey") % CUSTOMER_NULL_EVERY != 0, F.col("o_custkey")).cast("bigint"),
            ("orders",),
        ),
        "order_date": (F.col("o_orderdate").cast("date"), ("orders",)),
        "transaction_type": (F.when(F.col("l_returnflag") == "R", F.lit("return")).otherwise(F.lit("order")), ()),
        "product_sku": (F.col("p_brand"), ("part",)),
        "product_name": (F.concat(F.lit("Product "), F.col("p_brand")), ("part",)),
        "marketing_channel": (F.col("c_mktsegment"), ("orders", "customer")),
        "partner_name": (
            F.when(~F.col("r_regionkey").isin(*DIRECT_REGION_KEYS), F.col("r_name")),
            ("supplier", "nation", "region"),
        ),
        "adjusted_quantity": (F.col("l_quantity").cast("bigint"), ()),
        "unit_price": (unit_price, ("part",)),
        "line_revenue": (line_revenue, ()),
        "line_discount": (_round_money(line_revenue * F.col("l_discount").cast("decimal(4,2)")), ()),
        "cost": (_round_money(unit_price * F.lit(COST_SHARE).cast("decimal(3,2)")), ("part",)),
        "allocated_shipping": (_round_money(line_revenue * F.col("l_tax").cast("decimal(4,2)")), ()),
        "allocated_duties": (
            F.when(F.col("c_nationkey") == F.col("s_nationkey"), F.lit(0).cast(MONEY)).otherwise(duties),
            ("orders", "customer", "supplier"),
        ),
    }


# Dimension table -> key on the line stream, key of the table; joined in this order.
_JOINS = {
    "orders": ("l_orderkey", "o_orderkey"),
    "part": ("l_partkey", "p_partkey"),
    "customer": ("o_custkey", "c_custkey"),
    "supplier": ("l_suppkey", "s_suppkey"),
    "nation": ("s_nationkey", "n_nationkey"),
    "region": ("n_regionkey", "r_regionkey"),
}


def order_details(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The line table with ``columns`` (all by default), joining only the tables these need.

    Every join is along an enforced key and keeps each line once, so leaving
    one out changes no row.
    """
    every = _columns()
    names = list(every) if columns is None else [c for c in every if c in set(columns)]
    needed = {t for c in names for t in every[c][1]}
    joined = read_table(spark, sf_dir, "lineitem")
    for name, (left, right) in _JOINS.items():
        if name in needed:
            joined = joined.join(read_table(spark, sf_dir, name), F.col(left) == F.col(right))
    return joined.select(*[every[c][0].alias(c) for c in names])
