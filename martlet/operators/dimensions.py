"""Product and channel dimensions (README-only items; our definitions).

``dim_product``: one row per sku with the attributes of its newest sale
(returns are no sales). The first and last day of a sku are one hash
aggregation with map-side partial results; only the lines of a sku's last day
then meet for the tie-break on order id, name, cost and price.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.operators._common import ORDER
from martlet.operators.daily_sales import DIRECT

PRODUCT_COLUMNS = ("order_id", "order_date", "transaction_type", "product_sku", "product_name", "unit_price", "cost")
CHANNEL_COLUMNS = ("order_date", "marketing_channel", "partner_name")


def dim_product(od: DataFrame) -> DataFrame:
    sales = od.where(F.col("transaction_type") == ORDER)
    days = sales.groupBy("product_sku").agg(
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date")
    )
    last = sales.withColumnRenamed("order_date", "last_order_date").join(days, ["product_sku", "last_order_date"])
    newest = F.max(F.struct("order_id", "product_name", "cost", "unit_price")).alias("_newest")
    return (
        last.groupBy("product_sku", "first_order_date", "last_order_date")
        .agg(newest)
        .select(
            "product_sku",
            F.col("_newest.product_name").alias("product_name"),
            F.col("_newest.cost").alias("unit_cost"),
            F.col("_newest.unit_price").alias("list_price"),
            "first_order_date",
            "last_order_date",
        )
    )


def dim_channel(od: DataFrame) -> DataFrame:
    """Channel x partner pairs with the 'Direct' default for no partner."""
    return od.groupBy("marketing_channel", F.coalesce(F.col("partner_name"), F.lit(DIRECT)).alias("partner_name")).agg(
        F.max(F.col("partner_name").isNull()).alias("is_direct"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
