"""Per-source order feeds (storefront, marketplace, wholesale) for the
unification build, derived from one stored copy of ``order_details``.

The feeds differ as sources do: names, types, units and signs, and the
wholesale feed has no partner. Each sales line goes to exactly one feed by its
market segment. The copy is partitioned by feed, so unifying the three reads
each line once.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.operators.unify import Feed, Parsed
from martlet.schemas import MONEY

# Which feed carries which segment (anything else: storefront).
MARKETPLACE_SEGMENTS = ("BUILDING", "FURNITURE")
WHOLESALE_SEGMENTS = ("AUTOMOBILE", "MACHINERY")

MONEY_COLUMNS = ("unit_price", "line_revenue", "line_discount", "cost", "allocated_shipping", "allocated_duties")


def feed_of() -> Column:
    seg = F.col("marketing_channel")
    return (
        F.when(seg.isin(*MARKETPLACE_SEGMENTS), "marketplace")
        .when(seg.isin(*WHOLESALE_SEGMENTS), "wholesale")
        .otherwise("storefront")
    )


def store_feeds(od: DataFrame, path: str) -> None:
    """Write the lines once, partitioned by the feed that will carry them."""
    od.withColumn("feed", feed_of()).write.mode("errorifexists").partitionBy("feed").parquet(path)


def channel_feeds(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The three feeds as their sources ship them."""
    lines = spark.read.parquet(path)

    def part(name: str) -> DataFrame:
        return lines.where(F.col("feed") == name)

    c = F.col
    in_cents = {m: (c(m) * 100).cast("bigint") for m in MONEY_COLUMNS}
    storefront = part("storefront").select(
        c("order_id").alias("order_name"),
        c("customer_id").cast("string").alias("customer"),
        c("order_date").cast("timestamp_ntz").alias("created_on"),
        c("transaction_type").alias("kind"),
        c("product_sku").alias("sku"),
        c("product_name").alias("title"),
        c("marketing_channel").alias("segment"),
        F.coalesce("partner_name", F.lit("")).alias("referrer"),
        c("adjusted_quantity").cast("int").alias("qty"),
        *[c(m) for m in MONEY_COLUMNS],
    )
    marketplace = part("marketplace").select(
        F.substring("order_id", 5, 40).cast("bigint").alias("marketplace_order"),
        c("customer_id").alias("buyer_id"),
        F.date_format("order_date", "dd.MM.yyyy").alias("purchase_date"),
        (c("transaction_type") == "return").alias("is_refund"),
        c("product_sku").alias("seller_sku"),
        c("product_name").alias("item_name"),
        c("marketing_channel").alias("sales_channel"),
        c("partner_name").alias("affiliate"),
        c("adjusted_quantity").alias("quantity_shipped"),
        *[in_cents[m].alias(f"{m}_cents") for m in MONEY_COLUMNS],
    )
    wholesale = part("wholesale").select(
        c("order_id").alias("po_number"),
        c("customer_id").cast("string").alias("account_no"),
        F.unix_date("order_date").alias("invoice_day"),
        F.when(c("transaction_type") == "return", "CR").otherwise("IN").alias("doc_type"),
        c("product_sku").alias("item_code"),
        c("product_name").alias("item_desc"),
        F.lower("marketing_channel").alias("account_segment"),
        c("adjusted_quantity").cast("decimal(12,0)").alias("cases"),
        c("unit_price").cast("string").alias("case_price"),
        c("line_revenue").alias("extended_amount"),
        (-c("line_discount")).alias("allowance"),
        c("cost").alias("case_cost"),
        c("allocated_shipping").alias("freight"),
        c("allocated_duties").alias("tariff"),
    )
    return {"storefront": storefront, "marketplace": marketplace, "wholesale": wholesale}


def spoiled(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The feeds with cells as careless sources ship them: words for ids, days that do not
    exist, prices with a currency or a third decimal place, blank accounts."""
    c = F.col
    storefront, marketplace, wholesale = feeds["storefront"], feeds["marketplace"], feeds["wholesale"]
    name, po = F.substring("order_name", 5, 40).cast("bigint"), F.substring("po_number", 5, 40).cast("bigint")
    price = F.when(po % 17 == 5, F.concat(F.lit("EUR "), c("case_price"))).when(po % 17 == 6, F.concat(c("case_price"), F.lit("5")))
    return {
        "storefront": storefront.withColumn("customer", F.when(name % 11 == 3, "guest").otherwise(c("customer"))),
        "marketplace": marketplace.withColumn(
            "purchase_date", F.when(c("marketplace_order") % 13 == 4, "31.02.1995").otherwise(c("purchase_date"))
        ),
        "wholesale": wholesale.withColumns(
            {
                "case_price": F.coalesce(price, c("case_price")),
                "account_no": F.when(po % 19 == 7, "").otherwise(c("account_no")),
            }
        ),
    }


def _amounts() -> dict[str, Column]:
    # Exact as the quotient by 100 is, and cheaper.
    return {m: (F.col(f"{m}_cents").cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(MONEY) for m in MONEY_COLUMNS}


# How each feed's columns give the unified ones.
FEEDS = {
    "storefront": lambda: Feed(
        order_id="order_name", customer_id="customer", order_date="created_on", transaction_type="kind",
        product_sku="sku", product_name="title", marketing_channel="segment",
        partner_name=F.nullif(F.col("referrer"), F.lit("")), adjusted_quantity="qty",
        **{m: m for m in MONEY_COLUMNS},
    ),
    "marketplace": lambda: Feed(
        order_id=F.concat(F.lit("ORD-"), F.col("marketplace_order").cast("string")), customer_id="buyer_id",
        order_date=Parsed("purchase_date", F.try_to_date("purchase_date", "dd.MM.yyyy")),
        transaction_type=F.when(F.col("is_refund"), "return").otherwise("order"),
        product_sku="seller_sku", product_name="item_name", marketing_channel="sales_channel",
        partner_name="affiliate", adjusted_quantity="quantity_shipped", **_amounts(),
    ),
    "wholesale": lambda: Feed(
        order_id="po_number", customer_id="account_no", order_date=F.date_from_unix_date("invoice_day"),
        transaction_type=F.when(F.col("doc_type") == "CR", "return").otherwise("order"),
        product_sku="item_code", product_name="item_desc", marketing_channel=F.upper("account_segment"),
        partner_name=None, adjusted_quantity="cases", unit_price="case_price", line_revenue="extended_amount",
        line_discount=-F.col("allowance"), cost="case_cost", allocated_shipping="freight", allocated_duties="tariff",
    ),
}
