"""Raw order-item landing rows derived from ``orders`` (one row per order).

``raw_order_items`` is the source of the incremental load; the edited copy
models a later extract in which some orders were fulfilled and re-stamped.
Built from the whole ``orders`` table; the modulo rules below only shape
values (NULLs, empty strings, codes), they never drop rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.schemas import MONEY, NUMERIC, RAW_ORDER_ITEMS, conform
from martlet.sources.tables import read_table

# Fixed values of the derivation.
ORDER_NUMBER_BASE = 100000
EDIT_EVERY = 11  # edited extract touches orders with o_orderkey % 11 = 0 ...
EDIT_BEFORE = "1999-01-01 00:00:00"  # ... whose update_date is before this
EDIT_STAMP = "1999-01-02 00:00:00"  # new update_date of an edited row


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    )
    key = F.col("o_orderkey")
    price = F.col("o_totalprice").cast(MONEY)
    order_date = F.col("o_orderdate").cast("timestamp_ntz")
    df = o.select(
        key.cast("string").alias("id"),
        F.concat(F.lit("ORD-"), key.cast("string")).alias("order_id"),
        (key + ORDER_NUMBER_BASE).cast("string").alias("order_number"),
        order_date.alias("order_date"),
        (order_date + F.make_dt_interval(days=(key % 3).cast("int"))).alias("update_date"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(F.col("o_orderstatus") == "F", "paid")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("refunded")
        .alias("financial_status"),
        F.when(F.col("o_orderstatus") == "F", F.lit("fulfilled")).alias("fulfillment_status"),
        F.when(key % 5 == 0, F.lit(None).cast("string"))
        .when(key % 5 == 1, F.lit(""))
        .otherwise(F.concat(F.lit("CODE"), (key % 7).cast("string")))
        .alias("discount_codes"),
        F.col("o_orderpriority").alias("channel"),
        F.when(key % 4 != 0, F.concat(F.lit("Partner "), (key % 9).cast("string"))).alias("partner_name"),
        (key % 25).cast("string").alias("product_key"),
        F.concat(F.lit("Product "), (key % 25).cast("string")).alias("product_name"),
        F.round(price * F.lit("0.40").cast("decimal(3,2)"), 2).cast(MONEY).alias("cost"),
        price.alias("price"),
        F.round(price * F.lit("0.10").cast("decimal(3,2)"), 2).cast(MONEY).alias("total_discount"),
    )
    return conform(df, RAW_ORDER_ITEMS)


def raw_order_items_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later extract: edited rows get a new update_date and are fulfilled."""
    df = raw_order_items(spark, sf_dir)
    edited = (F.col("id").cast("bigint") % EDIT_EVERY == 0) & (
        F.col("update_date") < F.lit(EDIT_BEFORE).cast("timestamp_ntz")
    )
    return df.withColumns(
        {
            "update_date": F.when(edited, F.lit(EDIT_STAMP).cast("timestamp_ntz")).otherwise(F.col("update_date")),
            "fulfillment_status": F.when(edited, F.lit("fulfilled")).otherwise(F.col("fulfillment_status")),
        }
    )


# Orders of these months are corrected later: one in EDIT_EVERY gets another channel, half of them another partner.
LATE_FROM, LATE_TO = "1998-11-01 00:00:00", "1999-01-01 00:00:00"
LATE_CHANNEL, LATE_PARTNER = "9-LATE", "Partner late"


def raw_order_items_corrected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A later extract in which orders of two months have corrected channels and partners."""
    df = raw_order_items(spark, sf_dir)
    date, key = F.col("order_date"), F.col("id").cast("bigint")
    late = (key % EDIT_EVERY == 0) & (date >= F.lit(LATE_FROM).cast("timestamp_ntz")) & (date < F.lit(LATE_TO).cast("timestamp_ntz"))
    return df.withColumns(
        {
            "update_date": F.when(late, F.lit(EDIT_STAMP).cast("timestamp_ntz")).otherwise(F.col("update_date")),
            "channel": F.when(late, LATE_CHANNEL).otherwise(F.col("channel")),
            "partner_name": F.when(late & (key % 2 == 0), LATE_PARTNER).otherwise(F.col("partner_name")),
        }
    )


# Fixed rule of the mixed extract: what happens to an order by its key modulo MIX.
MIX = 12


def mixed_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for a target with repeated ids and NULL ids; one in twelve orders is missing."""
    df = raw_order_items(spark, sf_dir).withColumn("k", F.substring("order_id", 5, 20).cast("bigint"))
    copies = F.when(F.col("k") % 60 == 1, 2).otherwise(1)
    return (
        df.where(F.col("k") % MIX != 10)
        .withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
        .withColumn("id", F.when(F.col("k") % 60 != 9, F.col("id")))
        .drop("k", "copy")
    )


def mixed_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged extract in which each rule of the merge decides some rows.

    By key modulo 12: 0-5 change one compared column each (2 from or to a blank
    code, 4 to NULL), 6 the price alone, 7 is an exact copy twice, 8 two rows of
    which one changes the channel, 9 has no id, 10 is new, twice, and 11 sets
    a status that the target may not have.
    """
    df = raw_order_items(spark, sf_dir).withColumn("k", F.substring("order_id", 5, 20).cast("bigint"))
    arm = F.col("k") % MIX
    twice = arm.isin(7, 8, 10)
    df = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(twice, 2).otherwise(1))))
    second = F.col("copy") == 2
    day = F.make_dt_interval(days=F.lit(1))
    return conform(
        df.withColumns(
            {
                "financial_status": F.when(arm == 0, "void").otherwise(F.col("financial_status")),
                "fulfillment_status": F.when(arm.isin(1, 11), "returned").otherwise(F.col("fulfillment_status")),
                "discount_codes": F.when(arm == 2, F.when(F.col("k") % 24 == 2, "").otherwise("NEW")).otherwise(
                    F.col("discount_codes")
                ),
                "channel": F.when((arm == 3) | ((arm == 8) & second), "OUTLET").otherwise(F.col("channel")),
                "partner_name": F.when(arm != 4, F.col("partner_name")),
                "update_date": F.when(arm == 5, F.col("update_date") + day).otherwise(F.col("update_date")),
                "price": F.when((arm == 6) | (arm.isin(8, 10) & ~second), F.col("price") + 1).otherwise(F.col("price")).cast(NUMERIC),
                "id": F.when(arm == 10, F.concat("id", F.lit("-N"))).when(arm != 9, F.col("id")),
            }
        ),
        RAW_ORDER_ITEMS,
    )
