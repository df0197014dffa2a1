"""Exact money: any declared scale, no floating point, nothing rounded on the way."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlet.operators.channels import channel_performance
from martlet.operators.daily_sales import daily_sales
from martlet.operators.executive import executive_kpis, executive_kpis_simple
from martlet.operators.merge import merge_upsert
from martlet.operators.pricing import pricing_analysis
from martlet.operators.products import product_performance
from martlet.schemas import FACT_ORDER_DETAIL, ORDER_DETAILS, RAW_ORDER_ITEMS, conform, empty
from tests.seed import seed_df

D = Decimal
NUMERIC = "decimal(38,9)"
MONEY = ("unit_price", "line_revenue", "line_discount", "cost", "allocated_shipping", "allocated_duties")
PERIOD = ("2030-01-01", "2030-12-31")


def lines(spark, n=100):
    """100 lines with sub-cent prices and costs of nine decimal places."""
    row = (1, dt.date(2030, 5, 4), "order", "S", "Tea", "web", None, 3) + tuple(
        D(x) for x in ("3.333333333", "10.000000001", "0.000000004", "0.009", "0.001000001", "0.002")
    )
    names = [c for c in ORDER_DETAILS.fieldNames() if c != "order_id"]
    schema = ", ".join(f"{c} {NUMERIC if c in MONEY else ORDER_DETAILS[c].dataType.simpleString()}" for c in names)
    df = spark.createDataFrame([row], schema).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(n))))
    return df.withColumn("order_id", F.concat(F.lit("O"), "n")).drop("n")


NET = 100 * (D("10.000000001") - D("0.000000004"))
GP = NET - 300 * D("0.009")
CP = GP - 100 * D("0.003000001")


def near(x, scale):
    return x.quantize(D(1).scaleb(-scale), "ROUND_HALF_UP")


def test_marts_keep_nine_decimal_places(spark):
    od = lines(spark)
    (r,) = channel_performance(od, *PERIOD).collect()
    assert (r.net_revenue, r.gross_profit, r.contribution_profit) == (near(NET, 2), near(GP, 2), near(CP, 2))
    assert r.gross_margin_pct == near(near(GP / NET, 9) * 100, 2)
    (r,) = daily_sales(od, *PERIOD).collect()
    assert (r.gross_revenue, r.product_cost, r.shipping_cost) == (D("1000.00"), D("2.70"), D("0.10"))
    assert (r.avg_unit_price, r.avg_unit_cost) == (D("3.33"), D("0.01"))
    (r,) = product_performance(od, *PERIOD).collect()
    assert (r.net_revenue, r.gross_profit) == (NET, GP)
    (r,) = executive_kpis(od, *PERIOD).collect()
    assert (r.net_revenue, r.gross_profit) == (D("1000"), D("997"))
    (r,) = executive_kpis_simple(od, *PERIOD, "2030-05-01", "2030-04-01").collect()
    assert (r.net_revenue, r.gross_profit, r.period_type) == (D("1000"), D("997"), "Current")
    (r,) = pricing_analysis(od, *PERIOD).collect()
    assert (r.avg_list_price, r.gross_revenue, r.price_type) == (D("3.33"), D("1000.00"), "Discounted")
    assert r.avg_selling_price == near(NET / 300, 2)


def test_small_costs_are_not_cut_to_cents(spark):
    od = lines(spark).withColumn("adjusted_quantity", F.lit(11).cast("bigint"))
    (r,) = channel_performance(od, *PERIOD).collect()
    assert r.gross_profit == near(NET - 1100 * D("0.009"), 2) == D("990.10")


def test_floating_point_money_is_refused(spark):
    od = lines(spark).withColumn("line_revenue", F.col("line_revenue").cast("double"))
    for build in (channel_performance, daily_sales, executive_kpis, pricing_analysis, product_performance):
        with pytest.raises(TypeError):
            build(od, *PERIOD)


def test_load_keeps_the_scale_of_money(spark):
    raw = seed_df(spark)
    fact = merge_upsert(empty(spark, FACT_ORDER_DETAIL), raw, "2031-03-20 08:00:00")
    assert {r.cost for r in fact.select("cost").collect()} == {D("3.125"), D("4.40"), D("2.075")}
    for kind in ("double", "decimal(38,10)"):
        with pytest.raises(TypeError):
            conform(raw.withColumn("cost", F.col("cost").cast(kind)), RAW_ORDER_ITEMS)
