"""Reporting marts on small hand frames: NULLs, zero revenue, ties, gaps, empty input."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from martlet.operators.channels import channel_performance
from martlet.operators.daily_sales import daily_sales
from martlet.operators.dashboards import rolling_12m_revenue
from martlet.operators.dimensions import dim_product
from martlet.operators.executive import executive_kpis, executive_kpis_simple
from martlet.operators.pricing import pricing_analysis
from martlet.operators.products import BANDS, product_monthly, product_performance, ranked_in_month
from martlet.schemas import ORDER_DETAILS, empty

D = Decimal
START, END = "2020-01-01", "2023-12-31"


def line(order="O1", cust=1, day="2023-01-05", kind="order", sku="S1", name="Tin", ch="Web", partner=None,
         qty=1, price="10.00", rev="10.00", disc="0.00", cost="4.00", ship="1.00", duty="0.00"):
    return (order, cust, dt.date.fromisoformat(day), kind, sku, name, ch, partner, qty, D(price), D(rev), D(disc),
            D(cost), D(ship), D(duty))


def frame(spark, rows):
    return spark.createDataFrame(rows, ORDER_DETAILS)


def test_zero_net_revenue_gives_null_percent(spark):
    od = frame(spark, [line(rev="5.00", disc="5.00")])
    (r,) = daily_sales(od, START, END).collect()
    assert r.net_revenue == D("0.00") and r.gross_margin_pct is None and r.contribution_margin_pct is None
    assert r.partner_name == "Direct"


def test_returns_and_out_of_range_rows_are_excluded(spark):
    od = frame(spark, [line(), line(kind="return"), line(day="2019-12-31"), line(day="2024-01-01")])
    assert channel_performance(od, START, END).first().units_sold == 1


def test_null_channel_is_a_group(spark):
    od = frame(spark, [line(ch=None), line(order="O2", ch="Web")])
    got = {r.marketing_channel: r.total_orders for r in channel_performance(od, START, END).collect()}
    assert got == {None: 1, "Web": 1}


def test_one_discounted_order_flags_the_day(spark):
    od = frame(spark, [line(order="O1", disc="1.00"), line(order="O2"), line(order="O3")])
    (r,) = pricing_analysis(od, START, END).collect()
    assert r.price_type == "Discounted" and r.order_count == 3 and r.discount_rate == D("3.33")


def test_avg_list_price_is_mean_of_order_means(spark):
    od = frame(spark, [line(order="O1", price="10.00"), line(order="O1", price="20.00"), line(order="O2", price="30.00")])
    (r,) = pricing_analysis(od, START, END).collect()
    assert r.avg_list_price == D("22.50")  # mean(15, 30), not mean(10, 20, 30)


def test_tied_products_share_rank(spark):
    od = frame(spark, [line(sku="A", name="A"), line(sku="B", name="B"), line(sku="C", name="C", rev="5.00")])
    ranks = {r.product_sku: (r.revenue_rank, r.product_tier) for r in product_performance(od, START, END).collect()}
    assert ranks == {"A": (1, "Top 5"), "B": (1, "Top 5"), "C": (3, "Top 5")}


def test_rank_over_bands_equals_one_window(spark, monkeypatch):
    import random

    from martlet.operators import products

    monkeypatch.setattr(products, "BANDS", 5)
    r = random.Random(3)
    rows = [line(sku=f"S{i}", name=f"N{i}", rev=f"{r.choice([-50, 0, 1, 2, 3, 70, 900])}.00") for i in range(60)]
    rows += [line(sku="null", name="null")[:10] + (None,) + line()[11:]]
    got = {x.product_sku: (x.revenue_rank, x.net_revenue) for x in product_performance(frame(spark, rows), START, END).collect()}
    for sku, (rank, net) in got.items():
        greater = sum(1 for _, other in got.values() if other is not None and (net is None or other > net))
        assert rank == greater + 1


def test_lag_takes_previous_present_month(spark):
    od = frame(spark, [line(day="2023-01-05", qty=1), line(day="2023-03-05", qty=3)])
    rows = {r.year_month: r.prev_month_units for r in product_performance(od, START, END).collect()}
    assert rows == {"2023-01": None, "2023-03": 1}


def test_executive_labels_and_yoy(spark):
    rows = [line(day=f"{2022 + (m // 12)}-{m % 12 + 1:02d}-10", qty=m + 1) for m in range(14)]
    od = frame(spark, rows)
    out = executive_kpis(od, START, END).collect()
    assert out[0].month == dt.date(2023, 2, 1) and out[0].period_label == "Current Month"
    assert out[1].period_label == "Previous Month" and out[12].period_label == "Year Ago"
    assert out[0].units_sold_yoy == 2 and out[0].units_sold_mom == 13
    simple = executive_kpis_simple(od, START, END, "2023-02-01", "2023-01-01").collect()
    assert [r.period_type for r in simple[:3]] == ["Current", "Previous", "Historical"]


def test_daily_lag_counts_rows_not_days(spark):
    rows = [line(day=(dt.date(2023, 1, 1) + dt.timedelta(days=2 * i)).isoformat(), rev=f"{i + 1}.00") for i in range(32)]
    out = daily_sales(frame(spark, rows), START, END).orderBy("order_date").collect()
    assert out[30].net_revenue_30d_ago == out[0].net_revenue
    assert out[30].revenue_change_30d_pct == D("3000.00")
    assert out[29].net_revenue_30d_ago is None


def test_rolling_window_is_calendar_months(spark):
    od = frame(spark, [line(day="2022-01-05"), line(day="2022-12-05"), line(day="2023-01-05")])
    got = {r.month: (r.rolling_12m_net_revenue, r.months_in_window) for r in rolling_12m_revenue(od, START, END).collect()}
    assert got[dt.date(2023, 1, 1)] == (D("20.00"), 2)


def test_dim_product_takes_newest_row(spark):
    od = frame(spark, [line(day="2023-01-01", name="Old", cost="1.00"), line(day="2023-02-01", name="New", cost="2.00")])
    (r,) = dim_product(od).collect()
    assert (r.product_name, r.unit_cost, r.first_order_date) == ("New", D("2.00"), dt.date(2023, 1, 1))


def test_empty_input(spark):
    od = empty(spark, ORDER_DETAILS)
    for build in (daily_sales, channel_performance, pricing_analysis, product_performance, executive_kpis):
        assert build(od, START, END).count() == 0
    assert F is not None


def test_negative_base_keeps_its_sign(spark):
    rows = [line(day=(dt.date(2023, 1, 1) + dt.timedelta(days=i)).isoformat(), rev="1.00", disc="3.00") for i in range(31)]
    rows[-1] = line(day="2023-01-31", rev="5.00", disc="0.00")
    out = daily_sales(frame(spark, rows), START, END).orderBy("order_date").collect()
    assert out[30].net_revenue_30d_ago == D("-2.00")
    assert out[30].revenue_change_30d_pct == D("-350.00")  # (5 - -2) / -2 * 100


def test_an_outlier_does_not_crowd_the_bands(spark):
    rows = [line(sku=f"S{i}", rev=f"{10 + i}.00") for i in range(640)] + [line(sku="BIG", rev="99999999.00")]
    monthly = product_monthly(frame(spark, rows), START, END)
    ranked = ranked_in_month(monthly)
    assert ranked.groupBy("_band").count().agg(F.max("count")).first()[0] <= 2 * 641 / BANDS
    assert [r[0] for r in ranked.orderBy("revenue_rank").select("revenue_rank").collect()] == list(range(1, 642))
    assert ranked.where("product_sku = 'BIG'").first().revenue_rank == 1


def test_ties_and_null_revenues_rank_as_one_window_would(spark):
    rows = [(f"S{i}", None if i % 10 == 0 else D(i // 3)) for i in range(300)]
    monthly = spark.createDataFrame(rows, "product_sku string, net_revenue decimal(18,2)").withColumn("_month", F.lit(dt.date(2023, 1, 1)))
    plain = F.rank().over(Window.partitionBy("_month").orderBy(F.col("net_revenue").desc())).cast("bigint")
    got = ranked_in_month(monthly).withColumn("plain", plain)
    assert got.where("revenue_rank <> plain").count() == 0 and got.count() == 300
