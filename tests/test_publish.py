"""Published marts equal the lazy ones and can be read by name."""

from martlet.operators.channels import channel_performance
from martlet.operators.dimensions import dim_product
from martlet.plans.marts import DIMENSIONS, MARTS, publish_marts, read_order_details
from martlet.sources import order_details
from tests.conftest import SF_SMOKE

START, END = "1995-01-01", "2001-12-31"


def test_publish_matches_direct(spark, scratch):
    od = order_details(spark, SF_SMOKE)
    paths = publish_marts(od, scratch, START, END, "2001-08-01", "2001-07-01")
    assert set(paths) == {*MARTS, *DIMENSIONS, "executive_kpis_simple"}
    for name, direct in (("channel_performance", channel_performance(od, START, END)), ("dim_product", dim_product(od))):
        published = spark.table(f"tableau_{name}")
        assert sorted(map(str, published.collect())) == sorted(map(str, direct.collect()))
    one_year = read_order_details(spark, f"{scratch}/order_details", od.schema, "1996-01-01", "1996-12-31")
    assert "PartitionFilters: [isnotnull(order_month" in one_year._jdf.queryExecution().executedPlan().toString()
