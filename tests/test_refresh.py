"""Marts refreshed after a merge equal marts published anew from the whole fact."""

import datetime as dt
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlet.operators.merge import plan_merge
from martlet.plans import refresh
from martlet.plans.refresh import Published
from martlet.schemas import FACT_ORDER_DETAIL, RAW_ORDER_ITEMS, conform

CLOCK = "2025-09-17 08:00:00"
START, END = "2023-01-01", "2024-12-31"
TABLES = (refresh.LINES, refresh.DAILY, refresh.PRODUCTS, "channel_performance", "daily_sales", "product_performance")


def staged_row(i, day, channel="web", partner=None, status="paid", update=0, price="10.50", product=None):
    day = day and dt.datetime(2023, 1, 1) + dt.timedelta(days=day)
    stamp = dt.datetime(2024, 6, 1) + dt.timedelta(days=update)
    p = Decimal(price)
    product = product or str((i or 0) % 2)
    text = None if i is None else str(i)
    return (text, f"O{(i or 0) // 2}", "1", day, stamp, f"c{(i or 0) % 5}", status, None, "", channel, partner, product, f"P{product}", p / 5, p, p / 10)


def staged(spark, rows):
    schema = "id string, order_id string, order_number string, order_date timestamp_ntz, update_date timestamp_ntz, customer_id string, financial_status string, fulfillment_status string, discount_codes string, channel string, partner_name string, product_key string, product_name string, cost decimal(38,9), price decimal(38,9), total_discount decimal(38,9)"
    return conform(spark.createDataFrame(rows, schema), RAW_ORDER_ITEMS)


def fact_of(spark, rows):
    none = spark.createDataFrame([], FACT_ORDER_DETAIL)
    return plan_merge(none, staged(spark, rows), CLOCK).apply(none).checkpoint()


def files(root):
    return {os.path.join(a, f): os.path.getmtime(os.path.join(a, f)) for a, _, fs in os.walk(root) for f in fs if f.endswith(".parquet")}


def rows_of(tables, name):
    return sorted(str(r.asDict()) for r in tables.read(name).select(*sorted(tables.read(name).columns)).collect())


def check(spark, scratch, before, changes, lag_rows=3):
    fact = fact_of(spark, before)
    plan = plan_merge(fact, staged(spark, changes), CLOCK)
    tables = Published(spark, f"{scratch}/kept", START, END, lag_rows)
    tables.publish(fact)
    old = files(f"{scratch}/kept")
    done = tables.refresh(fact, plan)
    anew = Published(spark, f"{scratch}/anew", START, END, lag_rows)
    anew.publish(plan.apply(fact))
    for name in TABLES:
        assert rows_of(tables, name) == rows_of(anew, name), name
    for path, time in files(f"{scratch}/kept").items():
        name, folder = path.removeprefix(f"{scratch}/kept/").split("/")[:2]
        if folder.split("=")[1] not in done.get(name, []):
            assert old[path] == time
    return done


def every_tenth_day():
    return [staged_row(i, 10 * i + 1, ["web", "shop"][i % 3 % 2], [None, "A"][i % 2]) for i in range(60)]


def test_an_insert_reaches_the_lag_and_no_further(spark, scratch):
    done = check(spark, scratch, every_tenth_day(), [staged_row(900, 95, "web", "A", product="1")])
    assert done[refresh.LINES] == ["2023-04"]
    assert done["product_performance"] == ["2023-04", "2023-05"]
    assert done["daily_sales"] == ["2023-04", "2023-06"]  # the three rows that follow in its series


def test_an_update_moves_a_line_to_another_series(spark, scratch):
    moved = staged_row(20, 201, "web", "B", update=1)
    refund = staged_row(33, 331, "web", "A", status="refunded", update=1)
    done = check(spark, scratch, every_tenth_day(), [moved, refund])
    assert done[refresh.LINES] == ["2023-07", "2023-11"]


def test_odd_rows(spark, scratch):
    before = every_tenth_day() + [staged_row(None, 50), staged_row(70, None), staged_row(71, 2000), staged_row(72, 52, None, None)]
    changes = [staged_row(None, 51), staged_row(73, None), staged_row(70, None, "shop", update=2), staged_row(72, 52, "", "A", update=1), staged_row(74, 2001)]
    done = check(spark, scratch, before, changes)
    assert done[refresh.LINES][-1] == refresh.NO_MONTH


def test_a_merge_without_changes_rewrites_nothing(spark, scratch):
    assert check(spark, scratch, every_tenth_day(), every_tenth_day()[:9]) == {}


def test_a_fact_of_one_row(spark, scratch):
    done = check(spark, scratch, [staged_row(1, 5)], [staged_row(2, 400)])
    assert done[refresh.LINES] == ["2024-02"]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_merges(spark, scratch, seed):
    r = random.Random(seed)

    def some(i, update):
        return staged_row(i, r.randrange(1, 500), r.choice(["web", "shop"]), r.choice([None, "A"]), r.choice(["paid", "paid", "refunded"]), update)

    before = [some(i, 0) for i in range(150)]
    days = {row[0]: row[3] for row in before}
    changes = [some(i, 1) for i in r.sample(range(150), 6)] + [some(200 + i, 1) for i in range(5)]
    changes = [(*c[:3], days.get(c[0], c[3]), *c[4:]) for c in changes]
    check(spark, scratch, before, changes, r.choice([1, 5, 30]))


def test_only_touched_months_are_read(spark, scratch):
    tables = Published(spark, scratch, START, END)
    tables.publish(fact_of(spark, every_tenth_day()), [])
    lines = tables.read(refresh.LINES, ["2023-04"])
    assert "PartitionFilters: [isnotnull(order_month" in lines._jdf.queryExecution().executedPlan().toString()
    assert {f.split("order_month=")[1][:7] for f in tables.read(refresh.LINES, ["2023-04"]).inputFiles()} >= {"2023-04"}
    assert lines.select(F.min("order_date"), F.max("order_date")).first()[0].month == 4


def test_money_of_three_places_is_refused(spark):
    fact = fact_of(spark, [staged_row(1, 5, price="1.005")])
    with pytest.raises(Exception, match="more than two decimal places"):
        refresh.sales_lines(fact).collect()


def test_a_refresh_runs_the_merge_once(spark, scratch):
    """Rows staged are read for the updates and for the inserts, not again by every step."""
    read = spark.sparkContext.accumulator(0)

    def watched(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    fact = fact_of(spark, every_tenth_day())
    rows = staged(spark, [staged_row(20, 201, "web", "B", update=1), staged_row(900, 95, "web", "A")])
    tables = Published(spark, scratch, START, END, 3)
    tables.publish(fact)

    def plan():
        return plan_merge(fact, conform(rows.mapInArrow(watched, rows.schema), RAW_ORDER_ITEMS), CLOCK)

    first = plan()
    first.updates.collect()
    first.inserts.collect()
    once, read.value = read.value, 0
    assert tables.refresh(fact, plan())["daily_sales"]
    assert 0 < read.value <= once
