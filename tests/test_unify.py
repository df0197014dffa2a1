"""Unified feeds: bad cells are set aside with a reason, or stop a strict load."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martlet.operators.unify import Feed, Parsed, split_channels, unify_channels
from martlet.schemas import ORDER_DETAILS
from martlet.sources.channel_feeds import FEEDS

MONEY = ("unit_price", "line_revenue", "line_discount", "cost", "allocated_shipping", "allocated_duties")


def feed() -> Feed:
    same = {f.name: None for f in ORDER_DETAILS.fields}
    day = Parsed("day", F.try_to_date("day", "dd.MM.yyyy"))
    return Feed(**{**same, "order_id": "no", "customer_id": "who", "order_date": day, "unit_price": "price"})


def rows(spark, data):
    return spark.createDataFrame(data, "no string, who string, day string, price string")


GOOD = [("1", "7", "01.02.1995", "1.50"), ("2", None, None, None), ("3", " 8 ", "28.02.1995", "2")]
BAD = [("4", "x", "30.02.1995", "1"), ("5", "9", "01.01.1995", "1.005"), (None, "", "02.01.1995", "EUR 1"), ("6", "1", "?", "1e99")]


def test_bad_cells_are_set_aside(spark):
    valid, rejects = split_channels({"a": (rows(spark, GOOD + BAD), feed()), "b": (rows(spark, GOOD), feed())})
    assert valid.columns == [*ORDER_DETAILS.fieldNames(), "source"]
    kept = sorted((r.source, r.order_id, r.customer_id, r.unit_price) for r in valid.collect())
    want = [("1", 7, Decimal("1.50")), ("2", None, None), ("3", 8, Decimal("2.00"))]
    assert kept == [(s, *w) for s in "ab" for w in want]
    got = sorted((str(r.order_id), r.column_name, r.raw_value, r.reason) for r in rejects.collect())
    assert got == [
        ("4", "customer_id", "x", "not a bigint"),
        ("4", "order_date", "30.02.1995", "not a date"),
        ("5", "unit_price", "1.005", "more places than decimal(18,2) holds"),
        ("6", "order_date", "?", "not a date"),
        ("6", "unit_price", "1e99", "not a decimal(18,2)"),
        ("None", "customer_id", "", "not a bigint"),
        ("None", "unit_price", "EUR 1", "not a decimal(18,2)"),
    ]
    assert {r.source for r in rejects.collect()} == {"a"}


def test_clean_and_empty_feeds_have_no_rejects(spark):
    df = rows(spark, GOOD)
    valid, rejects = split_channels({"a": (df, feed())})
    assert rejects.count() == 0
    assert sorted(map(str, valid.collect())) == sorted(map(str, unify_channels({"a": (df, feed())}).collect()))
    empty = split_channels({"a": (df.limit(0), feed())})
    assert empty.valid.count() == empty.rejects.count() == 0


@pytest.mark.parametrize("bad", BAD[:1] + BAD[2:])
def test_strict_load_stops_at_a_bad_cell(spark, bad):
    with pytest.raises(Exception):
        unify_channels({"a": (rows(spark, [bad]), feed())}).collect()


def test_rows_without_a_bad_cell_are_found_without_a_lambda(spark):
    """A lambda is interpreted for every row; the valid rows are told by plain predicates, and
    only faulty rows come to the array of bad cells."""
    valid, rejects = split_channels({"a": (rows(spark, GOOD + BAD), feed())})
    plan = valid._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "named_struct" not in plan
    nodes = rejects._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert [n for n in nodes if "Filter " in n] and not [n for n in nodes if "Filter " in n and "lambda" in n]


def test_a_feed_of_the_declared_types_has_no_rejects(spark):
    names = [f.name for f in ORDER_DETAILS.fields]
    row = ("1", 7, None, "order", "s", "n", "c", None, 2, *[Decimal("1.50")] * 6)
    df = spark.createDataFrame([row, tuple([None] * len(names))], ORDER_DETAILS)
    valid, rejects = split_channels({"a": (df, Feed(**{n: n for n in names}))})
    assert sorted(map(str, valid.drop("source").collect())) == sorted(map(str, df.collect()))
    assert rejects.count() == 0


def test_amounts_in_cents_are_exact(spark):
    cents = [0, 1, -1, 99, -12345, 10**18 - 1, -(10**18 - 1), None]
    df = spark.createDataFrame([(c,) for c in cents], "unit_price_cents bigint")
    got = [r.v for r in df.select(FEEDS["marketplace"]().columns["unit_price"].alias("v")).collect()]
    assert got == [None if c is None else Decimal(c).scaleb(-2) for c in cents]
