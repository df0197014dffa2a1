"""MERGE semantics on hand frames."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from martlet.operators.merge import Rule, merge_upsert, now_los_angeles, plan_merge
from martlet.operators.staging import advance_cutoff, stage_updates
from martlet.schemas import ETL_CUTOFF, FACT_ORDER_DETAIL, RAW_ORDER_ITEMS, empty

T = dt.datetime.fromisoformat
CLOCK0 = T("2025-09-10 08:00")
CLOCK = T("2025-09-20 08:00")


def raw_row(id_, update="2025-09-15 10:00", fs="paid", ffs=None, code="alpha", ch="Audio", partner="P1", price="69.95"):
    return (id_, "O" + str(id_), "9" + str(id_), T("2025-09-15 10:00"), T(update), "c1", fs, ffs, code, ch, partner,
            "k1", "Tin", Decimal("21.05"), Decimal(price), Decimal("0"))


def fact_of(spark, rows):
    staged = spark.createDataFrame(rows, RAW_ORDER_ITEMS)
    return merge_upsert(empty(spark, FACT_ORDER_DETAIL), staged, CLOCK0)


def merged(spark, target_rows, source_rows, **kw):
    target = fact_of(spark, target_rows)
    staged = spark.createDataFrame(source_rows, RAW_ORDER_ITEMS) if source_rows else empty(spark, RAW_ORDER_ITEMS)
    plan = plan_merge(target, staged, CLOCK, Rule(**kw))
    rows = plan.apply(target).collect()
    return rows, plan.counts().first()


def test_status_null_to_value_same_update_date_is_not_a_change(spark):
    rows, c = merged(spark, [raw_row("1", ffs=None)], [raw_row("1", ffs="fulfilled")])
    (r,) = rows
    assert r.fulfillment_status is None and r.dt_update is None
    assert (c.inserted, c.updated, c.unchanged) == (0, 0, 1)


def test_status_null_to_value_null_safe_option(spark):
    rows, c = merged(spark, [raw_row("1", ffs=None)], [raw_row("1", ffs="fulfilled")], null_safe=True)
    (r,) = rows
    assert r.fulfillment_status == "fulfilled" and r.dt_update == CLOCK and c.updated == 1


def test_discount_null_vs_blank_is_not_a_change(spark):
    rows, c = merged(spark, [raw_row("1", code=None)], [raw_row("1", code="")])
    (r,) = rows
    assert r.discount_code is None and c.updated == 0


def test_price_only_change_is_ignored(spark):
    rows, c = merged(spark, [raw_row("1")], [raw_row("1", price="10.00")])
    (r,) = rows
    assert r.price == Decimal("69.95") and c.updated == 0


def test_price_and_update_date_change_moves_only_update_columns(spark):
    rows, c = merged(spark, [raw_row("1")], [raw_row("1", update="2025-09-18 10:00", price="10.00")])
    (r,) = rows
    assert r.update_date == T("2025-09-18 10:00") and r.price == Decimal("69.95")
    assert r.dt_insert == CLOCK0 and r.dt_update == CLOCK and c.updated == 1


def test_exact_duplicates_collapse(spark):
    rows, c = merged(spark, [], [raw_row("1"), raw_row("1")])
    assert len(rows) == 1 and (c.staged, c.inserted) == (1, 1)


def test_duplicate_new_id_both_inserted(spark):
    rows, c = merged(spark, [], [raw_row("1", price="1.00"), raw_row("1", price="2.00")])
    assert len(rows) == 2 and c.inserted == 2


def test_two_qualifying_source_rows_raise(spark):
    with pytest.raises(PySparkException):
        merged(spark, [raw_row("1")], [raw_row("1", fs="refunded"), raw_row("1", fs="pending")])


def test_one_of_two_source_rows_qualifies(spark):
    rows, c = merged(spark, [raw_row("1")], [raw_row("1", price="5.00"), raw_row("1", fs="refunded")])
    (r,) = rows
    assert r.financial_status == "refunded" and (c.updated, c.unchanged) == (1, 1)


def test_null_id_always_inserted(spark):
    rows, c = merged(spark, [raw_row(None)], [raw_row(None)])
    assert len(rows) == 2 and c.inserted == 1


def test_target_rows_absent_from_source_are_kept(spark):
    rows, c = merged(spark, [raw_row("1"), raw_row("2")], [raw_row("3")])
    assert sorted(r.detail_id for r in rows) == ["1", "2", "3"]


def test_empty_stage_and_empty_fact(spark):
    rows, c = merged(spark, [], [])
    assert rows == [] and tuple(c) == (0, 0, 0, 0)


def test_window_bounds_half_open(spark):
    raw = spark.createDataFrame(
        [raw_row("a", update="2025-09-15 10:00"), raw_row("b", update="2025-09-16 00:00"), raw_row("c", update="2025-09-14 23:59")],
        RAW_ORDER_ITEMS,
    )
    staged = stage_updates(raw, T("2025-09-15 10:00"), T("2025-09-16 00:00"))
    assert [r.id for r in staged.collect()] == ["a"]
    initial = stage_updates(raw, None, T("2025-09-16 00:00"), initial_load=T("2025-09-15 00:00"))
    assert sorted(r.id for r in initial.collect()) == ["a"]


def test_cutoff_falls_back_to_fact_then_null(spark):
    cut0 = spark.createDataFrame([("s", "t", None), ("s", "u", None), ("x", "t", None)], ETL_CUTOFF)
    fact = fact_of(spark, [raw_row("1", update="2025-09-12 00:00")])
    no_stage = empty(spark, RAW_ORDER_ITEMS)
    moved = {(r.src_table_name, r.tgt_table_name): r.cutoff_time for r in advance_cutoff(cut0, no_stage, fact, "s").collect()}
    assert moved == {("s", "t"): T("2025-09-12"), ("s", "u"): T("2025-09-12"), ("x", "t"): None}
    paired = {(r.src_table_name, r.tgt_table_name): r.cutoff_time for r in advance_cutoff(cut0, no_stage, fact, "s", "t").collect()}
    assert paired[("s", "u")] is None
    both_empty = advance_cutoff(cut0, no_stage, empty(spark, FACT_ORDER_DETAIL), "s").where(F.col("tgt_table_name") == "t")
    assert both_empty.where(F.col("src_table_name") == "s").first().cutoff_time is None


def test_hot_id_copies_collapse_before_matching(spark):
    """One id with thousands of staged rows (exact copies and price-only
    variants) meets its target row as a single counted profile."""
    target = fact_of(spark, [raw_row("hot"), raw_row("cold")])
    rows = [raw_row("hot", update="2025-09-18 10:00", price=p) for p in ("1.00", "2.00", "3.00") for _ in range(1000)]
    staged = spark.createDataFrame(rows, RAW_ORDER_ITEMS)
    plan = plan_merge(target, staged, CLOCK)
    # three distinct source rows share one update profile: weight 3 -> error
    with pytest.raises(PySparkException):
        plan.apply(target).collect()
    single = spark.createDataFrame([raw_row("hot", update="2025-09-18 10:00")] * 3000, RAW_ORDER_ITEMS)
    out = plan_merge(target, single, CLOCK).apply(target).collect()
    assert len(out) == 2 and {r.detail_id: r.update_date for r in out}["hot"] == T("2025-09-18 10:00")


def test_merge_of_any_table(spark):
    """Two keys, one compared column with a default, one plain, other stamps and names."""
    target = spark.createDataFrame(
        [(1, "a", 5, None, "keep"), (1, "b", 6, "x", "keep"), (2, "a", None, "y", "keep")],
        "shop int, item string, stock int, shelf string, note string",
    ).withColumns({"born": F.lit(CLOCK0).cast("timestamp_ntz"), "seen": F.lit(None).cast("timestamp_ntz")})
    staged = spark.createDataFrame(
        [(1, "a", 5, "", "new"), (1, "b", 7, "x", "new"), (2, "a", 9, "y", "new"), (3, "a", 1, "z", "new")],
        "store int, item string, stock int, shelf string, note string",
    )
    rule = Rule(
        keys=("shop", "item"), change_cols={"stock": None, "shelf": ""}, update_cols=("stock", "shelf"),
        rename={"store": "shop"}, insert_stamp="born", update_stamp="seen",
    )
    plan = plan_merge(target, staged, CLOCK, rule)
    got = {(r.shop, r.item): (r.stock, r.shelf, r.note, r.born, r.seen) for r in plan.apply(target).collect()}
    assert got == {
        (1, "a"): (5, None, "keep", CLOCK0, None),  # blank and NULL are the same shelf
        (1, "b"): (7, "x", "keep", CLOCK0, CLOCK),
        (2, "a"): (None, "y", "keep", CLOCK0, None),  # NULL stock against a value is no difference
        (3, "a"): (1, "z", "new", CLOCK, None),
    }
    assert tuple(plan.counts().first()) == (4, 1, 1, 2)


def test_clock_keeps_microseconds():
    assert any(now_los_angeles().microsecond for _ in range(20))
