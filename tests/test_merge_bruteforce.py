"""MERGE against a brute-force Python reference on random small frames.

Ids repeat, values include NULL and '' so the three-valued change test,
duplicate ids, NULL ids and the duplicate-update error are all exercised.
"""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from martlet.operators.merge import Rule, plan_merge
from martlet.schemas import FACT_ORDER_DETAIL, RAW_ORDER_ITEMS, STAGE_TO_FACT

CLOCK0 = dt.datetime(2025, 9, 1, 8)
CLOCK = dt.datetime(2025, 9, 2, 8)
T1, T2 = dt.datetime(2025, 8, 1), dt.datetime(2025, 8, 2)
PLAIN = ("financial_status", "fulfillment_status", "update_date")
BLANKED = ("discount_code", "marketing_channel", "partner")
UPDATED = ("financial_status", "fulfillment_status", "discount_code", "marketing_channel", "partner", "update_date")
FACT_COLS = FACT_ORDER_DETAIL.fieldNames()
RAW_COLS = RAW_ORDER_ITEMS.fieldNames()
TO_FACT = [STAGE_TO_FACT.get(c, c) for c in RAW_COLS]


def rand_raw(rng):
    return (
        rng.choice(["1", "2", "3", None]),
        "o", "n", T1,
        rng.choice([T1, T2, None]),
        "c",
        rng.choice(["paid", "pending", None]),
        rng.choice(["fulfilled", None]),
        rng.choice(["a", "", None]),
        rng.choice(["x", None]),
        rng.choice(["p", "", None]),
        "k", "name", Decimal("1.00"),
        rng.choice([Decimal("1.00"), Decimal("2.00")]),
        Decimal("0.00"),
    )


def as_fact(raw, stamp):
    return dict(zip(TO_FACT, raw)) | {"dt_insert": stamp, "dt_update": None}


def term_plain(a, b, null_safe):
    if null_safe:
        return a != b
    return None if a is None or b is None else a != b


def cond(t, s, null_safe):
    terms = [term_plain(t[c], s[c], null_safe) for c in PLAIN]
    terms += [(t[c] or "") != (s[c] or "") for c in BLANKED]
    if any(x is True for x in terms):
        return True
    return False


def reference(target, staged, null_safe):
    src = [as_fact(r, CLOCK) for r in dict.fromkeys(staged)]
    out, qualifying_src = [], set()
    for t in target:
        q = [i for i, s in enumerate(src) if s["detail_id"] is not None and s["detail_id"] == t["detail_id"] and cond(t, s, null_safe)]
        if len(q) > 1:
            raise ValueError("duplicate update")
        if q:
            qualifying_src.add(q[0])
            s = src[q[0]]
            t = t | {c: s[c] for c in UPDATED} | {"dt_update": CLOCK}
        out.append(t)
    ids = {t["detail_id"] for t in target}
    inserts = [s for s in src if s["detail_id"] is None or s["detail_id"] not in ids]
    out += inserts
    counts = (len(src), len(inserts), len(qualifying_src), len(src) - len(inserts) - len(qualifying_src))
    return Counter(tuple(r[c] for c in FACT_COLS) for r in out), counts


@pytest.mark.parametrize("seed", range(16))
def test_random_merge_matches_reference(spark, seed):
    rng = random.Random(seed)
    null_safe = seed % 4 == 3
    target_raw = [rand_raw(rng) for _ in range(rng.randint(0, 6))]
    staged = [rand_raw(rng) for _ in range(rng.randint(0, 7))]
    target = [as_fact(r, CLOCK0) for r in target_raw]
    target_df = spark.createDataFrame([tuple(r[c] for c in FACT_COLS) for r in target], FACT_ORDER_DETAIL)
    staged_df = spark.createDataFrame(staged, RAW_ORDER_ITEMS)
    try:
        expected, counts = reference(target, staged, null_safe)
    except ValueError:
        with pytest.raises(PySparkException):
            plan_merge(target_df, staged_df, CLOCK, Rule(null_safe=null_safe)).apply(target_df).collect()
        return
    plan = plan_merge(target_df, staged_df, CLOCK, Rule(null_safe=null_safe))
    got = Counter(tuple(r) for r in plan.apply(target_df).collect())
    assert got == expected
    assert tuple(plan.counts().first()) == counts
