"""Raw landed by update day or month: the change window prunes folders."""

import datetime as dt

import pytest

from martlet.operators.staging import stage_updates
from martlet.sources.landing import DAY, MONTH, read_landing, write_landing
from tests.seed import seed_df, updated_in


@pytest.mark.parametrize("by", [DAY, MONTH])
def test_window_prunes_folders(spark, scratch, by):
    raw, path = seed_df(spark), f"{scratch}/landing"
    write_landing(raw, path, by=by)
    low, high = dt.datetime(2031, 3, 2, 9), dt.datetime(2031, 3, 4)
    staged = stage_updates(read_landing(spark, path, by=by), low, high)
    plan = staged._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [isnotnull({by}" in plan
    direct = stage_updates(raw, low, high)
    assert sorted(map(str, staged.collect())) == sorted(map(str, direct.collect()))
    assert staged.count() == len(updated_in(low, high))
