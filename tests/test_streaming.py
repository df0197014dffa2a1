"""The landing stream gives the fact of a single batch run, whatever the order of delivery."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from martlet.plans.incremental import read_table, run_incremental
from martlet.streaming import start_landing_stream, state_path
from tests.seed import ROWS, seed_df

CLOCK = dt.datetime(2031, 3, 20, 8, 0)
END = "2031-03-10 00:00:00"
FIRST = "2031-03-01 00:00:00"


class Landing:
    def __init__(self, spark, root):
        self.spark, self.root, self.reports, self.files = spark, root, [], 0

    def deliver(self, df):
        self.files += 1
        df.coalesce(1).write.parquet(f"{self.root}/landing/d{self.files}")

    def take(self, target=END, per_batch=None):
        start_landing_stream(
            self.spark, f"{self.root}/landing/*", f"{self.root}/store", "raw", "fact", f"{self.root}/ckpt",
            target_cutoff=target, clock=CLOCK, initial_load=FIRST, max_files_per_trigger=per_batch, reports=self.reports,
        ).awaitTermination(300)
        return read_table(self.spark, state_path(f"{self.root}/store", len(self.reports) - 1), "fact")


def single_run(spark, root):
    run_incremental(spark, None, f"{root}/single", seed_df(spark), "raw", "fact", END, clock=CLOCK, initial_load=FIRST)
    return read_table(spark, f"{root}/single", "fact")


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_newer_file_first_one_file_a_batch(spark, scratch):
    land, raw = Landing(spark, scratch), seed_df(spark)
    early = F.col("update_date") < "2031-03-03"
    land.deliver(raw.where(~early))
    land.deliver(raw.where(early))
    fact = land.take(per_batch=1)
    assert len(land.reports) == 2 and fact.count() == ROWS
    assert same(fact, single_run(spark, scratch))


def test_late_file_and_rows_past_the_target(spark, scratch):
    land, raw = Landing(spark, scratch), seed_df(spark)
    part = F.substring("id", 6, 3).cast("int") % 3
    land.deliver(raw.where(part == 0))
    fact = land.take(target="2031-03-03 00:00:00")
    assert fact.count() == land.reports[0].inserted < 8  # rows past the target are held back
    land.deliver(raw.where(part == 1))
    land.take(target="2031-03-03 00:00:00")
    land.deliver(raw.where(part == 2))  # much of it older than the cutoff
    fact = land.take()
    assert same(fact, single_run(spark, scratch))
    before = len(land.reports)
    land.take()
    assert len(land.reports) == before  # nothing landed, nothing to run


@pytest.mark.parametrize("per_batch", [None, 1])
def test_rows_before_the_initial_load_are_never_taken(spark, scratch, per_batch):
    land, raw = Landing(spark, scratch), seed_df(spark)
    part = F.substring("id", 6, 3).cast("int") % 2
    for k in (0, 1):  # in the first and in a later file
        old = raw.where(part == k).withColumn("update_date", F.lit("2031-02-01").cast("timestamp"))
        old = old.withColumn("id", F.concat(F.lit("old-"), "id")).select(raw.columns)
        land.deliver(raw.where(part == k).unionByName(old))
    fact = land.take(per_batch=per_batch)
    assert same(fact, single_run(spark, scratch))


def test_checkpoint_is_required(spark, scratch):
    with pytest.raises(TypeError):
        start_landing_stream(spark, scratch, scratch, "raw", "fact")
