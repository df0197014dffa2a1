"""Incremental load between plain states: run sequences, crashes, golden counts, reset."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from martlet.operators.merge import MergePlan
from martlet.operators.staging import row_count_audit
from martlet.plans import incremental
from martlet.plans.incremental import audit_reads, is_complete, read_table, reset, run_incremental
from martlet.sources import raw_order_items, raw_order_items_edited
from tests.conftest import SF_CHECK
from tests.seed import ROWS, seed_df, update_time, updated_in

SRC, TGT = "raw_order_items", "fact_order_detail"
T = dt.datetime.fromisoformat
CLOCK = T("2031-03-20 08:00:00.123456")
INITIAL = "2031-03-01 00:00:00"
END = "2031-03-10 00:00:00"


class Loads:
    """Runs one after another, each into a state of its own."""

    def __init__(self, spark, root):
        self.spark, self.root, self.state, self.n = spark, root, None, 0

    def run(self, raw, target, **kw):
        self.n += 1
        after = f"{self.root}/state-{self.n}"
        report = run_incremental(self.spark, self.state, after, raw, SRC, TGT, target, clock=CLOCK, initial_load=INITIAL, **kw)
        self.state = after
        return report

    def table(self, name):
        return read_table(self.spark, self.state, name)


def test_seed_sequence(spark, scratch):
    loads, raw = Loads(spark, scratch), seed_df(spark)
    seen, cutoff = set(), None
    for target in ("2031-03-02 12:00:00", "2031-03-04 00:00:00", END, END):
        window = updated_in(cutoff, T(target))
        new = [i for i in window if i not in seen]
        rep = loads.run(raw, target)
        assert (rep.staged, rep.inserted, rep.updated) == (len(window), len(new), 0)
        assert rep.unchanged == len(window) - len(new) and rep.cutoff_before == cutoff
        seen |= set(new)
        cutoff = max(update_time(i) for i in window)
        assert rep.cutoff_after == cutoff and loads.table("fact").count() == len(seen)
    assert len(seen) == ROWS
    fact, lineage, cutoffs = audit_reads(spark, loads.state)
    ids = [r.detail_id for r in fact.collect()]
    assert ids == sorted(ids) and fact.filter(F.col("dt_insert") != CLOCK).count() == 0
    lin = lineage.collect()
    assert len(lin) == 4 and all(r.was_successful and r.data_load_completed == CLOCK for r in lin)
    assert [tuple(r) for r in cutoffs.collect()] == [(SRC, TGT, cutoff)]
    audit = {r.table_name: r.record_count for r in row_count_audit(raw, loads.table("staging"), loads.table("fact")).collect()}
    assert audit == {"raw_data": ROWS, "staged_data": len(updated_in(cutoff, T(END))), "fact_data": ROWS}


def test_inserts_are_counted_from_the_facts(spark, scratch, monkeypatch):
    """A run hands the number of inserts to the report, so the merge is not run again to count them."""
    given, counts = [], MergePlan.counts

    def watched(self, *known):
        given.append(known)
        return counts(self, *known)

    monkeypatch.setattr(MergePlan, "counts", watched)
    loads, raw = Loads(spark, scratch), seed_df(spark)
    first, second = loads.run(raw, "2031-03-04 00:00:00"), loads.run(raw, END)
    assert given == [(first.inserted,), (second.inserted,)] and first.inserted + second.inserted == ROWS


def test_reset_then_reload(spark, scratch):
    loads, raw = Loads(spark, scratch), seed_df(spark)
    loads.run(raw, END)
    reset(spark, loads.state, f"{scratch}/reset", SRC)
    loads.state = f"{scratch}/reset"
    assert [loads.table(n).count() for n in ("fact", "lineage", "staging")] == [0, 0, 0]
    assert loads.table("cutoff").first().cutoff_time is None
    assert loads.run(raw, END).inserted == ROWS


def test_update_then_rerun_is_noop(spark, scratch):
    loads, raw = Loads(spark, scratch), seed_df(spark)
    loads.run(raw, END)
    stamp = T("2031-03-11 09:00")
    hit = F.col("id") == "line-005"
    edited = raw.withColumns(
        {
            "update_date": F.when(hit, F.lit(stamp).cast("timestamp_ntz")).otherwise(F.col("update_date")),
            "fulfillment_status": F.when(hit, F.lit("sent")).otherwise(F.col("fulfillment_status")),
        }
    )
    rep = loads.run(edited, "2031-03-12 00:00:00")
    assert (rep.inserted, rep.updated) == (0, 1)
    row = loads.table("fact").where(F.col("detail_id") == "line-005").first()
    assert row.update_date == stamp and row.dt_update == CLOCK and row.fulfillment_status == "sent"
    again = loads.run(edited, "2031-03-12 00:00:00")
    assert (again.staged, again.inserted, again.updated) == (1, 0, 0)


def test_state_is_never_overwritten_by_its_own_run(spark, scratch):
    with pytest.raises(ValueError):
        run_incremental(spark, f"{scratch}/a", f"{scratch}/a/", seed_df(spark), SRC, TGT, END)


@pytest.mark.parametrize("step", range(1, 6))
def test_a_run_killed_at_any_write_can_be_repeated(spark, scratch, monkeypatch, step):
    loads, raw = Loads(spark, scratch), seed_df(spark)
    loads.run(raw, "2031-03-03 00:00:00")
    write, left = incremental._write, [step]

    def dying(*args, **kw):
        left[0] -= 1
        if left[0] == 0:
            raise RuntimeError("killed")
        write(*args, **kw)

    monkeypatch.setattr(incremental, "_write", dying)
    args = (spark, loads.state, f"{scratch}/next", raw, SRC, TGT, END)
    with pytest.raises(RuntimeError):
        run_incremental(*args, clock=CLOCK, initial_load=INITIAL)
    assert not is_complete(spark, f"{scratch}/next")
    assert loads.table("fact").count() == len(updated_in(None, T("2031-03-03")))
    monkeypatch.undo()
    run_incremental(*args, clock=CLOCK, initial_load=INITIAL)
    assert is_complete(spark, f"{scratch}/next")
    ids = [r.detail_id for r in read_table(spark, f"{scratch}/next", "fact").collect()]
    assert len(ids) == len(set(ids)) == ROWS
    lineage = read_table(spark, f"{scratch}/next", "lineage").collect()
    assert len(lineage) == 2 and all(r.was_successful for r in lineage)


@pytest.mark.slow
def test_scaled_golden_counts(spark, scratch):
    args = dict(clock=CLOCK, initial_load="1995-01-01 00:00:00")
    one, two = f"{scratch}/1", f"{scratch}/2"
    r1 = run_incremental(spark, None, one, raw_order_items(spark, SF_CHECK), SRC, TGT, "1999-01-01 00:00:00", **args)
    assert (r1.staged, r1.inserted, r1.cutoff_after) == (9015, 9015, T("1998-12-31 00:00"))
    r2 = run_incremental(spark, one, two, raw_order_items_edited(spark, SF_CHECK), SRC, TGT, "2002-01-01 00:00:00", **args)
    assert (r2.staged, r2.inserted, r2.updated, r2.unchanged) == (6815, 5985, 818, 12)
    assert read_table(spark, two, "fact").count() == 15000
    assert r2.cutoff_after == T("2001-08-03 00:00")


def test_newest_open_run_key_picks_highest_uuid(spark):
    from martlet.plans.control import close_run, newest_open_run_key, open_run
    from martlet.schemas import LINEAGE, empty

    lin = empty(spark, LINEAGE)
    for key in ("a-key", "c-key", "b-key"):
        lin = open_run(lin, key, SRC, TGT, CLOCK, CLOCK)
    lin = close_run(lin, "c-key", CLOCK)
    assert newest_open_run_key(lin, SRC) == "b-key"
    assert newest_open_run_key(lin, "other") is None


def test_any_run_sequence_covers_exactly_the_window(spark, scratch):
    rng = random.Random(7)
    loads, raw = Loads(spark, scratch), seed_df(spark)
    top = T(INITIAL)
    for _ in range(3):
        target = T(f"2031-03-{rng.randint(1, 6):02d} {rng.randint(0, 23):02d}:00")
        loads.run(raw, str(target))
        top = max(top, target)
        ids = [r.detail_id for r in loads.table("fact").select("detail_id").collect()]
        assert sorted(ids) == [f"line-{i:03d}" for i in updated_in(None, top)]
