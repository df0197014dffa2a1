"""Conditional upsert of staged rows into a target table (P9).

Defined for any table by its keys, the columns whose change makes an update,
the columns an update sets, and the two stamp columns:

* the source is the set of distinct staged rows, under the target's names;
* rows match on the keys; a NULL key matches nothing;
* a match is an update when some compared column differs. A column with a
  default is compared with the default in place of NULL; without one, NULL
  against anything is no difference, unless ``null_safe``;
* an update sets the update columns and the update stamp, nothing else;
* a source row without a match is inserted with the insert stamp (several such
  rows of one key all are); target rows without a source row stay;
* two source rows that would update one target row are an error.

Plan. Target rows are semi-joined to the staged keys and reduced to distinct
profiles (keys, compared and updated columns); source rows likewise, with a row
count. One equi-join on the keys finds the updates, counted per target profile
for the error rule, and one join on the profile applies them. Everything is
lazy; no job runs while the plan is built.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.operators.staging import TimestampLike, ts
from martlet.schemas import STAGE_TO_FACT, conform

# The order-detail fact: keys, compared columns with their defaults, updated columns.
KEYS = ("detail_id",)
CHANGE_COLS: Mapping[str, object] = {
    "financial_status": None,
    "fulfillment_status": None,
    "update_date": None,
    "discount_code": "",
    "marketing_channel": "",
    "partner": "",
}
UPDATE_COLS = ("financial_status", "fulfillment_status", "discount_code", "marketing_channel", "partner", "update_date")
INSERT_STAMP, UPDATE_STAMP = "dt_insert", "dt_update"
DUPLICATE_UPDATE = "merge: more than one source row would update the same target row (key %s)"


@dataclass(frozen=True)
class Rule:
    """What a merge compares and sets; column names are those of the target."""

    keys: Sequence[str] = KEYS
    change_cols: Mapping[str, object] = None
    update_cols: Sequence[str] = UPDATE_COLS
    rename: Mapping[str, str] = None
    null_safe: bool = False
    insert_stamp: str = INSERT_STAMP
    update_stamp: str = UPDATE_STAMP

    def __post_init__(self):
        object.__setattr__(self, "change_cols", dict(CHANGE_COLS if self.change_cols is None else self.change_cols))
        object.__setattr__(self, "rename", dict(STAGE_TO_FACT if self.rename is None else self.rename))

    @property
    def profile(self) -> list[str]:
        return list(dict.fromkeys([*self.keys, *self.change_cols, *self.update_cols]))

    def differs(self, name: str, t: Column, s: Column) -> Column:
        default = self.change_cols[name]
        if default is not None:
            return F.coalesce(t, F.lit(default)) != F.coalesce(s, F.lit(default))
        return ~t.eqNullSafe(s) if self.null_safe else t != s

    def changed(self, t: str, s: str) -> Column:
        """Whether source ``s`` changes target ``t``; an unknown answer is no."""
        terms = [self.differs(c, F.col(f"{t}.{c}"), F.col(f"{s}.{c}")) for c in self.change_cols]
        return F.coalesce(reduce(or_, terms), F.lit(False))


def source_rows(target: DataFrame, staged: DataFrame, clock: TimestampLike, rule: Rule) -> DataFrame:
    """The distinct staged rows in the target's layout, stamped as inserts."""
    named = staged.select(*[F.col(c).alias(rule.rename.get(c, c)) for c in staged.columns])
    stamps = {rule.insert_stamp: ts(clock), rule.update_stamp: ts(None)}
    return conform(named.dropDuplicates().withColumns(stamps), target.schema)


@dataclass
class MergePlan:
    """Lazy pieces of one merge. ``apply`` gives the new target."""

    rule: Rule
    source: DataFrame  # distinct staged rows, target layout
    updates: DataFrame  # profile of each updated target row, ``_new`` values, ``_hit``
    inserts: DataFrame  # source rows without a match
    clock: TimestampLike

    def apply(self, target: DataFrame) -> DataFrame:
        """``target`` with updates applied, plus the inserts."""
        rule = self.rule
        same = [F.col(f"t.{c}").eqNullSafe(F.col(f"u.{c}")) for c in rule.profile if c not in rule.keys]
        on = reduce(and_, [F.col(f"t.{c}") == F.col(f"u.{c}") for c in rule.keys] + same)
        joined = target.alias("t").join(self.updates.alias("u"), on, "left")
        hit = F.col("u._hit").isNotNull()
        cols = []
        for c in target.columns:
            new = F.col(f"u._new.{c}") if c in rule.update_cols else ts(self.clock) if c == rule.update_stamp else None
            old = F.col(f"t.{c}")
            cols.append((old if new is None else F.when(hit, new).otherwise(old)).alias(c))
        return joined.select(*cols).unionByName(self.inserts)

    def counts(self, inserted: int | None = None) -> DataFrame:
        """One row: staged, inserted, updated, unchanged (all counted in source rows).

        ``inserted``: the number of inserts, where it is known already.
        """
        staged = self.source.agg(F.count(F.lit(1)).alias("staged"))
        added = self.inserts.agg(F.count(F.lit(1)).alias("inserted")).scalar() if inserted is None else F.lit(inserted)
        updated = self.updates.select(*self.rule.keys, "_new", "_hit").distinct().agg(F.count(F.lit(1)).alias("updated"))
        return staged.select(
            F.col("staged").cast("bigint").alias("staged"),
            added.cast("bigint").alias("inserted"),
            updated.scalar().cast("bigint").alias("updated"),
        ).withColumn("unchanged", F.col("staged") - F.col("inserted") - F.col("updated"))


def plan_merge(target: DataFrame, staged: DataFrame, clock: TimestampLike, rule: Rule | None = None) -> MergePlan:
    rule = rule or Rule()
    keys, profile = list(rule.keys), rule.profile
    src = source_rows(target, staged, clock, rule)
    keyed = src.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    sources = keyed.groupBy(*profile).agg(F.count(F.lit(1)).alias("_rows"))
    targets = target.join(keyed.select(*keys).distinct(), keys, "left_semi").select(*profile).distinct()
    match = reduce(and_, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])
    pairs = targets.alias("t").join(sources.alias("s"), match).where(rule.changed("t", "s"))
    new = F.struct(*[F.col(f"s.{c}").alias(c) for c in rule.update_cols])
    found = pairs.groupBy(*[F.col(f"t.{c}").alias(c) for c in profile]).agg(
        F.sum("s._rows").alias("_rows"), F.max(new).alias("_new")
    )
    twice = F.raise_error(F.format_string(DUPLICATE_UPDATE, F.concat_ws(",", *[F.col(k).cast("string") for k in keys])))
    updates = found.select(*profile, "_new", F.when(F.col("_rows") > 1, twice).otherwise(F.lit(True)).alias("_hit"))
    inserts = src.join(targets.select(*keys).distinct(), keys, "left_anti").select(*src.columns)
    return MergePlan(rule, src, updates, inserts, clock)


def merge_upsert(
    target: DataFrame,
    staged: DataFrame,
    clock: TimestampLike,
    keys: Sequence[str] = KEYS,
    change_cols: Mapping[str, object] | None = None,
    update_cols: Sequence[str] = UPDATE_COLS,
    rename: Mapping[str, str] | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """The whole new target after the merge (lazy)."""
    rule = Rule(keys, change_cols, update_cols, rename, null_safe)
    return plan_merge(target, staged, clock, rule).apply(target)


def now_los_angeles() -> dt.datetime:
    """Zoneless wall-clock time in Los Angeles, to the microsecond."""
    return dt.datetime.now(ZoneInfo("America/Los_Angeles")).replace(tzinfo=None)
