"""Unify per-source order feeds into the ``order_details`` layout (R1).

A ``Feed`` says for every unified column which column or expression of the
source gives it; None is a column that the source does not have, and becomes
NULL. Each feed is cast to the declared schema and tagged with its source, and
the feeds are stacked (no shuffle: the union concatenates their partitions).

``unify_channels`` stops at a cell that does not fit; ``split_channels`` sets such
rows aside, one reject row for each bad cell, and unifies the others.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.schemas import ORDER_DETAILS, conform


#: Holds decimal text of up to 18 places, to see what a narrower type would round.
WIDE = T.DecimalType(38, 18)


class Parsed(NamedTuple):
    """A unified column read from the cell ``raw`` by an expression that is NULL where it cannot read it."""

    raw: str
    value: Column


class Split(NamedTuple):
    valid: DataFrame
    rejects: DataFrame


class Feed:
    """Unified column -> source column name, Parsed cell, expression, or None (not shipped)."""

    def __init__(self, **columns: str | Parsed | Column | None):
        names = set(ORDER_DETAILS.fieldNames())
        if set(columns) != names:
            raise ValueError(f"feed must map {sorted(names - set(columns))}, and not {sorted(set(columns) - names)}")
        self.columns = columns


def conform_feed(df: DataFrame, feed: Feed, source: str) -> DataFrame:
    cols = []
    for f in ORDER_DETAILS.fields:
        given = feed.columns[f.name]
        if isinstance(given, Parsed):
            stop = F.raise_error(F.concat(F.lit(f"{source}.{given.raw}: "), F.col(given.raw).cast("string")))
            given = F.coalesce(given.value, F.when(F.col(given.raw).isNotNull(), stop))
        value = F.lit(None).cast(f.dataType) if given is None else F.col(given) if isinstance(given, str) else given
        cols.append(value.alias(f.name))
    return conform(df.select(*cols), ORDER_DETAILS).withColumn("source", F.lit(source))


def unify_channels(feeds: dict[str, tuple[DataFrame, Feed]]) -> DataFrame:
    parts = [conform_feed(df, feed, source) for source, (df, feed) in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _reason(raw: Column, have: T.DataType, value: Column, want: T.DataType) -> Column:
    """Why ``raw`` gives no ``want``; NULL when it does. A NULL cell is no fault."""
    reason = F.when(raw.isNotNull() & value.isNull(), f"not a {want.simpleString()}")
    if isinstance(want, T.DecimalType) and isinstance(have, T.StringType):
        rounds = raw.try_cast(WIDE) != value
        reason = reason.when(rounds, f"more places than {want.simpleString()} holds")
    return reason


def split_feed(df: DataFrame, feed: Feed, source: str) -> Split:
    """The rows of one feed without a bad cell, unified, and the bad cells of the others.

    A cell is bad that is not NULL and has no value of the declared type, or is
    text with more decimal places (up to 18 are seen) than the type holds. Blank
    text is no number and no date. Expressions without a raw cell (see Parsed)
    are cast strictly.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    values, faults, cells = [], [], []
    for f in ORDER_DETAILS.fields:
        given = feed.columns[f.name]
        if given is None:
            values.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(given, Column):
            values.append(given.cast(f.dataType).alias(f.name))
        else:
            name, value = (given.raw, given.value) if isinstance(given, Parsed) else (given, F.col(given))
            value = value.try_cast(f.dataType)
            values.append(value.alias(f.name))
            reason = _reason(F.col(name), types[name], value, f.dataType)
            if isinstance(given, Parsed) or types[name] != f.dataType:  # a cell of the declared type is never bad
                faults.append(reason.isNotNull())
            cells.append(F.struct(F.lit(f.name).alias("column_name"), F.col(name).cast("string").alias("raw_value"), reason.alias("reason")))
    # The array of cells is interpreted row by row (a lambda), so only faulty rows come to it.
    faulty = reduce(lambda a, b: a | b, faults, F.lit(False))
    tag = F.lit(source).alias("source")
    valid = df.where(~faulty).select(*values, tag)
    bad = F.filter(F.array(*cells), lambda cell: cell["reason"].isNotNull())
    order_id = next(v for f, v in zip(ORDER_DETAILS.fields, values, strict=True) if f.name == "order_id")
    rejects = df.where(faulty).select(tag, order_id, F.inline(bad))
    return Split(valid, rejects)


def split_channels(feeds: dict[str, tuple[DataFrame, Feed]]) -> Split:
    """All feeds: unified rows without a bad cell, and (source, order_id, column_name, raw_value, reason)
    of every bad cell. A row is in exactly one of the two; nothing is shuffled."""
    parts = [split_feed(df, feed, source) for source, (df, feed) in feeds.items()]
    valid = reduce(lambda a, b: a.unionByName(b), [p.valid for p in parts])
    return Split(valid, reduce(lambda a, b: a.unionByName(b), [p.rejects for p in parts]))
