"""Declared table layouts (the reference uses fixed DDL, no inference).

DATETIME is zoneless, so it maps to ``timestamp_ntz``. Money of the load (raw,
staging, fact) is NUMERIC, ``decimal(38,9)``; the derived sales lines hold
``decimal(18,2)``. Readers select and cast to these and fail on a missing
column or on a cast that could round.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
NUMERIC = T.DecimalType(38, 9)
NTZ = T.TimestampNTZType()
S = T.StringType()


def _f(name: str, dtype: T.DataType, nullable: bool = True, doc: str | None = None) -> T.StructField:
    meta = {"comment": doc} if doc else {}
    return T.StructField(name, dtype, nullable, meta)


# Raw landing rows and the staging copy share one layout.
RAW_ORDER_ITEMS = T.StructType(
    [
        _f("id", S),
        _f("order_id", S),
        _f("order_number", S),
        _f("order_date", NTZ),
        _f("update_date", NTZ),
        _f("customer_id", S),
        _f("financial_status", S),
        _f("fulfillment_status", S),
        _f("discount_codes", S),
        _f("channel", S),
        _f("partner_name", S),
        _f("product_key", S),
        _f("product_name", S),
        _f("cost", NUMERIC),
        _f("price", NUMERIC),
        _f("total_discount", NUMERIC),
    ]
)
STAGED_ORDER_ITEMS = RAW_ORDER_ITEMS

# Fact / one-big-table: renamed business columns plus ETL stamps.
FACT_ORDER_DETAIL = T.StructType(
    [
        _f("detail_id", S),
        _f("order_id", S),
        _f("order_number", S),
        _f("order_date", NTZ),
        _f("update_date", NTZ),
        _f("customer_id", S),
        _f("financial_status", S),
        _f("fulfillment_status", S),
        _f("discount_code", S),
        _f("marketing_channel", S),
        _f("partner", S),
        _f("product_key", S),
        _f("product_name", S),
        _f("cost", NUMERIC),
        _f("price", NUMERIC),
        _f("total_discount", NUMERIC),
        _f("dt_insert", NTZ, doc="run clock of the insert; never changed afterwards"),
        _f("dt_update", NTZ, doc="run clock of the newest update, NULL until then"),
    ]
)

# Staging column -> fact column (all others keep their name).
STAGE_TO_FACT = {
    "id": "detail_id",
    "discount_codes": "discount_code",
    "channel": "marketing_channel",
    "partner_name": "partner",
}

LINEAGE = T.StructType(
    [
        _f("lineage_key", S, nullable=False, doc="UUID drawn for the run"),
        _f("data_load_started", NTZ, doc="clock at the run's start"),
        _f("src_table_name", S, doc="where the rows come from"),
        _f("tgt_table_name", S, doc="where the rows go"),
        _f("data_load_completed", NTZ, doc="clock at the run's end, NULL while open"),
        _f("was_successful", T.BooleanType(), doc="true once the run is closed"),
        _f("source_sys_cutoff_time", NTZ, doc="exclusive upper bound of the run's window"),
    ]
)

ETL_CUTOFF = T.StructType(
    [
        _f("src_table_name", S, doc="where the rows come from"),
        _f("tgt_table_name", S, doc="where the rows go"),
        _f("cutoff_time", NTZ, doc="newest update_date taken over so far, NULL before the first run"),
    ]
)

# Sales lines read by every reporting mart (no DDL in the reference; the
# union of the columns the marts read).
ORDER_DETAILS = T.StructType(
    [
        _f("order_id", S),
        _f("customer_id", T.LongType()),
        _f("order_date", T.DateType()),
        _f("transaction_type", S),
        _f("product_sku", S),
        _f("product_name", S),
        _f("marketing_channel", S),
        _f("partner_name", S),
        _f("adjusted_quantity", T.LongType()),
        _f("unit_price", MONEY),
        _f("line_revenue", MONEY),
        _f("line_discount", MONEY),
        _f("cost", MONEY),
        _f("allocated_shipping", MONEY),
        _f("allocated_duties", MONEY),
    ]
)


def _may_round(have: T.DataType, want: T.DataType) -> bool:
    if not isinstance(want, T.DecimalType):
        return False
    return isinstance(have, T.FractionalType) and not (isinstance(have, T.DecimalType) and have.scale <= want.scale)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order, cast to its types.

    A missing column raises (AnalysisException) instead of being invented; so
    does (TypeError) floating-point money, or money with more decimal places
    than the schema holds, which a cast would round without a word.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name in have and _may_round(have[f.name], f.dataType):
            raise TypeError(f"{f.name}: {have[f.name].simpleString()} does not fit {f.dataType.simpleString()} exactly")
    if [(f.name, f.dataType) for f in df.schema.fields] == [(f.name, f.dataType) for f in schema.fields]:
        return df
    cols: list[Column] = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols)


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
