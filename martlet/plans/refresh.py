"""Marts that follow a load: only what a merge touched is computed again.

``publish`` writes the sales lines of the fact, two aggregates (the daily grain
and the monthly product totals) and three marts (P1, P5, P6), each by order
month. ``refresh`` takes a merge plan and brings them up to date:

1. The merge's updated rows, before and after, and its inserts name the touched
   lines. Their months are the touched months.
2. The stored lines of those months, without the touched ones, and the new
   lines replace the months' lines; aggregates and channel economics of those
   months are computed from them. Lines of other months are not read.
3. A mart with a lag reaches further: a touched row changes the rows up to
   ``lag`` places on in its series, in whatever month they are. Those months are
   found on the aggregates and rewritten from them. Ranks stay in their month.

Months are replaced by dynamic partition overwrite. Lines, aggregates and marts
are all derived from the fact: if a run dies while months are replaced,
``publish`` writes them anew. Lists of months are brought to the driver, one
entry for each month of the calendar at most.

Defined cases: rows without an order date are in no mart; a repeated detail id
takes all its rows along; rows without a detail id can only be added; a merge
that changes nothing rewrites nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.functions.calendar import DateLike, month_start, year_month
from martlet.operators._common import day_col, order_lines
from martlet.operators.channels import channel_performance
from martlet.operators.daily_sales import DIRECT, SERIES, SERIES_ORDER, daily_grain, with_lag
from martlet.operators.merge import MergePlan
from martlet.operators.products import performance, product_monthly
from martlet.plans.marts import MONTH
from martlet.schemas import MONEY
from martlet.session import checkpoint_dir

LINES, DAILY, PRODUCTS = "lines", "daily_grain", "product_monthly"
#: Marts with a lag; channel economics follow from the touched months alone.
LAGGED = ("daily_sales", "product_performance")
PRODUCT_SERIES, PRODUCT_ORDER = ("product_sku",), ("_month", "product_name")
#: Folder of lines without an order date.
NO_MONTH = "none"
#: Financial status of lines that are no sale.
RETURNED = "refunded"
LAG_ROWS = 30


def _exact(c: str) -> Column:
    """A money column at two places; more places raise instead of being rounded."""
    short = F.col(c).cast(MONEY)
    wrong = F.raise_error(F.concat(F.lit(f"{c} has more than two decimal places: "), F.col(c).cast("string")))
    return F.when(F.col(c).isNull() | (short == F.col(c)), short).otherwise(wrong.cast(MONEY))


def sales_lines(fact: DataFrame) -> DataFrame:
    """Rows of the order fact as sales lines, with their ``detail_id``."""
    nothing = F.lit(0).cast(MONEY)
    return fact.select(
        "detail_id",
        "order_id",
        "customer_id",
        F.to_date("order_date").alias("order_date"),
        F.when(F.col("financial_status") == RETURNED, "return").otherwise("order").alias("transaction_type"),
        F.col("product_key").alias("product_sku"),
        "product_name",
        "marketing_channel",
        F.col("partner").alias("partner_name"),
        F.lit(1).cast("bigint").alias("adjusted_quantity"),
        _exact("price").alias("unit_price"),
        _exact("price").alias("line_revenue"),
        _exact("total_discount").alias("line_discount"),
        _exact("cost").alias("cost"),
        nothing.alias("allocated_shipping"),
        nothing.alias("allocated_duties"),
    )


def reached(rows: DataFrame, cells: DataFrame, series: Sequence[str], order: Sequence[str], places: int) -> DataFrame:
    """The ``rows`` that lie at or up to ``places`` rows after a cell of their series, whether or not the cell has a row."""
    marks = cells.select(*series, *order).distinct().withColumn("_real", F.lit(0))
    both = rows.withColumn("_real", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    w = Window.partitionBy(*series).orderBy(*order, "_real").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = both.withColumn("_place", F.sum("_real").over(w))
    placed = placed.withColumn("_cell", F.max(F.when(F.col("_real") == 0, F.col("_place"))).over(w))
    near = placed.where((F.col("_real") == 1) & (F.col("_place") - F.col("_cell") <= places + 1))
    return near.select(*rows.columns)


class Published:
    """The published tables under one folder, for one reporting period."""

    def __init__(self, spark: SparkSession, root: str, start: DateLike, end: DateLike, lag_rows: int = LAG_ROWS):
        self.spark, self.root = spark, root.rstrip("/")
        self.start, self.end, self.lag_rows = start, end, lag_rows

    def _stored(self, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        schema = [f if f.name != MONTH else T.StructField(MONTH, T.StringType()) for f in self.spark.read.parquet(path).schema]
        return self.spark.read.schema(T.StructType(schema)).parquet(path)

    def read(self, name: str, months: list[str] | None = None) -> DataFrame:
        """A published table; of the given ``months``, only their folders are read."""
        table = self._stored(name)
        return (table if months is None else table.where(F.col(MONTH).isin(months))).drop(MONTH)

    def _put(self, name: str, rows: DataFrame, month: Column) -> None:
        rows = rows.withColumn(MONTH, F.coalesce(month, F.lit(NO_MONTH))).hint("rebalance", MONTH)
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(MONTH).parquet(f"{self.root}/{name}")

    def _put_aggregates(self, lines: DataFrame) -> None:
        self._put(DAILY, daily_grain(lines, self.start, self.end), F.col("year_month"))
        self._put(PRODUCTS, product_monthly(lines, self.start, self.end), year_month(F.col("_month")))
        self._put("channel_performance", channel_performance(lines, self.start, self.end), F.col("year_month"))

    def _put_lagged(self, name: str, months: list[str] | None) -> None:
        """P1 or P5 of the given months, from the aggregate up to the last of them."""
        base = self._stored(DAILY if name == "daily_sales" else PRODUCTS)
        base = (base if months is None else base.where(F.col(MONTH) <= max(months))).drop(MONTH)
        rows = with_lag(base, self.lag_rows) if name == "daily_sales" else performance(base)
        self._put(name, rows if months is None else rows.where(F.col("year_month").isin(months)), F.col("year_month"))

    def publish(self, fact: DataFrame, marts: Sequence[str] = LAGGED) -> None:
        """Write everything from the whole fact."""
        self._put(LINES, sales_lines(fact), year_month(F.col("order_date")))
        self._put_aggregates(self.read(LINES))
        for name in marts:
            self._put_lagged(name, None)

    def refresh(self, fact: DataFrame, plan: MergePlan, marts: Sequence[str] = LAGGED) -> dict[str, list[str]]:
        """Bring the tables up to date with ``plan``, a merge into ``fact`` (the fact before it).

        Gives the months rewritten, for each table.
        """
        # The merge runs once: its pieces and the rows it touches are read by every step below.
        checkpoint_dir(self.spark)
        plan = replace(plan, updates=plan.updates.checkpoint(), inserts=plan.inserts.checkpoint())
        hit = plan.updates.select("detail_id").distinct()
        before = fact.join(hit, "detail_id", "left_semi").checkpoint()
        new = sales_lines(plan.apply(before))
        touched = sales_lines(before).unionByName(new)
        months = _months(touched.select(year_month(F.col("order_date")).alias("m")))
        if not months:
            return {}
        kept = self.read(LINES, months).join(hit, "detail_id", "left_anti")
        self._put(LINES, kept.select(*new.columns).unionByName(new), year_month(F.col("order_date")))
        lines = self.read(LINES, months)
        self._put_aggregates(lines)
        done = dict.fromkeys((LINES, DAILY, PRODUCTS, "channel_performance"), months)

        cells = order_lines(touched, self.start, self.end)
        cells = cells.withColumns({"partner_name": F.coalesce("partner_name", F.lit(DIRECT)), "_month": month_start(day_col(cells))})
        for name in marts:
            if name == "daily_sales":
                rows = self.read(DAILY).select(*SERIES, *SERIES_ORDER)
                near = reached(rows, cells, SERIES, SERIES_ORDER, self.lag_rows).select(year_month(F.col("order_date")).alias("m"))
            else:
                rows = self.read(PRODUCTS).select(*PRODUCT_SERIES, *PRODUCT_ORDER)
                near = reached(rows, cells, PRODUCT_SERIES, PRODUCT_ORDER, 1).select(year_month(F.col("_month")).alias("m"))
            done[name] = sorted({*months, *_months(near)})
            self._put_lagged(name, done[name])
        return done


def _months(found: DataFrame) -> list[str]:
    """The distinct months of a column ``m``: at most those of the calendar."""
    return sorted(r["m"] for r in found.select(F.coalesce("m", F.lit(NO_MONTH)).alias("m")).distinct().collect())
