"""Per-line measures and BigQuery-NUMERIC-faithful ratios.

Line shorthand (per row of ``order_details``):
    net  = line_revenue - line_discount
    gp   = net - cost * adjusted_quantity
    cp   = gp - allocated_shipping - allocated_duties

A NULL operand nulls that row's term and SUM skips it, as in SQL.

Money must be declared as decimals; floating point is refused. Columns of two
decimal places or fewer are summed as integer cents, which is exact, runs on
longs inside generated code and keeps decimals out of the shuffle. Columns
with more places are summed as decimals at their own scale. Either way nothing
is rounded before the final ROUND, and an overflow raises under ANSI mode.

Ratios follow NUMERIC: the quotient is taken at scale 9 (rounded half away
from zero), multiplied exactly, then rounded. ``try_divide`` gives NULL on a
zero denominator, like SAFE_DIVIDE; plain ``/`` raises under ANSI mode.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY_COLUMNS = ("unit_price", "line_revenue", "line_discount", "cost", "allocated_shipping", "allocated_duties")
CENT_SCALE = 2
#: Largest scale of a money column (that of NUMERIC).
MAX_SCALE = 9
# A ratio's operands as whole billionths: the quotient of two of them has scale 9.
UNITS = "decimal(29,0)"
QUOTIENT = "decimal(28,9)"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_scale(df: DataFrame) -> int:
    """Largest scale of the money columns of ``df``; raises on a column that is no exact decimal."""
    scale = 0
    for f in df.schema.fields:
        if f.name not in MONEY_COLUMNS:
            continue
        if isinstance(f.dataType, T.DecimalType):
            scale = max(scale, f.dataType.scale)
        elif not isinstance(f.dataType, T.IntegralType):
            raise TypeError(f"money column {f.name!r} is {f.dataType.simpleString()}; declare it as a decimal")
    if scale > MAX_SCALE:
        raise TypeError(f"money columns have {scale} decimal places; at most {MAX_SCALE} are supported")
    return scale


class Lines:
    """Exact money expressions over the columns that ``df`` has.

    Terms (``net``, ``gross_profit``, ...) are per-row values in the unit the
    sums use; ``total`` and ``mean`` are aggregates that give decimals.
    """

    def __init__(self, df: DataFrame):
        self.scale = money_scale(df)
        self.in_cents = self.scale <= CENT_SCALE

    def amount(self, c: str) -> Column:
        if self.in_cents:
            return (F.col(c) * F.lit(100)).cast("bigint")
        return F.col(c).cast(f"decimal(27,{self.scale})")

    def times_quantity(self, c: str) -> Column:
        quantity = F.col("adjusted_quantity")
        if self.in_cents:
            return self.amount(c) * quantity
        # decimal(27,s) x decimal(10,0) is decimal(38,s): no digit is lost.
        return (self.amount(c) * quantity.cast("decimal(10,0)")).cast(f"decimal(36,{self.scale})")

    @property
    def net(self) -> Column:
        return self.amount("line_revenue") - self.amount("line_discount")

    @property
    def product_cost(self) -> Column:
        return self.times_quantity("cost")

    @property
    def gross_profit(self) -> Column:
        return self._minus(self.net, self.product_cost)

    @property
    def contribution_profit(self) -> Column:
        charges = self._minus(self.gross_profit, self.amount("allocated_shipping"))
        return self._minus(charges, self.amount("allocated_duties"))

    def _minus(self, a: Column, b: Column) -> Column:
        # Kept at 36 digits, so that the type of the next difference loses no places.
        return a - b if self.in_cents else (a - b).cast(f"decimal(36,{self.scale})")

    def units(self, term: Column) -> Column:
        """SUM in the unit of the terms, for a second level of summing (aggregate)."""
        return F.sum(term)

    def value(self, total: Column | str) -> Column:
        """A sum of ``units`` as a decimal."""
        total = _c(total)
        exact = total.cast("decimal(36,0)") * F.lit(Decimal("0.01")) if self.in_cents else total
        return exact.cast(f"decimal(38,{max(CENT_SCALE, self.scale)})")

    def total(self, term: Column) -> Column:
        """SUM of a term as a decimal (aggregate)."""
        return self.value(F.sum(term))

    def mean(self, c: str) -> Column:
        """AVG of a money column at NUMERIC scale 9 (aggregate)."""
        return _mean(self.total(self.amount(c)), F.count(F.col(c)))


def _mean(total: Column, n: Column) -> Column:
    # decimal(38,9) over decimal(20,0) keeps scale 9; the built-in avg would round at 6 places first.
    return F.try_divide(total.cast("decimal(38,9)"), n.cast("decimal(20,0)")).cast("decimal(38,9)")


def numeric_avg(c: Column | str) -> Column:
    """AVG of a decimal at NUMERIC scale 9 (aggregate)."""
    col = _c(c)
    return _mean(F.sum(col.cast("decimal(38,9)")), F.count(col))


def money(c: Column | str, scale: int = 2) -> Column:
    """ROUND(x, scale) as a fixed ``decimal(38, scale)``."""
    return F.round(_c(c), scale).cast(f"decimal(38,{scale})")


def _billionths(c: Column | str) -> Column:
    return (_c(c).cast("decimal(29,9)") * F.lit(Decimal(10**9))).cast(UNITS)


def numeric_quotient(a: Column | str, b: Column | str) -> Column:
    """SAFE_DIVIDE at NUMERIC scale 9; NULL when ``b`` is zero or NULL."""
    return F.try_divide(_billionths(a), _billionths(b)).cast(QUOTIENT)


def safe_pct(a: Column | str, b: Column | str, scale: int = 2) -> Column:
    """ROUND(SAFE_DIVIDE(a, b) * 100, scale)."""
    return money(unrounded_pct(a, b), scale)


def unrounded_pct(a: Column | str, b: Column | str) -> Column:
    """SAFE_DIVIDE(a, b) * 100 at scale 9 (rounded later by the caller)."""
    return numeric_quotient(a, b) * F.lit(100).cast("decimal(3,0)")


def safe_ratio(a: Column | str, b: Column | str, scale: int = 2) -> Column:
    """ROUND(SAFE_DIVIDE(a, b), scale)."""
    return money(numeric_quotient(a, b), scale)
