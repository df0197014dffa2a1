"""A small landing set of our own for the incremental load.

24 orders of a tea shop over the first days of March 2031, two to six hours
apart. Every third order is touched again a day later, every fifth was entered
late (its update lies before its order), statuses and codes are NULL in turn.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from martlet.schemas import RAW_ORDER_ITEMS

ROWS = 24
START = dt.datetime(2031, 3, 1, 6, 30)
TEAS = (("T-10", "Assam", "3.125", "11.50"), ("T-20", "Sencha", "4.40", "14.90"), ("T-30", "Rooibos", "2.075", "9.25"))


def order_time(i: int) -> dt.datetime:
    return START + dt.timedelta(hours=4 * i + (i * i) % 3, minutes=7 * (i % 5))


def update_time(i: int) -> dt.datetime:
    at = order_time(i)
    if i % 3 == 2:
        return at + dt.timedelta(days=1, minutes=11)
    return at - dt.timedelta(hours=2) if i % 5 == 4 else at


def seed_rows() -> list[tuple]:
    rows = []
    for i in range(ROWS):
        key, name, cost, price = TEAS[i % 3]
        rows.append(
            (
                f"line-{i:03d}", f"ord-{i // 2:03d}", f"{7000 + i}", order_time(i), update_time(i), f"cust-{i % 7}",
                ("paid", "pending", None)[i % 3], "sent" if i % 4 == 0 else None, (None, "", "SPRING")[i % 3],
                ("web", "shop")[i % 2], None if i % 6 == 0 else f"partner {i % 4}", key, name,
                Decimal(cost), Decimal(price), Decimal(i % 4),
            )
        )
    return rows


def seed_df(spark):
    return spark.createDataFrame(seed_rows(), RAW_ORDER_ITEMS)


def updated_in(low: dt.datetime | None, high: dt.datetime) -> list[int]:
    """Numbers of the rows whose update lies in [low, high)."""
    return [i for i in range(ROWS) if (low is None or update_time(i) >= low) and update_time(i) < high]
