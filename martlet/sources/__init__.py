"""Readers: the given Parquet tables and the frames derived from them."""

from martlet.sources.order_details import order_details
from martlet.sources.shop_orders import raw_order_items, raw_order_items_corrected, raw_order_items_edited
from martlet.sources.tables import TABLES, read_table

__all__ = ["TABLES", "order_details", "raw_order_items", "raw_order_items_corrected", "raw_order_items_edited", "read_table"]
