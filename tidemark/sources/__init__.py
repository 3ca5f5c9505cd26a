"""Inputs: parquet readers, the adapter from the driver's TPC-H-style tables
to the three raw business feeds, and the cleaning rules (A1-A8)."""

from tidemark.sources.tables import read_table
from tidemark.sources.adapter import invoices_raw, orders_raw, backorders_raw, raw_feeds, rows_in
from tidemark.sources.clean import (
    clean_invoices, sign_invoices, clean_orders, type_orders, clean_backorders,
)

__all__ = [
    "read_table", "invoices_raw", "orders_raw", "backorders_raw", "raw_feeds", "rows_in",
    "clean_invoices", "sign_invoices", "clean_orders", "type_orders", "clean_backorders",
]
