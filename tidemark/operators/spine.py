"""Snapshot spine (B1-B4): one row per (customer, month with activity)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(c: Column) -> Column:
    """B1: first day of the month, as a DATE (``trunc``; ``date_trunc``
    would return a timestamp)."""
    return F.trunc(c, "MM")


def spine_months(inv: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct (customer_id, t0) over invoices UNION orders.

    ``union().distinct()`` plans as one hash aggregate over both inputs with
    map-side partial de-duplication, so each map task ships at most one row
    per (customer, month) it has seen.
    """
    t0i = inv.select("customer_id", month_start(F.col("tx_date")).alias("t0"))
    t0o = orders.select("customer_id", month_start(F.col("order_date")).alias("t0"))
    return t0i.union(t0o).distinct()
