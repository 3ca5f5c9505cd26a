"""Hand-made raw feeds for edge-case tests (FIXTURES.md section 4)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import types as T

INV_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("billing_date", T.DateType()),
    T.StructField("posting_date", T.DateType()), T.StructField("net_value", T.StringType()),
    T.StructField("sign_col", T.StringType()), T.StructField("doc_cancelled", T.StringType()),
    T.StructField("cancelled_billing_doc", T.IntegerType()), T.StructField("sales_org", T.StringType()),
])
ORD_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()), T.StructField("creation_date", T.DateType()),
    T.StructField("order_num", T.StringType()), T.StructField("pay_terms", T.StringType()),
    T.StructField("contract_start", T.DateType()), T.StructField("contract_end", T.DateType()),
    T.StructField("planned_revenue", T.StringType()), T.StructField("reject_code", T.StringType()),
    T.StructField("company", T.StringType()),
])
BO_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType()), T.StructField("creation_date", T.DateType()),
    T.StructField("qty_outstanding", T.StringType()), T.StructField("reject_code", T.StringType()),
    T.StructField("company", T.StringType()),
])


def d(s: str) -> dt.date:
    return dt.date.fromisoformat(s)


def inv(cust, date, amount, sign=" ", posting=None, cancelled="", cancel_doc=0, org="US01"):
    return (cust, d(date), d(posting) if posting else None, str(amount), sign, cancelled,
            cancel_doc, org)


def order(cust, date, num="1234567", terms=None, start=None, end=None, rev="0", reject="",
          company="US01"):
    return (str(cust), d(date), num, terms, d(start) if start else None, d(end) if end else None,
            rev, reject, company)


def backorder(cust, date, qty, reject="Z1", company="US01"):
    return (str(cust), d(date), str(qty), reject, company)


def feeds(spark, invoices=(), orders=(), backorders=()):
    return (spark.createDataFrame(list(invoices), INV_SCHEMA),
            spark.createDataFrame(list(orders), ORD_SCHEMA),
            spark.createDataFrame(list(backorders), BO_SCHEMA))


def spine_rows(spark, invoices=(), orders=(), backorders=(), params=None):
    """All spine rows with derived columns, keyed by (customer_id, t0 iso)."""
    from tidemark.operators import snapshot as snap
    from tidemark.params import CadenceParams
    p = params or CadenceParams()
    inputs = snap.clean_inputs(*feeds(spark, invoices, orders, backorders), params=p)
    rows = snap.derive(snap.spine_features(inputs, p), p).collect()
    return {(r["customer_id"], r["t0"].isoformat()): r for r in rows}


def snapshot_rows(spark, invoices=(), orders=(), backorders=(), params=None):
    from tidemark.operators import snapshot as snap
    from tidemark.params import CadenceParams
    p = params or CadenceParams()
    inputs = snap.clean_inputs(*feeds(spark, invoices, orders, backorders), params=p)
    rows = snap.cadence_snapshot(snap.spine_features(inputs, p), p).collect()
    return {(r["customer_id"], r["t0"].isoformat()): r for r in rows}


DEC = Decimal
