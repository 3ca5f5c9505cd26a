"""Cleaning rules for the three raw feeds.

Text comparisons follow the source database's rule that trailing blanks do
not count (``'X  ' = 'X'``), hence the ``rtrim`` before every equality test
on a code column.  Strict casts (``cast``) abort on bad input exactly as the
reference's CAST does (ANSI mode); safe casts (``try_cast``) turn bad text
into NULL as its TRY_CONVERT does.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.params import CadenceParams


def _blank(c: Column) -> Column:
    """Equality with '' under trailing-blank rules; NULL stays NULL (dropped by filter)."""
    return F.rtrim(c) == F.lit("")


def _in_codes(c: Column, codes: Iterable[str]) -> Column:
    return F.rtrim(c).isin(list(codes))


def _try_cast(c: Column, type_name: str) -> Column:
    return c.try_cast(type_name)


def clean_invoices(raw: DataFrame, params: CadenceParams = CadenceParams()) -> DataFrame:
    """Keep posted, uncancelled billing lines of the chosen orgs."""
    tx = F.coalesce(F.col("posting_date"), F.col("billing_date"))
    return (
        raw.filter(
            F.col("billing_date").isNotNull()
            & (F.col("cancelled_billing_doc") == 0)
            & _blank(F.col("doc_cancelled"))
            & tx.isNotNull()
            & _in_codes(F.col("sales_org"), params.org_codes)
        )
        .select(
            F.col("customer_id").cast("bigint").alias("customer_id"),
            tx.cast("date").alias("tx_date"),
            _try_cast(F.col("net_value"), "decimal(18,2)").alias("amt_local"),
            F.nullif(F.trim(F.col("sign_col")), F.lit("")).alias("sign_col"),
            F.coalesce(F.col("doc_cancelled"), F.lit("")).alias("cancel_flag"),
        )
    )


def sign_invoices(inv: DataFrame) -> DataFrame:
    """A3: apply the +/- sign column to the amount ('-' forces negative,
    '+' forces positive, anything else keeps the stored sign)."""
    amt = F.col("amt_local")
    signed = (
        F.when(F.col("sign_col") == "-", -F.abs(amt))
        .when(F.col("sign_col") == "+", F.abs(amt))
        .otherwise(amt)
    )
    return inv.select("customer_id", "tx_date",
                      signed.cast("decimal(18,2)").alias("amt_local_signed"))


def clean_orders(raw: DataFrame, params: CadenceParams = CadenceParams()) -> DataFrame:
    """A4/A5: order intake lines; planned revenue text -> decimal with the
    sign flipped (sales are stored negative in the source)."""
    reject_ok = (~_blank(F.col("reject_code")) if params.orders_keep_rejected
                 else _blank(F.col("reject_code")))
    cust = _try_cast(F.col("customer_id"), "bigint")
    return (
        raw.filter(F.col("creation_date").isNotNull() & reject_ok
                   & _in_codes(F.col("company"), params.org_codes))
        .select(
            cust.alias("customer_id"),
            F.col("creation_date").cast("date").alias("order_date"),
            F.col("order_num"),
            F.length(F.rtrim(F.col("order_num"))).alias("order_num_len"),
            F.col("pay_terms"),
            F.col("contract_start").cast("date").alias("contract_start"),
            F.col("contract_end").cast("date").alias("contract_end"),
            (-_try_cast(F.regexp_replace(F.col("planned_revenue"), ",", ""), "decimal(18,2)"))
            .alias("planned_revenue"),
        )
        # A NULL customer id can never match a spine row (T20); drop it early.
        .filter(F.col("customer_id").isNotNull())
    )


def type_orders(orders: DataFrame) -> DataFrame:
    """Order-number length 6 = technical order, 8 = maintenance order."""
    return orders.withColumns({
        "is_tech": F.when(F.col("order_num_len") == 6, 1).otherwise(0),
        "is_maint": F.when(F.col("order_num_len") == 8, 1).otherwise(0),
    })


def clean_backorders(raw: DataFrame, params: CadenceParams = CadenceParams()) -> DataFrame:
    """Outstanding backorder lines with quantity text -> double."""
    reject_ok = (~_blank(F.col("reject_code")) if params.backorders_keep_rejected
                 else _blank(F.col("reject_code")))
    return (
        raw.filter(F.col("creation_date").isNotNull() & reject_ok
                   & _in_codes(F.col("company"), params.org_codes))
        .select(
            _try_cast(F.col("customer_id"), "bigint").alias("customer_id"),
            F.col("creation_date").cast("date").alias("bo_date"),
            _try_cast(F.regexp_replace(F.col("qty_outstanding"), ",", ""), "double").alias("qty"),
        )
        .filter(F.col("customer_id").isNotNull())
    )
