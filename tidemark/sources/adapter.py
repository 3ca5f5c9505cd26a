"""Adapter: derive the three raw business feeds from the driver's tables.

The reference reads an ERP's billing, order-intake and backorder extracts.
The test data has TPC-H-style ``orders`` and ``lineitem`` instead, so each
feed is defined over them (see FIXTURES.md section 3).  The columns carry the
raw types of the source system (text amounts, text customer ids in two of
the feeds) so that every cleaning cast is exercised.

At scale the only heavy step is ``lineitem JOIN orders`` on the order key:
a sort-merge join that both sides shuffle on ``l_orderkey``/``o_orderkey``
(order keys are not skewed: a handful of lines per order).  AQE may turn it
into a broadcast at run time when the measured orders side is below the
broadcast threshold, which is a size-checked decision.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.tables import read_table


def invoices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"])
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    ship = F.col("l_shipdate").cast("date")
    return (
        li.join(od, li.l_orderkey == od.o_orderkey)
        .select(
            F.col("o_custkey").alias("customer_id"),
            ship.alias("billing_date"),
            F.when(F.col("l_linenumber") % 2 == 0, F.date_add(ship, 1)).alias("posting_date"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("net_value"),
            F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), F.lit("-"))
            .when(F.col("l_returnflag") == "A", F.lit("+"))
            .otherwise(F.lit(" ")).alias("sign_col"),
            F.when(F.col("l_suppkey") % 20 == 0, F.lit("X")).otherwise(F.lit("")).alias("doc_cancelled"),
            F.when(F.col("l_partkey") % 25 == 0, F.lit(1)).otherwise(F.lit(0)).alias("cancelled_billing_doc"),
            F.when(F.col("l_suppkey") % 10 == 1, F.lit("DE01")).otherwise(F.lit("US01")).alias("sales_org"),
        )
    )


def _order_common(od: DataFrame) -> dict:
    key = F.col("o_orderkey")
    return {
        "customer_id": F.col("o_custkey").cast("string"),
        "creation_date": F.col("o_orderdate").cast("date"),
        "reject_code": F.when(key % 11 == 0, F.lit("Z1")).otherwise(F.lit("")),
        "company": F.when(key % 13 == 0, F.lit("DE01")).otherwise(F.lit("US01")),
    }


def orders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = read_table(spark, sf_dir, "orders",
                    ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    key = F.col("o_orderkey")
    keytxt = key.cast("string")
    odate = F.col("o_orderdate").cast("date")
    c = _order_common(od)
    return od.select(
        c["customer_id"].alias("customer_id"),
        c["creation_date"].alias("creation_date"),
        F.when(key % 3 == 0, F.lpad(keytxt, 8, "0"))
        .when(key % 3 == 1, F.lpad(keytxt, 6, "0"))
        .otherwise(F.lpad(keytxt, 7, "0")).alias("order_num"),
        F.when(key % 7 == 0, F.lit("Monthly"))
        .when(key % 7 == 1, F.lit("Quarterly"))
        .when(key % 7 == 2, F.lit("Annual"))
        .when(key % 7 == 3, F.lit("Prepay"))
        .when(key % 7 == 4, F.lit("NET 90"))
        .when(key % 7 == 5, F.lit("Other")).alias("pay_terms"),
        F.when(key % 5 == 0, F.date_add(odate, 30)).alias("contract_start"),
        F.when(key % 5 == 0, F.date_add(odate, 365)).alias("contract_end"),
        F.concat(F.when(F.col("o_orderstatus") == "P", F.lit("")).otherwise(F.lit("-")),
                 F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("planned_revenue"),
        c["reject_code"].alias("reject_code"),
        c["company"].alias("company"),
    )


def backorders_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    od = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    c = _order_common(od)
    return od.select(
        c["customer_id"].alias("customer_id"),
        c["creation_date"].alias("creation_date"),
        (F.col("o_orderkey") % 50 + 1).cast("string").alias("qty_outstanding"),
        c["reject_code"].alias("reject_code"),
        c["company"].alias("company"),
    )


def rows_in(spark: SparkSession, sf_dir: str) -> int:
    """Rows of the tables behind the feeds, as the Parquet footers give them."""
    return sum(read_table(spark, sf_dir, name).count() for name in ("lineitem", "orders"))


def raw_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return invoices_raw(spark, sf_dir), orders_raw(spark, sf_dir), backorders_raw(spark, sf_dir)
