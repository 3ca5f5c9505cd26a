"""Readers of the source system's text extracts.

An extract is a folder of CSV files with a header row.  Its layout is declared:
a file with other headers is an error, not a guess.  Every field is read as text
and converted by rule; a row that cannot be converted goes to the bad-record
table with its reason instead of ending the job, so

    rows read = kept + filtered + quarantined

holds for every run and ``audit`` counts the three by reason in one pass.  What
is quarantined here would have aborted the original's strict casts; fields that
it converts tolerantly (amounts, quantities, the customer of an order) stay text
and become NULL in the cleaning rules, as there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.params import CadenceParams
from tidemark.sources.clean import _blank, _in_codes, _try_cast

BAD = "_bad"
TEXT = ("string", "code")


@dataclass(frozen=True)
class Layout:
    """Headers of an extract in order, with the raw column and its type; ``code`` is
    text whose empty field is the blank code (other empty fields are missing)."""
    name: str
    fields: tuple[tuple[str, str, str], ...]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(h, T.StringType()) for h, _, _ in self.fields]
                            + [T.StructField(BAD, T.StringType())])


# Headers of the three extracts.
BILLING = Layout("billing", (
    ("Sold-To", "customer_id", "bigint"), ("Billing Date", "billing_date", "date"),
    ("Posting Date", "posting_date", "date"), ("Local Net Value", "net_value", "string"),
    ("+/-", "sign_col", "string"), ("Bill# Doc# Cancelled", "doc_cancelled", "code"),
    ("Cancelled Billing Doc#", "cancelled_billing_doc", "int"), ("Sales Org", "sales_org", "string")))
ORDERS = Layout("orders", (
    ("Sold To", "customer_id", "string"), ("Creation Date", "creation_date", "date"),
    ("Order Number", "order_num", "string"), ("Pay Terms", "pay_terms", "string"),
    ("Contract Item Start Date", "contract_start", "date"), ("Contract Item End Date", "contract_end", "date"),
    ("Planned Revenue Rep#Curr#", "planned_revenue", "string"),
    ("Reject Reason Code", "reject_code", "code"), ("Company", "company", "string")))
BACKORDERS = Layout("backorders", (
    ("Sold To", "customer_id", "string"), ("Creation Date", "creation_date", "date"),
    ("Qty OutStand", "qty_outstanding", "string"), ("Reject Reason Code", "reject_code", "code"),
    ("Company", "company", "string")))


def write_extract(raw: DataFrame, layout: Layout, path: str) -> None:
    """A raw feed (text or typed columns) as an extract."""
    (raw.select(*[F.col(c).cast("string").alias(h) for h, c, _ in layout.fields])
     .write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def _lines(spark: SparkSession, layout: Layout, path: str) -> DataFrame:
    """Text columns under their raw names, and why a row is bad (NULL: it is not)."""
    rows = (spark.read.schema(layout.schema).option("header", True).option("enforceSchema", False)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD)
            # a row is malformed or not whatever columns are asked for
            .option("columnPruning", False).csv(path))
    why = F.when(F.col(BAD).isNotNull(), F.lit("malformed row"))
    for header, column, kind in layout.fields:
        if kind not in TEXT:
            text = F.col(f"`{header}`")
            why = why.when(text.isNotNull() & _try_cast(F.trim(text), kind).isNull(),
                           F.lit(f"{column}: not a {kind}"))
    return rows.select(*[F.col(f"`{h}`").alias(c) for h, c, _ in layout.fields], BAD, why.alias("reason"))


def _typed(lines: DataFrame, layout: Layout) -> DataFrame:
    def value(column, kind):
        if kind == "code":
            return F.coalesce(F.col(column), F.lit("")).alias(column)
        return F.col(column) if kind == "string" else _try_cast(F.trim(F.col(column)), kind).alias(column)

    return lines.select(*[value(c, kind) for _, c, kind in layout.fields], "reason")


def read_extract(spark: SparkSession, layout: Layout, path: str) -> tuple[DataFrame, DataFrame]:
    """(raw feed for the cleaning rules, bad records: feed, reason, record)."""
    lines = _lines(spark, layout, path)
    feed = _typed(lines.filter("reason IS NULL"), layout).drop("reason")
    fields = F.to_json(F.struct(*[c for _, c, _ in layout.fields]))
    bad = lines.filter("reason IS NOT NULL").select(
        F.lit(layout.name).alias("feed"), "reason", F.coalesce(BAD, fields).alias("record"))
    return feed, bad


def _filters(layout: Layout, params: CadenceParams) -> list[tuple[str, Column]]:
    """Why a readable row is left out: (reason, what must hold), in order."""
    if layout is BILLING:
        return [("no billing date", F.col("billing_date").isNotNull()),
                ("cancelled billing document", F.col("cancelled_billing_doc") == 0),
                ("cancelled", _blank(F.col("doc_cancelled"))),
                ("other organisation", _in_codes(F.col("sales_org"), params.org_codes))]
    open_rows = params.orders_keep_rejected if layout is ORDERS else params.backorders_keep_rejected
    code = _blank(F.col("reject_code"))
    return [("no creation date", F.col("creation_date").isNotNull()),
            ("not rejected", ~code) if open_rows else ("rejected", code),
            ("other organisation", _in_codes(F.col("company"), params.org_codes)),
            ("no customer", _try_cast(F.col("customer_id"), "bigint").isNotNull())]


def audit(spark: SparkSession, layout: Layout, path: str, params: CadenceParams = CadenceParams()) -> DataFrame:
    """(feed, outcome, reason, n_rows): every row of the extract, counted once."""
    rows = _typed(_lines(spark, layout, path), layout)
    left = F.when(F.col("reason").isNotNull(), F.lit("quarantined"))
    why = F.when(F.col("reason").isNotNull(), F.col("reason"))
    for reason, holds in _filters(layout, params):
        gone = ~F.coalesce(holds, F.lit(False))
        left, why = left.when(gone, F.lit("filtered")), why.when(gone, F.lit(reason))
    return (rows.select(F.lit(layout.name).alias("feed"), left.otherwise("kept").alias("outcome"),
                        why.otherwise("").alias("reason"))
            .groupBy("feed", "outcome", "reason").agg(F.count(F.lit(1)).alias("n_rows")))
