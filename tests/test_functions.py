"""Phrases, business rule and header functions on hand-made rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import headers as H
from tidemark.functions.phrases import phrase
from tidemark.params import ScoreParams
from tidemark.plans.rules import business_rule


def _phrase(spark, col, value, z, vtype="double"):
    if vtype.startswith("decimal") and value is not None:
        value = Decimal(value)
    df = spark.createDataFrame([(value, float(z))], f"v {vtype}, z double")
    return df.select(phrase(col, F.col("v"), F.col("z"))).first()[0]


def test_phrases(spark):
    assert _phrase(spark, "recency_days", 56, 1.0, "int") == "No purchases for 56 days"
    assert _phrase(spark, "recency_days", None, 1.0, "int") == "No purchases for"
    assert _phrase(spark, "recency_days", 56, -1.0, "int") == ""
    assert _phrase(spark, "credit_notes_90d", 1234, 0.5, "bigint") == "Credit notes in last 90 days (1,234)"
    assert _phrase(spark, "backorder_qty_30d", 2.5, 0.5) == "Backorder quantity in last 30 days (2)"
    assert _phrase(spark, "credit_notes_ma3", 1 / 3, 0.5) == \
        "Credit notes per month (3-month average) (0.33 per month)"
    assert _phrase(spark, "pct_change_3m", -0.4567, 0.5) == "Change vs prior 3 months (-0.5%)"
    assert _phrase(spark, "pct_change_3m", 0.4, -0.5) == ""
    assert _phrase(spark, "rev_returns_90d", "12345.60", 0.5, "decimal(18,2)") == \
        "Returns value in last 90 days ($12,345.60)"
    assert _phrase(spark, "rev_180d", "-69016.60", -0.5, "decimal(18,2)") == \
        "Low recent revenue (-$69,016.60)"
    assert _phrase(spark, "rev_180d", "10.00", 0.5, "decimal(18,2)") == ""
    assert _phrase(spark, "invoices_pos_prev_month", 0, -1.0, "int") == "Few invoices in last 90 days (0)"
    assert _phrase(spark, "orders_pos_30d", "0.00", -1.0, "decimal(18,2)") == \
        "Low positive order value (last 30 days) ($0.00)"
    assert _phrase(spark, "mitigator_component", 0.0, -1.0) == "Few mitigating signals"
    assert _phrase(spark, "lateness_component", 0.9, 1.0) == "Late purchase signal"
    assert _phrase(spark, "cv_gap", 0.37, 1.0) == "Irregular buying cadence (0)"
    assert _phrase(spark, "cv_gap", 2.5, 1.0) == "Irregular buying cadence (2.50)"
    assert _phrase(spark, "severity_score", 1234.6, 1.0) == "Issue severity score (1,235)"
    assert _phrase(spark, "is_maintenance_heavy", 1, -1.0, "int") == "Maintenance‑heavy profile"
    assert _phrase(spark, "is_maintenance_heavy", 0, 1.0, "int") == ""
    assert _phrase(spark, "in_renewal_grace", None, 1.0, "int") == "In renewal grace period"
    assert _phrase(spark, "threshold_days", 11999, 1.0, "int") == \
        "Days past expected purchase threshold (11999 days)"


def test_business_rule(spark):
    rows = [(1, "2021-01-01", 0, "2021-03-31"), (2, "2021-01-01", 0, "2021-04-01"),
            (3, "2021-01-01", 1, "2021-04-30"), (4, "2021-01-01", 1, "2021-05-01"),
            (5, "2021-06-01", 0, "2021-05-01"), (6, None, 1, "2021-05-01"),
            (7, "2021-01-01", None, "2021-04-15")]
    out = {}
    for cust, date, grace, today in rows:
        df = spark.createDataFrame([(cust, date, grace)], "customer_id int, as_of_date string, in_renewal_grace int")
        r = business_rule(df, dt.date.fromisoformat(today), ScoreParams()).first()
        out[cust] = (r.days_since_last_purchase_today, r.business_churn_now, r.business_churn_reason)
    assert out[1] == (89, 0, "Recent purchase within last 90 days")
    assert out[2] == (90, 1, "No purchases for 90 days")
    assert out[3] == (119, 0, "In renewal grace period (extra 30 days)")
    assert out[4] == (120, 1, "No purchases for 120 days; Grace period exceeded")
    assert out[5] == (0, 0, "Recent purchase within last 90 days")
    assert out[6] == (None, 0, "In renewal grace period (extra 30 days)")
    assert out[7] == (104, 1, "No purchases for 104 days")


def test_header_functions():
    assert H.to_pascal("CreatedOn") == "Createdon"
    assert H.to_pascal("Churn Probability % (Next 90 Days)") == "ChurnProbabilityPctNext90Days"
    assert H.to_pascal("actual_churned_90d_t0+90d") == "ActualChurned90dT090d"
    assert H.sanitize("Why (Business Rule)") == "why_business_rule"
    assert H.sanitize("actual_churned_90d_t0+90d") == "actual_churned_90d_t0plus90d"
    assert H.table_names(["CustomerId", "Why"]) == {"CustomerId": "CustomerId", "Why": "Why"}
    assert H.table_names(["Customer ID", "x"])["Customer ID"] == "customer_id"
    assert H.ordered_columns(["b", "x", "a"], ["a", "b", "c"]) == ["a", "b", "x"]
