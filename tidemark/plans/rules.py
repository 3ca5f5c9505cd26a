""""Churned now" business rule (H4-H6): no purchase for 90 days, 120 when
in renewal grace.  ``today`` is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.params import DATE_COL, ScoreParams

# Business-rule texts.
GRACE_EXCEEDED = "No purchases for {days} days; Grace period exceeded"
NO_PURCHASES = "No purchases for {days} days"
IN_GRACE = "In renewal grace period (extra 30 days)"
RECENT = "Recent purchase within last 90 days"
WITHIN = "Within adjusted threshold"


def _days_text(template: str, days: Column) -> Column:
    head, tail = template.split("{days}")
    return F.concat(F.lit(head), days.cast("string"), F.lit(tail))


def business_rule(df: DataFrame, today, params: ScoreParams = ScoreParams()) -> DataFrame:
    d = F.col(DATE_COL).try_cast("date")   # a bad date counts as missing
    since = F.when(d.isNull(), F.lit(None)).otherwise(
        F.greatest(F.datediff(F.lit(str(today)).cast("date"), d), F.lit(0)))
    grace = F.coalesce(F.col("in_renewal_grace").cast("double") != 0, F.lit(False))
    thr = F.lit(params.business_days) + F.when(grace, F.lit(params.business_grace_days)).otherwise(0)
    df = df.withColumns({
        "days_since_last_purchase_today": since,
        "_grace": grace, "_thr": thr,
    })
    now = F.coalesce(F.col("days_since_last_purchase_today") >= F.col("_thr"), F.lit(False))
    days = F.coalesce(F.col("days_since_last_purchase_today"), F.lit(0))
    reason = (
        F.when(now & F.col("_grace") & (F.col("_thr") > params.business_days),
               _days_text(GRACE_EXCEEDED, days))
        .when(now, _days_text(NO_PURCHASES, days))
        .when(F.col("_grace") & (days < F.col("_thr")), F.lit(IN_GRACE))
        .when(days < params.business_days, F.lit(RECENT))
        .otherwise(F.lit(WITHIN))
    )
    return (df.withColumns({"business_churn_now": F.when(now, 1).otherwise(0),
                            "business_churn_reason": reason})
            .drop("_grace", "_thr"))
