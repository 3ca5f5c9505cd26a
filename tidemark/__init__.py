"""tidemark — customer purchase-cadence and churn analytics on Spark.

Stage 1 (``operators``) turns raw invoices, order intake and backorders into
one snapshot row per customer and active month.  Stage 2 (``plans``) keeps
the latest snapshot per customer, fits a class-balanced logistic regression
with Spark ML, explains each score and shapes the prediction report.

Everything is DataFrame / Spark SQL expressions; there are no Python UDFs.
"""

from tidemark.params import CadenceParams, ScoreParams

__all__ = ["CadenceParams", "ScoreParams"]
