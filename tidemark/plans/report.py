"""Prediction report shaping and sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import headers as H
from tidemark.params import CUSTOMER_ID_COL, DATE_COL

PREDICTION_COLUMNS = [
    CUSTOMER_ID_COL, "predicted_churn_90d", "predicted_churn_probability_90d",
    "predicted_churn_probability_90d_pct", DATE_COL, "predicted_churn_reason_90d",
    "actual_churned_90d", "actual_churn_reason_90d",
    "days_since_last_purchase_today", "business_churn_now", "business_churn_reason",
]


def shape(df: DataFrame, headers: str = "friendly", created_on: dt.datetime | None = None) -> DataFrame:
    """I1 timeframe renames, I2 header style and order, I5 CreatedOn stamp,
    I3 PascalCase names."""
    df = df.select(*[c for c in PREDICTION_COLUMNS if c in df.columns])
    df = df.withColumnsRenamed({k: v for k, v in H.TIMEFRAME_RENAMES.items() if k in df.columns})
    if headers == "friendly":
        df = df.withColumnsRenamed({k: v for k, v in H.FRIENDLY_HEADERS.items() if k in df.columns})
        df = df.select(*[F.col(f"`{c}`") for c in H.ordered_columns(df.columns, H.FRIENDLY_ORDER)])
    elif headers == "technical":
        df = df.select(*[F.col(f"`{c}`") for c in H.ordered_columns(df.columns, H.TECHNICAL_ORDER)])
    else:
        raise ValueError("headers must be 'friendly' or 'technical'")
    stamp = (created_on or dt.datetime.now()).replace(microsecond=0)
    df = df.withColumn("CreatedOn", F.lit(stamp).cast("timestamp"))
    return df.toDF(*[H.to_pascal(c) for c in df.columns])


def to_table(report: DataFrame) -> DataFrame:
    """I4 + I6: the declared table schema gives names and types (its 'CreatedOn'
    where the CSV says 'Createdon'); columns it does not declare get their I4 name
    and the type that their header or Spark type implies."""
    declared = {f.name.lower(): f for f in H.PREDICTIONS_TABLE_SCHEMA.fields}
    names = H.table_names(report.columns)
    kinds = {f.name: f.dataType for f in report.schema}

    def column(name: str):
        known = declared.get(name.lower())
        source = F.col(f"`{name}`")
        if known:
            return source.cast(known.dataType).alias(known.name)
        return source.cast(H.inferred_type(name, kinds[name])).alias(names[name])

    return report.select(*map(column, report.columns))


_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def write_csv(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """I8: CSV with a header row, written in parallel (one file per task)."""
    report.write.mode(mode).option("header", True).csv(path)


def write_table(report: DataFrame, table: str, if_exists: str = "replace",
                fmt: str = "parquet") -> None:
    """Append / replace (default) / fail."""
    if if_exists not in _MODES:
        raise ValueError(f"if_exists must be one of {sorted(_MODES)}")
    to_table(report).write.mode(_MODES[if_exists]).format(fmt).saveAsTable(table)
