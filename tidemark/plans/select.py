"""Feature selection from the snapshot."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.params import CUSTOMER_ID_COL, DATE_COL, FEATURE_COLUMNS


def feature_frame(snapshot: DataFrame, target_col: str | None = "churned_hard90",
                  run_date: dt.date | str | None = None,
                  feature_cols: list[str] | tuple[str, ...] = tuple(FEATURE_COLUMNS)) -> DataFrame:
    """customer_id, as_of_date (yyyy-MM-dd text; a missing t0 falls back
    to the run date), the features and the label.  Only these columns reach
    the scan (column pruning)."""
    run = F.lit(str(run_date)).cast("date") if run_date is not None else F.current_date()
    cols = [F.col(CUSTOMER_ID_COL),
            F.coalesce(F.date_format("t0", "yyyy-MM-dd"), F.date_format(run, "yyyy-MM-dd"))
            .alias(DATE_COL)]
    cols += [F.col(c) for c in feature_cols]
    if target_col:
        cols.append(F.col(target_col))
    return snapshot.select(*cols)


def top_n(df: DataFrame, n: int | None) -> DataFrame:
    """A10: TOP n (n > 0 only).  The original has no ORDER BY; ordering by
    the key makes it deterministic.  Plans as a distributed top-k."""
    if n is None or int(n) <= 0:
        return df
    return df.orderBy(CUSTOMER_ID_COL, DATE_COL).limit(int(n))


def normalise_dates(df: DataFrame) -> DataFrame:
    """H1: trimmed text; 'None', 'NaT', 'nan' and '' count as missing."""
    d = F.trim(F.col(DATE_COL).cast("string"))
    return df.withColumn(DATE_COL, F.when(d.isin("None", "NaT", "nan", ""), F.lit(None)).otherwise(d))


def as_of_filter(df: DataFrame, as_of: str | None) -> DataFrame:
    """H2: equality on the date text, before de-duplication."""
    return df if not as_of else df.filter(F.col(DATE_COL) == F.lit(as_of))


def latest_per_customer(df: DataFrame) -> DataFrame:
    """The row with the latest as_of_date per customer (missing
    dates sort first, so they only win when nothing else exists).

    A per-customer ``max`` over a struct led by the date: partial
    aggregation runs before the shuffle, so each map task ships one row per
    customer, however many months a customer has."""
    rest = [c for c in df.columns if c != CUSTOMER_ID_COL]
    key = F.struct(F.col(DATE_COL).isNotNull().alias("_has"), *[F.col(c) for c in rest])
    return (df.groupBy(CUSTOMER_ID_COL).agg(F.max(key).alias("_r"))
            .select(CUSTOMER_ID_COL, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def model_rows(snapshot: DataFrame, target_col: str | None = "churned_hard90",
               run_date=None, as_of: str | None = None, keep_all_rows: bool = False,
               top: int | None = None,
               feature_cols=tuple(FEATURE_COLUMNS)) -> DataFrame:
    """A9 -> A10 -> H1 -> H2 -> H3 in the original order."""
    df = normalise_dates(top_n(feature_frame(snapshot, target_col, run_date, feature_cols), top))
    df = as_of_filter(df, as_of)
    return df if keep_all_rows else latest_per_customer(df)
