"""Snapshot assembly (C7, F1-F17, I9, I10): one row per (customer_id, t0)."""

from __future__ import annotations

import datetime
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import cadence as fx
from tidemark.operators.timeline import daily_rollup, probe_features, timeline_features
from tidemark.params import CadenceParams
from tidemark.session import scratch_path, short_methods, shuffles_deleted, stored
from tidemark.sources import (
    clean_backorders, clean_invoices, clean_orders, raw_feeds, rows_in, sign_invoices, type_orders,
)

_DEC = T.DecimalType(18, 2)

# The snapshot table, in column order (the reference's target table).
SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("t0", T.DateType(), False),
    T.StructField("recency_days", T.IntegerType()),
    T.StructField("median_gap_days", T.IntegerType()),
    T.StructField("p90_gap_days", T.IntegerType()),
    T.StructField("cv_gap", T.DoubleType()),
    T.StructField("in_renewal_grace", T.IntegerType()),
    T.StructField("rev_180d", _DEC),
    T.StructField("rev_returns_90d", _DEC),
    T.StructField("invoices_90d", T.LongType()),
    T.StructField("credit_notes_90d", T.LongType()),
    T.StructField("orders_pos_30d", _DEC),
    T.StructField("orders_neg_30d", _DEC),
    T.StructField("backorder_qty_30d", T.DoubleType()),
    T.StructField("pct_change_3m", T.DoubleType()),
    T.StructField("pct_change_6m", T.DoubleType()),
    T.StructField("yoy_change_pct", T.DoubleType()),
    T.StructField("credit_notes_prev_month", T.IntegerType()),
    T.StructField("invoices_pos_prev_month", T.IntegerType()),
    T.StructField("credit_notes_ma3", T.DoubleType()),
    T.StructField("churned_hard90", T.IntegerType(), False),
    T.StructField("threshold_days", T.IntegerType()),
    T.StructField("churned_dynamic", T.IntegerType(), False),
    T.StructField("is_maintenance_heavy", T.IntegerType()),
    T.StructField("maint_cycle_days", T.IntegerType()),
    T.StructField("churn_reason_dynamic", T.StringType()),
    T.StructField("churn_reason_code_dynamic", T.StringType()),
    T.StructField("churn_reason_hard90", T.StringType()),
    T.StructField("severity_score", T.DoubleType()),
    T.StructField("lateness_component", T.DoubleType()),
    T.StructField("credits_component", T.DoubleType()),
    T.StructField("trend_component", T.DoubleType()),
    T.StructField("mitigator_component", T.DoubleType()),
])
SNAPSHOT_COLUMNS = [f.name for f in SNAPSHOT_SCHEMA.fields]
SEVERITY_COLUMNS = ["severity_score", "lateness_component", "credits_component",
                    "trend_component", "mitigator_component"]


@dataclass(frozen=True)
class CleanInputs:
    invoices: DataFrame        # #inv_pos: customer_id, tx_date, amt_local, sign_col, cancel_flag
    invoices_signed: DataFrame  # customer_id, tx_date, amt_local_signed
    orders: DataFrame          # typed order intake
    backorders: DataFrame      # customer_id, bo_date, qty
    rows_in: int | None = None  # rows of the tables that the feeds are read from, if known


def clean_inputs(invoices_raw: DataFrame, orders_raw: DataFrame, backorders_raw: DataFrame,
                 params: CadenceParams = CadenceParams(), rows_in: int | None = None) -> CleanInputs:
    inv = clean_invoices(invoices_raw, params)
    return CleanInputs(
        invoices=inv,
        invoices_signed=sign_invoices(inv),
        orders=type_orders(clean_orders(orders_raw, params)),
        backorders=clean_backorders(backorders_raw, params),
        rows_in=rows_in,
    )


def load_clean_inputs(spark: SparkSession, sf_dir: str,
                      params: CadenceParams = CadenceParams()) -> CleanInputs:
    short_methods(spark)
    return clean_inputs(*raw_feeds(spark, sf_dir), params=params, rows_in=rows_in(spark, sf_dir))


def spine_features(inputs: CleanInputs, params: CadenceParams = CadenceParams(),
                   customers: DataFrame | None = None, since: datetime.date | None = None) -> DataFrame:
    """Every spine row (customer_id, t0) with raw timeline features; with
    ``customers`` theirs alone, with ``since`` those from that month start on."""
    daily = daily_rollup(inputs.invoices_signed, inputs.orders, inputs.backorders, inputs.rows_in, customers, since)
    return probe_features(timeline_features(daily, params))


def derive(probes: DataFrame, params: CadenceParams = CadenceParams()) -> DataFrame:
    """Add the derived snapshot columns (F1-F16) to spine rows.  Keeps all
    spine rows; :func:`cadence_snapshot` applies the star join's filter."""
    c = F.col
    n = c("gap_n").cast("double")
    mean_gap = F.when(c("gap_n") > 0, c("gap_sum").cast("double") / n)
    # sample stdev from exact integer moments: (n*S2 - S1^2) / (n (n-1))
    var_num = c("gap_n") * c("gap_sum2") - c("gap_sum") * c("gap_sum")
    sd_gap = F.when(c("gap_n") > 1,
                    F.sqrt(var_num.cast("double") / (c("gap_n") * (c("gap_n") - 1)).cast("double")))
    net30 = c("orders_net_30d")
    df = probes.withColumns({
        "median_gap_days": c("gap_p50").cast("int"),
        "p90_gap_days": c("gap_p90").cast("int"),
        "cv_gap": F.when(mean_gap > 0, sd_gap / mean_gap),
        "orders_pos_30d": F.when(net30 >= 0, net30).otherwise(F.lit(0)).cast(_DEC),
        "orders_neg_30d": F.when(net30 < 0, F.abs(net30)).otherwise(F.lit(0)).cast(_DEC),
        "pct_change_3m": fx.change_ratio(c("m_rev_3"), c("m_rev_prev_3")),
        "pct_change_6m": fx.change_ratio(c("m_rev_6"), c("m_rev_prev_6")),
        "yoy_change_pct": fx.yoy_change(c("m_rev_prev_month"), c("m_rev_ly")),
        "is_maintenance_heavy": fx.is_maintenance_heavy(c("maint_orders_180d"), c("tech_orders_180d")),
        "maint_cycle_days": fx.maint_cycle_days(c("terms_cycle_days"), c("gap_p50").cast("int")),
        "churned_hard90": fx.churned_hard90(c("forward_rev_90d")),
    })
    df = df.withColumn("threshold_days", fx.threshold_days(
        c("maint_cycle_days"), c("gap_p90"), c("gap_p50"), c("in_renewal_grace"), params))
    args = (c("recency_days"), c("threshold_days"), c("in_renewal_grace"), c("invoices_90d"),
            c("rev_returns_90d"), c("orders_pos_30d"), c("backorder_qty_30d"),
            c("pct_change_3m"), c("pct_change_6m"), c("yoy_change_pct"))
    df = df.withColumns({
        "churned_dynamic": fx.churned_dynamic(c("recency_days"), c("threshold_days")),
        "churn_reason_dynamic": fx.reason_dynamic(*args),
        "churn_reason_code_dynamic": fx.reason_code_dynamic(*args),
        "churn_reason_hard90": fx.reason_hard90(c("churned_hard90")),
        "lateness_component": fx.lateness_component(c("recency_days"), c("threshold_days")),
        "credits_component": fx.credits_component(c("rev_returns_90d"), c("rev_180d")),
        "trend_component": fx.trend_component(c("pct_change_3m"), c("pct_change_6m"),
                                              c("yoy_change_pct")),
        "mitigator_component": fx.mitigator_component(c("orders_pos_30d"), c("in_renewal_grace")),
    })
    return df.withColumn("severity_score", fx.severity_score(
        c("lateness_component"), c("credits_component"), c("trend_component"),
        c("mitigator_component")))


def cadence_snapshot(probes: DataFrame, params: CadenceParams = CadenceParams()) -> DataFrame:
    """Keep the spine rows the reference's inner star join keeps -- a
    previous invoice exists (recency) and at least one purchase gap lies in
    the lookback (gap statistics) -- and project the 33 table columns."""
    rows = derive(probes.filter(F.col("recency_days").isNotNull() & (F.col("gap_n") > 0)), params)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SNAPSHOT_SCHEMA.fields])


def build_snapshot(spark: SparkSession, sf_dir: str,
                   params: CadenceParams = CadenceParams()) -> DataFrame:
    """Raw feeds -> snapshot, as one lazy plan."""
    return cadence_snapshot(spine_features(load_clean_inputs(spark, sf_dir, params), params), params)


def _result_order() -> list[Column]:
    return [F.col("churned_dynamic").desc(), F.col("severity_score").desc(), F.col("customer_id"), F.col("t0")]


def _result_key() -> Column:
    """A struct that compares as :func:`_result_order` sorts: down the churned
    flag and the severity, NULL last in both and NaN first."""
    churned, severity = F.col("churned_dynamic"), F.col("severity_score")
    return F.struct(churned.isNull().alias("a"), (-churned.cast("bigint")).alias("b"),
                    severity.isNull().alias("c"), (~F.isnan(severity)).alias("d"),
                    F.when(~F.isnan(severity), -severity).alias("e"),
                    F.col("customer_id").alias("f"), F.col("t0").alias("g"))


def ranked(snapshot: DataFrame) -> DataFrame:
    """the reference's result order (a distributed range sort)."""
    return snapshot.orderBy(*_result_order())


#: rows of one stretch of the result order, about
STRETCH_ROWS = 250_000


def positioned(snapshot: DataFrame) -> DataFrame:
    """F17 with the place of every row in the result: ``position`` from 1.

    The order is cut into stretches of about ``STRETCH_ROWS`` rows.  A shuffle of
    the sort columns alone gives the first key of every stretch and its size; the
    driver gets these, one line a stretch.  Then every row goes to its stretch (a
    binary search), a task sorts one, and a row's number in its stretch and the
    sizes of the stretches before it give its position.

    The snapshot is stored once; the sorted rows are not stored at all, because
    stretches with given bounds hold the same rows in every run.
    """
    spark = snapshot.sparkSession
    rows = stored(snapshot, scratch_path(spark, "ranked"))
    keys = rows.select("churned_dynamic", "severity_score", "customer_id", "t0")
    with shuffles_deleted(spark):
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // STRETCH_ROWS))
        stretches = (keys.repartitionByRange(tasks, *_result_order())
                     .groupBy(F.spark_partition_id().alias("at"))
                     .agg(F.count(F.lit(1)).alias("size"), F.to_json(F.min(_result_key())).alias("first"))
                     .orderBy("at").collect())
    if not stretches:
        return rows.withColumn("position", F.lit(None).cast("bigint"))
    kind = rows.select(_result_key().alias("k")).schema["k"].dataType
    kind = T.StructType([T.StructField(f.name, f.dataType) for f in kind.fields])    # with NULLs, as JSON has them
    firsts = F.from_json(F.lit(f"[{','.join(s['first'] for s in stretches)}]"), T.ArrayType(kind))
    steps = F.array(*[F.lit(s) for s in [0, *(1 << b for b in reversed(range((len(stretches) - 1).bit_length())))]])
    # the last stretch whose first key is not above the row's
    search = lambda key: F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        F.get(firsts, at + step) <= key, at + step).otherwise(at))
    # as the item of an array, the key is made once a row, not once a step
    stretch = F.get(F.transform(F.array(_result_key().cast(kind)), search), F.lit(0))
    before = [0, *accumulate(s["size"] for s in stretches)][:-1]
    return (rows.withColumn("_stretch", stretch)
            .repartitionById(len(stretches), "_stretch").sortWithinPartitions(*_result_order())
            # the id is the task's number above bit 33 and the row's number in it below
            .withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
            .withColumn("position", F.get(F.lit(before).cast("array<bigint>"), F.col("_stretch")) + F.col("_row") + 1)
            .drop("_stretch", "_row"))


def write_snapshot(snapshot: DataFrame, path: str) -> None:
    """Full refresh of the stored snapshot, atomic for its readers."""
    from tidemark.operators import store
    store.publish(snapshot, path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The stored snapshot in the declared schema; columns that an older
    layout lacks (the five severity columns) are NULL."""
    from tidemark.operators import store
    return store.read(spark, path)
