"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the survey (section 2).  Each reads the whole driver
tables through the adapter; nothing is sampled or capped.  Column names and
types match the DuckDB oracle in ``oracle/sql.py``."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import snapshot as snap
from tidemark.operators import store
from tidemark.operators.spine import month_start, spine_months
from tidemark.operators.timeline import (
    daily_rollup, invoice_gap_rows, probe_features, timeline_features,
)
from tidemark.params import CadenceParams, ScoreParams
from tidemark.plans import churn, report
from tidemark.plans import model as M
from tidemark.plans import select as sel
from tidemark.plans.rules import business_rule
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import extracts, raw_feeds

P = CadenceParams()
_DEC = "decimal(18,2)"


def _inputs(spark: SparkSession, sf_dir: str) -> snap.CleanInputs:
    return snap.load_clean_inputs(spark, sf_dir, P)


def _probes(spark: SparkSession, sf_dir: str, backorders: bool = False) -> DataFrame:
    """Spine rows; the backorder feed is read only where its sums are wanted."""
    i = _inputs(spark, sf_dir)
    return probe_features(timeline_features(
        daily_rollup(i.invoices_signed, i.orders, i.backorders if backorders else None, i.rows_in), P))


def _derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snap.derive(_probes(spark, sf_dir), P)


#: digits at which floats of two math libraries are compared
DIGITS = 9


def _rounded(df: DataFrame) -> DataFrame:
    """``exp`` differs in the last bit between math libraries: the registered
    queries round what depends on it; the product's columns are not rounded."""
    return df.withColumns({c: F.round(c, DIGITS) for c in ("lateness_component", "severity_score")
                           if c in df.columns})


# ---- A: sources ---------------------------------------------------------

def invoices_raw(spark, sf_dir):
    return raw_feeds(spark, sf_dir)[0]


def orders_raw(spark, sf_dir):
    return raw_feeds(spark, sf_dir)[1]


def backorders_raw(spark, sf_dir):
    return raw_feeds(spark, sf_dir)[2]


def invoices_clean(spark, sf_dir):
    return _inputs(spark, sf_dir).invoices


def invoices_signed(spark, sf_dir):
    return _inputs(spark, sf_dir).invoices_signed


def orders_clean(spark, sf_dir):
    return _inputs(spark, sf_dir).orders.drop("is_tech", "is_maint")


def orders_typed(spark, sf_dir):
    return _inputs(spark, sf_dir).orders


def backorders_clean(spark, sf_dir):
    return _inputs(spark, sf_dir).backorders


# ---- B: spine -----------------------------------------------------------

def spine(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return spine_months(i.invoices, i.orders)


# ---- C/D/E: as-of, lookback, time-range aggregates ------------------------

def recency_asof(spark, sf_dir):
    return (_probes(spark, sf_dir).filter(F.col("recency_days").isNotNull())
            .select("customer_id", "t0", "last_tx_date", F.col("recency_days").cast("int")))


def latest_terms_asof(spark, sf_dir):
    return _probes(spark, sf_dir).select(
        "customer_id", "t0", "last_order_date", "pay_terms", "terms_cycle_days")


def purchase_gaps(spark, sf_dir):
    i = _inputs(spark, sf_dir)
    return invoice_gap_rows(timeline_features(daily_rollup(i.invoices_signed, rows_in=i.rows_in), P))


def gaps_lookback(spark, sf_dir):
    return (_probes(spark, sf_dir).filter(F.col("gap_n") > 0)
            .select("customer_id", "t0", F.col("gap_n").alias("n_gaps"),
                    F.col("gap_sum").alias("sum_gap_days"),
                    F.col("gap_sum2").alias("sum_sq_gap_days")))


def gap_stats(spark, sf_dir):
    return (_derived(spark, sf_dir).filter(F.col("gap_n") > 0)
            .select("customer_id", "t0",
                    F.col("gap_p50").alias("median_gap_raw"), F.col("gap_p90").alias("p90_gap_raw"),
                    "median_gap_days", "p90_gap_days", "cv_gap"))


def renewal_grace(spark, sf_dir):
    return _probes(spark, sf_dir).select("customer_id", "t0", "in_renewal_grace")


def revenue_windows(spark, sf_dir):
    return _probes(spark, sf_dir).select("customer_id", "t0", "rev_180d", "rev_returns_90d",
                                         "invoices_90d", "credit_notes_90d")


def orders_net_30d(spark, sf_dir):
    return _derived(spark, sf_dir).select("customer_id", "t0", "orders_pos_30d", "orders_neg_30d")


def backorder_qty_30d(spark, sf_dir):
    return _probes(spark, sf_dir, backorders=True).select("customer_id", "t0", "backorder_qty_30d")


def order_mix_180d(spark, sf_dir):
    return _derived(spark, sf_dir).select("customer_id", "t0", "maint_orders_180d",
                                          "tech_orders_180d", "is_maintenance_heavy")


def forward_revenue_90d(spark, sf_dir):
    return _probes(spark, sf_dir).select("customer_id", "t0", "forward_rev_90d")


def monthly_rollup(spark, sf_dir):
    """D7 as a stand-alone roll-up (the snapshot reads the same sums off the
    month-ordered window instead)."""
    inv = _inputs(spark, sf_dir).invoices_signed
    amt = F.col("amt_local_signed")
    return (inv.groupBy("customer_id", month_start(F.col("tx_date")).alias("month_start"))
            .agg(F.sum(amt).cast("decimal(38,2)").alias("rev_net_month"),
                 F.sum(F.when(amt > 0, 1).otherwise(0)).alias("invoices_pos_cnt"),
                 F.sum(F.when(amt < 0, 1).otherwise(0)).alias("credit_notes_cnt")))


def month_trends(spark, sf_dir):
    d = lambda c: F.col(c).cast("decimal(38,2)")
    return _probes(spark, sf_dir).select(
        "customer_id", "t0", d("rev_trailing_3m"), d("rev_trailing_prev_3m"), d("rev_trailing_6m"),
        d("rev_trailing_prev_6m"), d("rev_same_month_ly"), d("rev_prev_month"),
        "credit_notes_prev_month", "invoices_pos_prev_month", "credit_notes_ma3")


def trend_changes(spark, sf_dir):
    return _derived(spark, sf_dir).select("customer_id", "t0", "pct_change_3m", "pct_change_6m",
                                          "yoy_change_pct")


def maint_cycle(spark, sf_dir):
    return _derived(spark, sf_dir).select("customer_id", "t0", "maint_cycle_days")


def threshold_days(spark, sf_dir):
    return _derived(spark, sf_dir).select("customer_id", "t0", "threshold_days")


# ---- F: labels, reasons, severity over the snapshot rows -----------------

def _snapshot(spark, sf_dir):
    return snap.build_snapshot(spark, sf_dir, P)


def churn_labels(spark, sf_dir):
    return _snapshot(spark, sf_dir).select("customer_id", "t0", "recency_days", "threshold_days",
                                           "churned_hard90", "churned_dynamic")


def severity_components(spark, sf_dir):
    return _rounded(_snapshot(spark, sf_dir)).select("customer_id", "t0", *snap.SEVERITY_COLUMNS)


def reason_text(spark, sf_dir):
    return _snapshot(spark, sf_dir).select("customer_id", "t0", "churn_reason_dynamic")


def reason_codes(spark, sf_dir):
    return _snapshot(spark, sf_dir).select("customer_id", "t0", "churn_reason_code_dynamic")


def reason_hard90(spark, sf_dir):
    return _snapshot(spark, sf_dir).select("customer_id", "t0", "churn_reason_hard90")


def cadence_snapshot(spark, sf_dir):
    return _rounded(_snapshot(spark, sf_dir))


def snapshot_ranked(spark, sf_dir):
    """The result order as a column: ``position`` from 1."""
    return snap.positioned(_rounded(_snapshot(spark, sf_dir)))


# ---- the stored snapshot: written, checked and read back --------------------

def _scratch(spark, name):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def snapshot_published(spark, sf_dir):
    path = _scratch(spark, "snapshot")
    store.publish(_snapshot(spark, sf_dir), path)
    return _rounded(store.read(spark, path))


def snapshot_refreshed(spark, sf_dir):
    """A snapshot of the events before ``NEW_FROM``, brought up to date with the rest."""
    every, path = _inputs(spark, sf_dir), _scratch(spark, "snapshot")
    days = {"invoices": "tx_date", "invoices_signed": "tx_date", "orders": "order_date", "backorders": "bo_date"}
    cut = F.lit(NEW_FROM).cast("date")
    old, new = (snap.CleanInputs(**{k: getattr(every, k).filter(keep(F.col(d))) for k, d in days.items()}, rows_in=every.rows_in)
                for keep in (lambda d: d < cut, lambda d: d >= cut))
    store.publish(snap.cadence_snapshot(snap.spine_features(old, P), P), path)
    store.refresh(spark, path, every, new, P)
    return _rounded(store.read(spark, path))


def snapshot_checks(spark, sf_dir):
    """What the write of a published snapshot observed."""
    metrics = store.publish(_snapshot(spark, sf_dir), _scratch(spark, "snapshot")).metrics
    return spark.createDataFrame([(k, v) for k, v in metrics.items()], "metric string, value bigint")


def latest_bucketed(spark, sf_dir):
    """The latest row per customer from the table bucketed by customer."""
    name = f"snapshot_{uuid.uuid4().hex}"
    store.write_bucketed(_snapshot(spark, sf_dir), name, _scratch(spark, "bucketed"), buckets=8)
    return _rounded(sel.model_rows(spark.table(name), S.target_col, RUN_DATE))


# ---- text extracts ----------------------------------------------------------

def extract_audit(spark, sf_dir):
    """The feeds as text extracts with broken fields (a customer that is no
    number, a day that is no date), read back: kept, filtered and quarantined."""
    broken = lambda when, bad, c: F.when(when, F.lit(bad)).otherwise(F.col(c).cast("string"))
    number = F.col("customer_id").cast("bigint") % 50 == 7
    damage = {
        extracts.BILLING: {"customer_id": broken(number, "C-7", "customer_id"),
                           "billing_date": broken(F.dayofmonth("billing_date") == 13, "n/a", "billing_date")},
        extracts.ORDERS: {"customer_id": broken(number, "C-7", "customer_id"),
                          "creation_date": broken(F.dayofmonth("creation_date") == 13, "13th", "creation_date")},
        extracts.BACKORDERS: {"creation_date": broken(F.dayofmonth("creation_date") == 13, "13th", "creation_date")}}
    out = None
    for (layout, columns), feed in zip(damage.items(), raw_feeds(spark, sf_dir)):
        path = _scratch(spark, f"extract-{layout.name}")
        extracts.write_extract(feed.withColumns(columns), layout, path)
        counted = extracts.audit(spark, layout, path, P)
        out = counted if out is None else out.unionByName(counted)
    return out


SNAPSHOT_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "invoices_raw": invoices_raw,
    "orders_raw": orders_raw,
    "backorders_raw": backorders_raw,
    "invoices_clean": invoices_clean,
    "invoices_signed": invoices_signed,
    "orders_clean": orders_clean,
    "orders_typed": orders_typed,
    "backorders_clean": backorders_clean,
    "spine_months": spine,
    "recency_asof": recency_asof,
    "latest_terms_asof": latest_terms_asof,
    "purchase_gaps": purchase_gaps,
    "gaps_lookback": gaps_lookback,
    "gap_stats": gap_stats,
    "renewal_grace": renewal_grace,
    "revenue_windows": revenue_windows,
    "orders_net_30d": orders_net_30d,
    "backorder_qty_30d": backorder_qty_30d,
    "order_mix_180d": order_mix_180d,
    "maint_cycle": maint_cycle,
    "monthly_rollup": monthly_rollup,
    "month_trends": month_trends,
    "trend_changes": trend_changes,
    "threshold_days": threshold_days,
    "forward_revenue_90d": forward_revenue_90d,
    "labels": churn_labels,
    "severity_components": severity_components,
    "reason_text": reason_text,
    "reason_codes": reason_codes,
    "reason_hard90": reason_hard90,
    "cadence_snapshot": cadence_snapshot,
    "snapshot_ranked": snapshot_ranked,
    "snapshot_published": snapshot_published,
    "snapshot_refreshed": snapshot_refreshed,
    "snapshot_checks": snapshot_checks,
    "extract_audit": extract_audit,
}


# ---- scoring stage (A9, A10, G, H, I) ------------------------------------
# Fixed run parameters of the registered queries (dates inside the data).
RUN_DATE = "2001-12-01"
AS_OF = "1999-01-01"
TODAY = "2001-10-01"
NEW_FROM = "2001-05-10"
TOP_N = 1000
CREATED_ON = datetime.datetime(2001, 12, 1, 8, 0, 0)
BACKGROUND = 512
S = ScoreParams()


def _features(spark, sf_dir):
    return sel.feature_frame(_snapshot(spark, sf_dir), S.target_col, RUN_DATE)


def _latest(spark, sf_dir):
    return sel.model_rows(_snapshot(spark, sf_dir), S.target_col, RUN_DATE)


def features_top_n(spark, sf_dir):
    return _rounded(sel.top_n(_features(spark, sf_dir), TOP_N))


def as_of_snapshot(spark, sf_dir):
    return _rounded(sel.model_rows(_snapshot(spark, sf_dir), S.target_col, RUN_DATE, as_of=AS_OF))


def latest_snapshot_per_customer(spark, sf_dir):
    return _rounded(_latest(spark, sf_dir))


def business_rule_today(spark, sf_dir):
    return business_rule(_latest(spark, sf_dir), TODAY, S).select(
        "customer_id", "as_of_date", "in_renewal_grace", "days_since_last_purchase_today",
        "business_churn_now", "business_churn_reason")


def _model_input(spark, sf_dir):
    rows = M.materialize(_latest(spark, sf_dir))
    return M.coerce_features(rows, list(S.feature_cols)), rows


def feature_medians(spark, sf_dir):
    work, _ = _model_input(spark, sf_dir)
    cols = list(S.feature_cols)
    med, cnt = M.exact_medians(work, cols, S.median_accuracy)
    return spark.createDataFrame(
        [(c, j, round(med[j], DIGITS), cnt[j]) for j, c in enumerate(cols)],
        "feature string, idx int, median double, n_values bigint")


def feature_scaling(spark, sf_dir):
    """The fit's own means and scales, to 7 significant digits (floating sums
    differ in the last bits between engines)."""
    work, _ = _model_input(spark, sf_dir)
    st = M.statistics(work, S)
    sig = lambda x: float(f"{x:.6e}")
    return spark.createDataFrame(
        [(c, j, sig(st.means[j]), sig(st.scales[j])) for j, c in enumerate(S.feature_cols)],
        "feature string, idx int, mean double, scale double")


def class_weights(spark, sf_dir):
    """The fit's own class counts and weights."""
    classes, weights = M.class_counts(_latest(spark, sf_dir), S.target_col)
    return spark.createDataFrame([(k, n, weights[k]) for k, n in classes.items() if n],
                                 "label int, n bigint, weight double")


def model_gradient(spark, sf_dir):
    """The objective's gradient at the Newton solver's optimum, a row's mean over
    all rows, to ``DIGITS`` digits: zero for every coefficient."""
    rows = M.materialize(_latest(spark, sf_dir))
    model = M.fit(rows, replace(S, solver="newton"))
    names = [*model.feature_cols, "intercept"]
    return spark.createDataFrame(
        [(c, j, round(g, DIGITS) + 0.0, model.n) for j, (c, g) in enumerate(zip(names, M.gradient(rows, model, S)))],
        "feature string, idx int, gradient double, n_rows bigint")


def churn_scores(spark, sf_dir):
    scored, _ = churn.scored_rows(_snapshot(spark, sf_dir), S, RUN_DATE)
    return scored.select("customer_id", "as_of_date", "predicted_churn_90d",
                         "predicted_churn_probability_90d", "predicted_churn_probability_90d_pct")


def churn_explanations(spark, sf_dir):
    return churn.predictions(_snapshot(spark, sf_dir), S, RUN_DATE, TODAY).select(
        "customer_id", "predicted_churn_90d", "predicted_churn_reason_90d",
        "actual_churned_90d", "actual_churn_reason_90d")


def prediction_report(spark, sf_dir):
    return churn.prediction_report(_snapshot(spark, sf_dir), S, RUN_DATE, TODAY, CREATED_ON)


def prediction_table(spark, sf_dir):
    return report.to_table(prediction_report(spark, sf_dir))


# ---- the same scoring code with a documented fixed model --------------------
# A fitted model differs in its last digits from engine to engine; these queries
# put fixed constants through the same score, explain, rule and report code, so
# that SQL can compute every row.  The constants follow from a rule: scale and
# mean by the kind of feature, coefficients -0.5 .. 0.5 by position.

def fixed_model() -> M.FittedModel:
    from tidemark.functions.phrases import MONEY_FEATURES, NEG_RISK
    cols = list(S.feature_cols)
    kind = lambda c: (60_000.0 if c in MONEY_FEATURES else 100.0 if c.endswith("_days")
                      else 1.0 if c in NEG_RISK else 2.0)
    scales = [kind(c) for c in cols]
    means = [0.0 if c in NEG_RISK else k / 2 for c, k in zip(cols, scales)]
    coefficients = [((7 * j) % 11 - 5) / 10 for j in range(len(cols))]
    return M.FittedModel(cols, means, means, scales, coefficients, -0.25)


def _fixed(spark, sf_dir):
    rows = _rounded(_latest(spark, sf_dir))
    scored = M.score(M.coerce_features(rows, list(S.feature_cols)), fixed_model(), S)
    ruled = churn.explained_rows(scored, fixed_model(), S, TODAY)
    return ruled.withColumn("predicted_churn_probability_90d",
                            F.round("predicted_churn_probability_90d", DIGITS))


def fixed_scores(spark, sf_dir):
    return _fixed(spark, sf_dir).select("customer_id", "as_of_date", "predicted_churn_90d",
                                        "predicted_churn_probability_90d", "predicted_churn_probability_90d_pct")


def fixed_explanations(spark, sf_dir):
    return _fixed(spark, sf_dir).select("customer_id", "predicted_churn_90d", "predicted_churn_reason_90d",
                                        "actual_churned_90d", "actual_churn_reason_90d")


def fixed_contributions(spark, sf_dir):
    """Contributions of the fixed model against a background of 512 rows, to 4 digits.
    The rows are read twice: for the background, then for all contributions."""
    rows = M.materialize(_rounded(_latest(spark, sf_dir)))
    scored = M.score(M.coerce_features(rows, list(S.feature_cols)), fixed_model(), S)
    means = M.background_means(scored, fixed_model(), BACKGROUND)
    return M.against_background(scored, fixed_model(), means).select(
        "customer_id", *[(F.round(f"_c{j}", 4) + F.lit(0.0)).alias(c) for j, c in enumerate(S.feature_cols)])


def typed_table(spark, sf_dir):
    """A report whose columns the sink does not declare: names cleaned, types
    from headers and values."""
    rows = _fixed(spark, sf_dir).select(
        F.col("customer_id").alias("Customer ID"), F.col("as_of_date").alias("Snapshot Date (t0)"),
        F.col("days_since_last_purchase_today").cast("string").alias("Days Since Last Purchase [Today]"),
        F.col("predicted_churn_90d").alias("Predicted to Churn"),
        F.col("predicted_churn_probability_90d_pct").alias("Churn Probability Pct"),
        F.col("predicted_churn_probability_90d").alias("Churn Probability"),
        F.col("predicted_churn_reason_90d").alias("Why: At-Risk"),
        F.col("business_churn_now").alias("Business Status"),
        F.length("business_churn_reason").cast("bigint").alias("Text/Length %"),
        F.col("predicted_churn_probability_90d").cast("float").cast("double").alias("Score+"),
        (F.col("business_churn_now") == 1).alias("Key, Account"))
    return report.to_table(rows)


def _fixed_report(spark, sf_dir):
    return report.shape(_fixed(spark, sf_dir), "friendly", CREATED_ON)


def _stamp_text(df, name):
    """The stamp as text: engines disagree on how a zone is attached to it."""
    return df.withColumn(name, F.date_format(name, "yyyy-MM-dd HH:mm:ss"))


def fixed_report(spark, sf_dir):
    return _stamp_text(_fixed_report(spark, sf_dir), "Createdon")


def fixed_table(spark, sf_dir):
    return _stamp_text(report.to_table(_fixed_report(spark, sf_dir)), "CreatedOn")


SCORING_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "features_top_n": features_top_n,
    "as_of_snapshot": as_of_snapshot,
    "latest_snapshot_per_customer": latest_snapshot_per_customer,
    "business_rule_today": business_rule_today,
    "feature_medians": feature_medians,
    "feature_scaling": feature_scaling,
    "latest_bucketed": latest_bucketed,
    "model_gradient": model_gradient,
    "class_weights": class_weights,
    "churn_scores": churn_scores,
    "churn_explanations": churn_explanations,
    "prediction_report": prediction_report,
    "prediction_table": prediction_table,
    "fixed_scores": fixed_scores,
    "fixed_explanations": fixed_explanations,
    "fixed_contributions": fixed_contributions,
    "typed_table": typed_table,
    "fixed_report": fixed_report,
    "fixed_table": fixed_table,
}

ALL_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **SNAPSHOT_QUERIES, **SCORING_QUERIES}
