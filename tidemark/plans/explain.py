"""Top reasons behind each score (G10-G13), without UDFs: per row, an array
of (contribution, feature index, phrase) structs is built once, then filtered,
sorted by key, sliced to three and joined with '; ' for each reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.phrases import phrase
from tidemark.plans.model import FittedModel, label_column

# Fallback texts.
PREDICTED_FALLBACK = "elevated churn risk across multiple signals"
ACTUAL_FALLBACK = "observed churn within 90 days"
TOP_K = 3


def _said(model: FittedModel) -> Column:
    """Features that have something to say: (contribution, index, phrase)."""
    every = F.array(*[
        F.struct(F.col(f"_c{j}").alias("c"), F.lit(j).alias("idx"),
                 phrase(c, F.col(c), F.col(f"_z{j}")).alias("phrase"))
        for j, c in enumerate(model.feature_cols)])
    return F.filter(every, lambda s: s["phrase"] != "")


def _top_text(said: Column, key_of) -> Column:
    """The TOP_K phrases with the largest key; equal keys: higher index first."""
    ranked = F.transform(said, lambda s: F.struct(key_of(s["c"]).alias("key"), s["idx"], s["phrase"]))
    top = F.slice(F.sort_array(ranked, asc=False), 1, TOP_K)
    return F.array_join(F.transform(top, lambda s: s["phrase"]), "; ")


def explain(scored: DataFrame, model: FittedModel, target_col: str | None) -> DataFrame:
    """Adds both reasons; the phrases of a row are built once.

    G10-G12: predicted churners get their largest positive contributions,
    others their largest absolute ones.  G13: observed churners get their
    largest positive contributions.
    """
    out = scored.withColumn("_said", _said(model)).withColumn(
        "_raising", F.filter("_said", lambda s: s["c"] > 0))
    raising = _top_text(F.col("_raising"), lambda c: c)
    largest = _top_text(F.col("_said"), F.abs)
    text = F.when(F.col("predicted_churn_90d") == 1, raising).otherwise(largest)
    out = out.withColumn("predicted_churn_reason_90d",
                         F.when(text == "", F.lit(PREDICTED_FALLBACK)).otherwise(text))
    if target_col and target_col in scored.columns:
        out = out.withColumn("actual_churned_90d", label_column(target_col, scored))
        out = out.withColumn("actual_churn_reason_90d", F.when(F.col("actual_churned_90d") != 1, F.lit(""))
                             .when(raising == "", F.lit(ACTUAL_FALLBACK)).otherwise(raising))
    return out.drop("_said", "_raising")
