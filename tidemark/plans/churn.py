"""The scoring stage end to end: snapshot -> model rows -> fit -> scores ->
explanations -> business rule -> report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tidemark.params import ScoreParams
from tidemark.plans import explain as X
from tidemark.plans import model as M
from tidemark.plans import report as R
from tidemark.plans.rules import business_rule
from tidemark.plans.select import model_rows


def scored_rows(snapshot: DataFrame, params: ScoreParams = ScoreParams(), run_date=None,
                checkpoint: bool = True) -> tuple[DataFrame, M.FittedModel]:
    rows = model_rows(snapshot, params.target_col, run_date, params.as_of, params.keep_all_rows,
                      params.top, params.feature_cols)
    if checkpoint:
        rows = M.materialize(rows)
    model = M.fit(rows, params)
    work = M.coerce_features(rows, list(params.feature_cols))
    scored = M.score(work, model, params)
    if params.background_rows > 0:
        scored = M.against_background(scored, model, M.background_means(scored, model, params.background_rows))
    return scored, model


def explained_rows(scored: DataFrame, model: M.FittedModel, params: ScoreParams, today) -> DataFrame:
    """Scored rows with both reasons and the business rule, report columns only."""
    ruled = business_rule(X.explain(scored, model, params.target_col), today, params)
    return ruled.select(*[c for c in R.PREDICTION_COLUMNS if c in ruled.columns])


def predictions(snapshot: DataFrame, params: ScoreParams = ScoreParams(), run_date=None,
                today=None, checkpoint: bool = True) -> DataFrame:
    scored, model = scored_rows(snapshot, params, run_date, checkpoint)
    return explained_rows(scored, model, params, today or dt.date.today())


def prediction_report(snapshot: DataFrame, params: ScoreParams = ScoreParams(), run_date=None,
                      today=None, created_on: dt.datetime | None = None,
                      checkpoint: bool = True) -> DataFrame:
    return R.shape(predictions(snapshot, params, run_date, today, checkpoint),
                   params.headers, created_on)
