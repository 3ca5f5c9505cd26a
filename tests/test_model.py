"""Model stage: statistics and coefficients against numpy, contribution
identity, guards."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.operators import snapshot as snap
from tidemark.params import FEATURE_COLUMNS, ScoreParams
from tidemark.plans import churn
from tidemark.plans import model as M
from tidemark.plans.select import model_rows


@pytest.fixture(scope="module")
def rows(spark):
    return M.materialize(model_rows(snap.build_snapshot(spark, SF_SMALL)))


def _newton(Z, y):
    n = len(y)
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    A = np.hstack([Z, np.ones((n, 1))])
    beta = np.zeros(A.shape[1])
    k = Z.shape[1]
    for _ in range(100):
        p = 1 / (1 + np.exp(-A @ beta))
        g = A.T @ (w * (p - y))
        g[:k] += beta[:k]
        H = (A * (w * p * (1 - p))[:, None]).T @ A
        H[np.arange(k), np.arange(k)] += 1
        step = np.linalg.solve(H, g)
        beta -= step
        if np.abs(step).max() < 1e-12:
            break
    return beta


def test_fit_matches_newton_solve(rows):
    pdf = rows.toPandas()
    X = pdf[FEATURE_COLUMNS].astype(float).to_numpy()
    y = pdf["churned_hard90"].astype(int).to_numpy()
    med = np.nanmedian(X, axis=0)
    Xi = np.where(np.isnan(X), med, X)
    mu, sd = Xi.mean(0), Xi.std(0)
    sd[sd == 0] = 1.0
    m = M.fit(rows, ScoreParams())
    assert np.allclose(m.medians, med, rtol=0, atol=1e-12)
    assert np.allclose(m.means, mu, rtol=1e-12)
    assert np.allclose(m.scales, sd, rtol=1e-9)
    beta = _newton((Xi - mu) / sd, y)
    assert np.abs(np.array(m.coefficients + [m.intercept]) - beta).max() < 1e-3


def test_contributions_sum_to_logit(rows):
    params = ScoreParams()
    m = M.fit(rows, params)
    scored = M.score(M.coerce_features(rows, FEATURE_COLUMNS), m, params)
    contrib = sum(F.col(f"_c{j}") for j in range(len(FEATURE_COLUMNS)))
    p = F.col("predicted_churn_probability_90d")
    diff = scored.select(F.max(F.abs(contrib + F.lit(m.intercept) - F.log(p / (1 - p))))).first()[0]
    assert diff < 1e-9


def test_exact_medians_with_ties_and_even_counts(spark):
    rnd = random.Random(7)
    cols = {"a": [float(rnd.randint(0, 5)) for _ in range(1000)],      # heavy ties
            "b": [rnd.random() for _ in range(999)] + [None],           # odd count of values
            "c": [float(i) for i in range(1000)],                       # even count
            "d": [None] * 990 + [3.0] * 10}
    data = list(zip(*cols.values()))
    df = spark.createDataFrame(data, "a double, b double, c double, d double").repartition(5)
    med, cnt = M.exact_medians(df, list(cols), accuracy=1000)
    for j, c in enumerate(cols):
        vals = [v for v in cols[c] if v is not None]
        assert cnt[j] == len(vals)
        assert med[j] == float(np.median(vals))


def test_guards(spark, rows):
    with pytest.raises(ValueError, match="Missing required feature columns"):
        M.fit(rows.drop("cv_gap"))
    with pytest.raises(ValueError, match="single class"):
        M.fit(rows.withColumn("churned_hard90", F.lit(0)))
    with pytest.raises(ValueError, match="no rows"):
        M.fit(rows.filter(F.lit(False)))
    with pytest.raises(ValueError, match="target column"):
        M.fit(rows.drop("churned_hard90"))


def test_as_of_that_is_not_a_month_start_selects_nothing(spark):
    s = snap.build_snapshot(spark, SF_SMALL)
    assert model_rows(s, as_of="1999-01-31").count() == 0
    with pytest.raises(ValueError, match="no rows"):
        churn.scored_rows(s, ScoreParams(as_of="1999-01-31"))


def test_report_headers_and_types(spark):
    s = snap.build_snapshot(spark, SF_SMALL)
    rep = churn.prediction_report(s, today=dt.date(2001, 10, 1),
                                  created_on=dt.datetime(2002, 1, 1, 9, 30, 15, 999))
    assert rep.columns == ["CustomerId", "SnapshotDate", "DaysSinceLastPurchaseToday",
                           "ChurnedNowBusinessRule", "WhyBusinessRule", "ChurnedWithin90DaysActual",
                           "WhyTheyChurnedActual", "PredictedToChurnNext90Days",
                           "ChurnProbabilityPctNext90Days", "ChurnProbabilityNext90Days",
                           "WhyAtRiskPredicted", "Createdon"]
    rows = rep.collect()
    assert all(r.Createdon == dt.datetime(2002, 1, 1, 9, 30, 15) for r in rows)
    assert all(r.WhyAtRiskPredicted for r in rows)
    assert all((r.WhyTheyChurnedActual != "") == (r.ChurnedWithin90DaysActual == 1) for r in rows)
    assert all(r.PredictedToChurnNext90Days == int(r.ChurnProbabilityNext90Days >= 0.5) for r in rows)
    from tidemark.plans import report
    from tidemark.functions.headers import PREDICTIONS_TABLE_SCHEMA
    table = report.to_table(rep)
    assert [(f.name, f.dataType) for f in table.schema.fields] == \
        [(f.name, f.dataType) for f in PREDICTIONS_TABLE_SCHEMA.fields]
    tech = churn.prediction_report(s, ScoreParams(headers="technical"), today=dt.date(2001, 10, 1))
    assert tech.columns[:3] == ["CustomerId", "AsOfDateT0", "BusinessChurnNow"]
    assert tech.columns[-2:] == ["DaysSinceLastPurchaseToday", "Createdon"]


def test_fit_matches_newton_solve_sf001(spark):
    """The same parity on sf0.01 (1,500 customers)."""
    rows = M.materialize(model_rows(snap.build_snapshot(spark, "/root/testdata/sf0.01")))
    pdf = rows.toPandas()
    X = pdf[FEATURE_COLUMNS].astype(float).to_numpy()
    y = pdf["churned_hard90"].astype(int).to_numpy()
    med = np.nanmedian(X, axis=0)
    Xi = np.where(np.isnan(X), med, X)
    mu, sd = Xi.mean(0), Xi.std(0)
    sd[sd == 0] = 1.0
    m = M.fit(rows, ScoreParams())
    assert np.allclose(m.medians, med, rtol=0, atol=1e-12)
    assert np.allclose(m.means, mu, rtol=1e-9)
    assert np.allclose(m.scales, sd, rtol=1e-9)
    beta = _newton((Xi - mu) / sd, y)
    assert np.abs(np.array(m.coefficients + [m.intercept]) - beta).max() < 1e-3
