"""Newton solver, background contributions, inferred sink types."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from tidemark.functions import headers as H
from tidemark.operators import snapshot as snap
from tidemark.params import ScoreParams
from tidemark.plans import churn, report
from tidemark.plans import model as M
from tidemark.plans.select import model_rows

NEWTON = replace(ScoreParams(), solver="newton")


@pytest.fixture(scope="module")
def latest(spark):
    return model_rows(snap.build_snapshot(spark, SF_SMALL), run_date="2001-12-01").checkpoint()


def test_newton_agrees_with_itself_and_with_lbfgs(latest):
    one = M.fit(latest, NEWTON)
    again = M.fit(latest.repartition(9, F.rand(2)), NEWTON)
    theta = np.array([*one.coefficients, one.intercept])
    assert np.max(np.abs(theta - [*again.coefficients, again.intercept])) < 1e-9
    other = M.fit(latest)
    assert np.max(np.abs(theta - [*other.coefficients, other.intercept])) < 1e-3
    assert one.iterations < 20
    assert max(map(abs, M.gradient(latest, one))) < 1e-11
    with pytest.raises(ValueError, match="solver"):
        M.fit(latest, replace(ScoreParams(), solver="sgd"))


def test_newton_on_separable_rows_stays_finite(spark):
    rows = [(float(i), 2.0 * i, int(i >= 50)) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, y int")
    model = M.fit(df, ScoreParams(target_col="y", feature_cols=("a", "b"), solver="newton"))
    assert np.isfinite(model.coefficients).all()
    assert max(map(abs, M.gradient(df, model, ScoreParams(target_col="y", feature_cols=("a", "b"))))) < 1e-10


def test_background_contributions(latest):
    model = M.fit(latest, NEWTON)
    scored = M.score(M.coerce_features(latest, list(model.feature_cols)), model)
    k = len(model.feature_cols)
    rows = scored.select(F.md5(F.concat_ws("|", F.col("customer_id").cast("string"), "as_of_date")).alias("h"),
                         *[f"_z{j}" for j in range(k)]).collect()
    for size in (20, 10_000):       # fewer rows than the sample asks for: all of them
        means = M.background_means(scored, model, size)
        z = np.array([r[1:] for r in sorted(rows)[:size]])
        assert np.allclose(means, z.mean(axis=0), atol=1e-12)
        got = M.against_background(scored, model, means)
        for r in got.limit(20).collect():
            assert np.allclose([r[f"_c{j}"] for j in range(k)],
                               [model.coefficients[j] * (r[f"_z{j}"] - means[j]) for j in range(k)], atol=1e-12)
    plain, _ = churn.scored_rows(latest.withColumn("t0", F.col("as_of_date").cast("date")), NEWTON)
    based, _ = churn.scored_rows(latest.withColumn("t0", F.col("as_of_date").cast("date")),
                                 replace(NEWTON, background_rows=20))
    p = "predicted_churn_probability_90d"
    scores = lambda df: {r.customer_id: round(r[p], 9) for r in df.select("customer_id", p).collect()}
    assert scores(plain) == scores(based)


def test_undeclared_columns_get_types_from_headers_then_values(spark):
    kinds = {"Customer-ID": (T.LongType(), T.IntegerType()), "x snapshot date y": (T.StringType(), T.DateType()),
             "Predicted to churn?": (T.IntegerType(), T.BooleanType()), "Probability pct": (T.DoubleType(), T.DecimalType(5, 2)),
             "probability": (T.DoubleType(), T.DecimalType(9, 6)), "Outcome": (T.IntegerType(), T.StringType()),
             "created_on": (T.StringType(), T.TimestampType()), "n": (T.ShortType(), T.IntegerType()),
             "f": (T.FloatType(), T.DoubleType()), "flag": (T.BooleanType(), T.BooleanType()),
             "money": (T.DecimalType(9, 2), T.StringType()), "day": (T.DateType(), T.StringType())}
    for name, (kind, want) in kinds.items():
        assert H.inferred_type(name, kind) == want, name
    out = report.to_table(spark.createDataFrame([(1, 5, None)], "`Order (n)` long, CustomerId long, `a b` double"))
    assert out.dtypes == [("order_n", "int"), ("CustomerId", "int"), ("a_b", "double")]
    assert out.first() == (1, 5, None)
