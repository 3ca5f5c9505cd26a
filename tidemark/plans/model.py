"""Class-balanced logistic regression on standardised features.

Every statistic is a distributed aggregate; only fixed-size results (26
medians, means, scales, coefficients) come back to the driver, and they go
back into the plan as literals.

* G4 median imputation needs the *exact* median (midpoint of the two middle
  values for even n).  A global exact ``percentile`` would merge every
  distinct value into one task, so it is found by distributed selection:
  ``percentile_approx`` narrows a bracket by a fixed factor a pass, until the
  few rows left are listed (see :func:`exact_medians`).
* G5 standardises with the population std (zero variance -> scale 1).
* G6 is Spark ML's LogisticRegression with instance weights n/(2 n_class)
  and ``regParam = 1/n``: the same optimum as C=1 with balanced class
  weights (the objective divided by sum(weights) = n).  A second solver takes
  Newton steps on the same objective, from one aggregate a step.
* G8/G9 scoring and linear contributions are plain column expressions.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.params import CUSTOMER_ID_COL, DATE_COL, ScoreParams
from tidemark.session import ensure_checkpoint_dir


EPS = 2.220446049250313e-16  # double machine epsilon


def is_constant(var: float, mean: float, n: int) -> bool:
    """A variance this small is rounding noise: scale by 1 instead."""
    return var <= n * EPS * var + (n * mean * EPS) ** 2


@dataclass
class FittedModel:
    feature_cols: list[str]
    medians: list[float]
    means: list[float]
    scales: list[float]
    coefficients: list[float]
    intercept: float
    class_counts: dict[int, int] = field(default_factory=dict)
    weights: dict[int, float] = field(default_factory=dict)
    n: int = 0
    iterations: int = 0

    def z(self, j: int, value: Column) -> Column:
        return (F.coalesce(value.cast("double"), F.lit(self.medians[j])) - F.lit(self.means[j])) \
            / F.lit(self.scales[j])


def check_features(df: DataFrame, feature_cols) -> None:
    """G1."""
    missing = [c for c in feature_cols if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required feature columns: {missing}")


def coerce_features(df: DataFrame, feature_cols) -> DataFrame:
    """Booleans -> 0/1, everything else numeric; unparsable and NaN -> NULL."""
    types = dict(df.dtypes)
    out = {}
    for c in feature_cols:
        col = F.col(c)
        if types[c] == "boolean":
            col = col.cast("int")
        number = col.try_cast("double") if types[c] == "string" else col.cast("double")
        out[c] = F.nanvl(number, F.lit(None).cast("double"))
    return df.withColumns(out)


def label_column(target_col: str, df: DataFrame) -> Column:
    """Missing or unparsable -> 0, else truncated to int; booleans 0/1."""
    value = F.col(target_col)
    if dict(df.dtypes)[target_col] == "boolean":
        value = value.cast("int")
    number = F.nanvl(value.cast("string").try_cast("double"), F.lit(0.0))
    return F.coalesce(number, F.lit(0.0)).cast("int")


def _dbl(v: float) -> str:
    """A double as exact SQL text (repr round-trips)."""
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def _targets(n: int) -> list[int]:
    """The one or two middle ranks of n values."""
    return sorted({(n - 1) // 2, n // 2}) if n else []


def _listed(df: DataFrame, cells: list[tuple[str, float, float]]) -> list[list[tuple[float, int]]]:
    """Distinct values with their counts inside each (column, lo, hi)."""
    parts = ", ".join(
        f"CASE WHEN CAST(`{c}` AS DOUBLE) BETWEEN {_dbl(lo)} AND {_dbl(hi)} "
        f"THEN named_struct('t', {i}, 'v', CAST(`{c}` AS DOUBLE)) END" for i, (c, lo, hi) in enumerate(cells))
    rows = (df.selectExpr(f"explode(array({parts})) AS c").filter("c IS NOT NULL")
            .groupBy("c.t", "c.v").agg(F.count(F.lit(1)).alias("n")).collect())
    out: list[list[tuple[float, int]]] = [[] for _ in cells]
    for r in rows:
        out[r["t"]].append((r["v"], r["n"]))
    return [sorted(x) for x in out]


def exact_medians(df: DataFrame, cols: list[str], accuracy: int = 10000,
                  listed: int = 2048) -> tuple[list[float | None], list[int]]:
    """Exact median of each column (NULLs ignored; midpoint of the two middle
    values for an even count) and the non-null counts -- by distributed
    selection, never by gathering a column in one task or on the driver.

    Every middle rank has a bracket [lo, hi] with the number of rows below and
    inside it.  A round makes two aggregates for all open brackets: sketch
    quantiles just below and above the rank within the bracket, then the exact
    counts around them.  Either the rank is one of the two values, or the
    bracket becomes the open interval that holds it: by the sketch's guarantee
    about 6/accuracy of the rows, at any distribution of values.  So a round
    divides the rows by over 1000; when at most ``listed`` rows are inside, their
    distinct values are read (``listed`` rows a rank at most reach the driver).
    """
    x = lambda j: f"CAST(`{cols[j]}` AS DOUBLE)"
    first = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{j}") for j, c in enumerate(cols)
                     for n, f in (("n", F.count), ("lo", F.min), ("hi", F.max))]).first()
    counts = [int(first[f"n{j}"]) for j in range(len(cols))]
    answer: dict[tuple[int, int], float] = {}
    # (column, rank) -> [lo, hi, rows below lo, rows inside]
    state = {(j, k): [first[f"lo{j}"], first[f"hi{j}"], 0, counts[j]]
             for j in range(len(cols)) for k in _targets(counts[j])}
    while state:
        small = [t for t, v in state.items() if v[3] <= listed]
        for t, values in zip(small, _listed(df, [(cols[t[0]], *state[t][:2]) for t in small]) if small else []):
            rank = state.pop(t)[2]
            for value, n in values:
                rank += n
                if t[1] < rank:
                    answer[t] = value
                    break
        if not state:
            break
        todo = list(state.items())
        inside = [f"{x(j)} >= {_dbl(v[0])} AND {x(j)} <= {_dbl(v[1])}" for (j, _), v in todo]
        part = [(k - v[2] + 0.5) / v[3] for (_, k), v in todo]
        cuts = df.agg(*[F.expr(
            f"percentile_approx(CASE WHEN {c} THEN {x(t[0])} END, "
            f"array({max(0.0, q - 2 / accuracy)}D, {min(1.0, q + 2 / accuracy)}D), {accuracy})").alias(f"q{i}")
            for i, ((t, _), c, q) in enumerate(zip(todo, inside, part))]).first()
        count = lambda when: f"count(CASE WHEN {when} THEN 1 END)"
        seen = df.agg(*[F.expr(e).alias(f"{name}{i}") for i, ((t, _), c) in enumerate(zip(todo, inside))
                        for name, e in (
                            ("a", count(f"{c} AND {x(t[0])} < {_dbl(cuts[f'q{i}'][0])}")),
                            ("b", count(f"{x(t[0])} = {_dbl(cuts[f'q{i}'][0])}")),
                            ("c", count(f"{c} AND {x(t[0])} <= {_dbl(cuts[f'q{i}'][1])}")),
                            ("d", count(f"{x(t[0])} = {_dbl(cuts[f'q{i}'][1])}")))]).first()
        for i, ((j, k), v) in enumerate(todo):
            low, high = cuts[f"q{i}"]
            under, at_low, upto, at_high = (seen[f"{name}{i}"] for name in "abcd")
            rank = k - v[2]
            if under <= rank < under + at_low:
                answer[j, k] = low
            elif upto - at_high <= rank < upto:
                answer[j, k] = high
            elif rank < under:            # the sketch was off: below both
                state[j, k] = [v[0], math.nextafter(low, -math.inf), v[2], under]
            elif rank >= upto:            # ... or above both
                state[j, k] = [math.nextafter(high, math.inf), v[1], v[2] + upto, v[3] - upto]
            else:
                state[j, k] = [math.nextafter(low, math.inf), math.nextafter(high, -math.inf),
                               v[2] + under + at_low, upto - at_high - under - at_low]
            if (j, k) in answer:
                del state[j, k]
    medians = [sum(answer[j, k] for k in _targets(n)) / len(_targets(n)) if n else None
               for j, n in enumerate(counts)]
    return medians, counts


@dataclass
class Statistics:
    """What the fit knows about its rows before the solver starts."""
    medians: list[float]
    means: list[float]
    scales: list[float]
    counts: list[int]
    classes: dict[int, int]
    weights: dict[int, float]
    n: int


def class_counts(df: DataFrame, target_col: str) -> tuple[dict[int, int], dict[int, float]]:
    """Rows and balanced weight n / (2 n_class) of class 0 and class 1."""
    y = label_column(target_col, df)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(y == 1, 1).otherwise(0)).alias("n1")).first()
    n, n1 = int(row["n"]), int(row["n1"] or 0)
    classes = {0: n - n1, 1: n1}
    return classes, {k: n / (2.0 * c) for k, c in classes.items() if c}


def statistics(work: DataFrame, params: ScoreParams) -> Statistics:
    """Medians, means and scales of the imputed features; class counts."""
    cols = list(params.feature_cols)
    medians, counts = exact_medians(work, cols, params.median_accuracy)
    classes, weights = class_counts(work, params.target_col)
    n = sum(classes.values())
    if n == 0:
        raise ValueError("no rows selected for the model (check the as-of date)")
    empty = [c for c, k in zip(cols, counts) if k == 0]
    if empty:
        raise ValueError(f"feature columns with no values at all: {empty}")
    imputed = [F.coalesce(F.col(c), F.lit(m)) for c, m in zip(cols, medians)]
    row = work.agg(*[F.avg(v).alias(f"m{j}") for j, v in enumerate(imputed)],
                   *[F.var_pop(v).alias(f"s{j}") for j, v in enumerate(imputed)]).first()
    means = [float(row[f"m{j}"]) for j in range(len(cols))]
    spread = [float(row[f"s{j}"] or 0.0) for j in range(len(cols))]
    scales = [1.0 if is_constant(v, m, n) else math.sqrt(v) for v, m in zip(spread, means)]
    return Statistics(medians, means, scales, counts, classes, weights, n)


def fit(df: DataFrame, params: ScoreParams = ScoreParams()) -> FittedModel:
    """G1-G7 over the selected rows; returns the fitted constants."""
    cols = list(params.feature_cols)
    check_features(df, cols)
    if params.target_col not in df.columns:
        raise ValueError(f"target column {params.target_col!r} is missing; "
                         "a model cannot be fitted without labels")
    work = coerce_features(df, cols)
    st = statistics(work, params)
    if not all(st.classes.values()):
        raise ValueError("the label has a single class; a classifier cannot be fitted")
    model = FittedModel(cols, st.medians, st.means, st.scales, [], 0.0, st.classes, st.weights, st.n)
    y = label_column(params.target_col, work)
    train = work.select(
        *[model.z(j, F.col(c)).alias(f"_z{j}") for j, c in enumerate(cols)],
        y.cast("double").alias("_label"),
        F.when(y == 1, F.lit(st.weights[1])).otherwise(F.lit(st.weights[0])).alias("_w"))
    if params.solver not in _SOLVERS:
        raise ValueError(f"solver must be one of {sorted(_SOLVERS)}")
    model.coefficients, model.intercept, model.iterations = _SOLVERS[params.solver](train, len(cols), st.n, params)
    return model


def _lbfgs_fit(train: DataFrame, k: int, n: int, params: ScoreParams):
    """Spark ML LogisticRegression: objective / sum(weights) with
    regParam = 1 / n, no extra standardisation (inputs are standardised)."""
    assembled = VectorAssembler(inputCols=[f"_z{j}" for j in range(k)],
                                outputCol="_features").transform(train)
    lr = LogisticRegression(featuresCol="_features", labelCol="_label", weightCol="_w",
                            regParam=1.0 / n, elasticNetParam=0.0, standardization=False,
                            fitIntercept=True, maxIter=params.max_iter, tol=params.tol,
                            family="binomial")
    fitted = lr.fit(assembled)
    return ([float(x) for x in fitted.coefficients.toArray()], float(fitted.intercept),
            int(fitted.summary.totalIterations))


def _moments(train: DataFrame, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and Hessian of the weighted log-likelihood at ``theta``
    (coefficients, then intercept), summed over all rows: every task adds up its
    rows as matrix products and sends one number a cell, Spark adds the cells."""
    k = len(theta) - 1
    upper = np.triu_indices(k + 1)
    size = 1 + (k + 1) + len(upper[0])

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            x = np.column_stack([batch.column(f"_z{j}").to_numpy(zero_copy_only=False) for j in range(k)]
                                + [np.ones(len(batch))])
            y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_label", "_w"))
            margin = x @ theta
            p = 1.0 / (1.0 + np.exp(-np.clip(margin, -700, 700)))
            total[0] += np.sum(w * (np.logaddexp(0.0, margin) - y * margin))
            total[1:k + 2] += x.T @ (w * (p - y))
            total[k + 2:] += (x.T @ (x * (w * p * (1.0 - p))[:, None]))[upper]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["cell", "v"])

    cells = train.mapInArrow(run, "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    sums = np.zeros(size)
    sums[cells["cell"].to_numpy()] = cells["v"].to_numpy()
    hessian = np.zeros((k + 1, k + 1))
    hessian[upper] = sums[k + 2:]
    return float(sums[0]), sums[1:k + 2], hessian + np.triu(hessian, 1).T


def _newton_fit(train: DataFrame, k: int, n: int, params: ScoreParams):
    """Newton's method on the penalised objective: the loss over all rows plus
    half the squared coefficients (not the intercept).  It is convex, so a step
    that does not lower it is halved; a few steps reach rounding error."""
    penalty = np.append(np.ones(k), 0.0)

    def at(theta):
        loss, gradient, hessian = _moments(train, theta)
        return loss + 0.5 * float(penalty @ theta ** 2), gradient + penalty * theta, hessian + np.diag(penalty)

    theta = np.zeros(k + 1)
    value, gradient, hessian = at(theta)
    for step in range(1, params.max_iter + 1):
        if np.max(np.abs(gradient)) <= 1e-12 * n:
            break
        move = np.linalg.solve(hessian, gradient)
        for _ in range(30):
            tried = at(theta - move)
            if tried[0] <= value + 1e-12 * abs(value):
                break
            move = move / 2
        theta = theta - move
        settled = np.max(np.abs(move)) <= 1e-13 * max(1.0, float(np.max(np.abs(theta))))
        value, gradient, hessian = tried
        if settled:
            break
    return [float(x) for x in theta[:k]], float(theta[k]), step


_SOLVERS = {"lbfgs": _lbfgs_fit, "newton": _newton_fit}


def gradient(df: DataFrame, model: FittedModel, params: ScoreParams = ScoreParams()) -> list[float]:
    """Gradient of the fit's objective (a row's mean) at the model's constants:
    one value a coefficient, then the intercept.  All zero at the optimum."""
    work = score(coerce_features(df, model.feature_cols), model, params)
    y = label_column(params.target_col, work)
    weight = F.when(y == 1, F.lit(model.weights[1])).otherwise(F.lit(model.weights[0]))
    pull = weight * (F.col("predicted_churn_probability_90d") - y)
    k = len(model.feature_cols)
    sums = work.agg(*[F.sum(pull * F.col(f"_z{j}")).alias(f"g{j}") for j in range(k)],
                    F.sum(pull).alias(f"g{k}")).first()
    penalties = [*model.coefficients, 0.0]
    return [(sums[f"g{j}"] + penalties[j]) / model.n for j in range(k + 1)]


def background_means(scored: DataFrame, model: FittedModel, size: int) -> list[float]:
    """Mean standardised features of a background sample: the ``size`` rows with
    the smallest hash of customer and date.  The same rows whatever the
    partitioning; every task keeps ``size`` rows at most."""
    key = F.md5(F.concat_ws("|", F.col(CUSTOMER_ID_COL).cast("string"), F.col(DATE_COL).cast("string")))
    sample = (scored.select(key.alias("_key"), *[f"_z{j}" for j in range(len(model.feature_cols))])
              .orderBy("_key").limit(size))
    row = sample.agg(*[F.avg(f"_z{j}").alias(f"m{j}") for j in range(len(model.feature_cols))]).first()
    return [float(row[f"m{j}"] or 0.0) for j in range(len(model.feature_cols))]


def against_background(scored: DataFrame, model: FittedModel, means: list[float]) -> DataFrame:
    """G9 with a background: contributions count from the background's mean row
    (``coef * (z - mean z)``) instead of from zero.  Scores do not change."""
    return scored.withColumns({f"_c{j}": F.col(f"_c{j}") - F.lit(model.coefficients[j]) * F.lit(m)
                               for j, m in enumerate(means)})


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage before the model's several passes: a reliable checkpoint
    in the cluster's shared checkpoint folder (never a local one)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def score(df: DataFrame, model: FittedModel, params: ScoreParams = ScoreParams()) -> DataFrame:
    """Adds _z{j}, _c{j} (contribution), probability, class, percent."""
    cols = model.feature_cols
    zs = {f"_z{j}": model.z(j, F.col(c)) for j, c in enumerate(cols)}
    df = df.withColumns(zs)
    cs = {f"_c{j}": F.lit(model.coefficients[j]) * F.col(f"_z{j}") for j in range(len(cols))}
    df = df.withColumns(cs)
    margin = F.lit(model.intercept)
    for j in range(len(cols)):
        margin = margin + F.col(f"_c{j}")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return df.withColumns({
        "predicted_churn_probability_90d": p,
    }).withColumns({
        "predicted_churn_90d": F.when(F.col("predicted_churn_probability_90d") >= params.decision_cut, 1)
        .otherwise(0),
        "predicted_churn_probability_90d_pct":
            F.bround(F.col("predicted_churn_probability_90d") * 100.0, 2),
    })
