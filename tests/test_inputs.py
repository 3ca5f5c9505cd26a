"""Inputs that the original tolerates: missing customers, boolean labels, NaN
features, bad dates; latest terms of a day; medians at any spread."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import inv, order, snapshot_rows, spine_rows
from tidemark.functions.phrases import phrase
from tidemark.params import ScoreParams
from tidemark.plans import model as M
from tidemark.plans.rules import business_rule


@pytest.mark.parametrize("value", [-0.04, -0.05, -0.25, -0.0123, -0.15, -0.35, -0.45, -0.75, -2.25, -12.45, -1e-9])
def test_percent_phrases_print_as_python_does(spark, value):
    df = spark.createDataFrame([(value, 1.0)], "v double, z double")
    got = df.select(phrase("pct_change_3m", F.col("v"), F.col("z"))).first()[0]
    assert got == "Change vs prior 3 months (%+.1f%%)" % value


def test_a_missing_customer_reaches_no_snapshot(spark):
    lines = [inv(None, day, "10") for day in ("2020-01-05", "2020-01-20", "2020-03-03")]
    lines += [inv(1, day, "10") for day in ("2020-01-05", "2020-01-20", "2020-03-03")]
    assert {k[0] for k in snapshot_rows(spark, lines)} == {1}


def test_latest_terms_are_those_of_the_highest_order_number(spark):
    lines = [inv(1, day, "1") for day in ("2020-01-10", "2020-01-20", "2020-02-03")]
    rows = spine_rows(spark, lines, [order(1, "2020-01-15", num="0000007", terms="Prepay"),
                                     order(1, "2020-01-15", num="0000009", terms="NET 90"),
                                     order(1, "2020-02-10", num="0000001", terms=None)])
    assert rows[(1, "2020-02-01")]["pay_terms"] == "net 90"
    assert rows[(1, "2020-02-01")]["terms_cycle_days"] == 90


def test_latest_terms_may_be_missing(spark):
    lines = [inv(1, day, "1") for day in ("2020-01-10", "2020-01-20", "2020-02-03")]
    row = spine_rows(spark, lines, [order(1, "2020-01-12", terms="prepay"),
                                    order(1, "2020-01-15", terms=None)])[(1, "2020-02-01")]
    assert row["pay_terms"] is None and row["terms_cycle_days"] is None
    assert row["last_order_date"] == dt.date(2020, 1, 15)


def test_boolean_labels_and_nan_features(spark):
    df = spark.createDataFrame([(True, 1.0), (False, float("nan")), (None, None), (True, 3.0)], "y boolean, x double")
    got = df.select(M.label_column("y", df).alias("y")).collect()
    assert [r.y for r in got] == [1, 0, 0, 1]
    assert M.class_counts(df, "y") == ({0: 2, 1: 2}, {0: 1.0, 1: 1.0})
    work = M.coerce_features(df, ["x"])
    assert M.exact_medians(work, ["x"]) == ([2.0], [2])


def test_a_bad_date_counts_as_missing(spark):
    df = spark.createDataFrame([("2001-09-01", 0), ("soon", 0), (None, 1)], "as_of_date string, in_renewal_grace int")
    got = business_rule(df, "2001-10-01", ScoreParams()).collect()
    assert [r.days_since_last_purchase_today for r in got] == [30, None, None]


def test_medians_of_values_over_many_magnitudes(spark):
    rnd = np.random.default_rng(3)
    wide = [float(x) for x in 10.0 ** rnd.uniform(-300, 300, 6001)]
    ties = [0.0] * 3001 + [math.pi] * 3000
    half = [-5.0] * 3000 + [7.0] * 3000 + [None]
    df = spark.createDataFrame(list(zip(wide, ties, half)), "a double, b double, c double").repartition(4)
    got, counts = M.exact_medians(df, ["a", "b", "c"], accuracy=100, listed=16)
    assert got == [float(np.median(wide)), 0.0, 1.0]
    assert counts == [6001, 6001, 6000]
