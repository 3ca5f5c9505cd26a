"""Report sinks: CSV with header (I8), table modes append / replace / fail."""

import datetime as dt

import pytest

from conftest import SF_SMALL
from tidemark.operators import snapshot as snap
from tidemark.plans import churn, report


@pytest.fixture(scope="module")
def rep(spark):
    s = snap.build_snapshot(spark, SF_SMALL)
    return churn.prediction_report(s, today=dt.date(2001, 10, 1),
                                   created_on=dt.datetime(2002, 1, 1, 9, 0, 0)).cache()


def test_csv_sink(spark, rep, tmp_path):
    path = str(tmp_path / "pred_csv")
    report.write_csv(rep, path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == rep.columns
    assert back.count() == rep.count()


def test_table_modes(spark, rep):
    n = rep.count()
    report.write_table(rep, "pred_tbl")                      # replace (default)
    assert spark.table("pred_tbl").count() == n
    assert "CreatedOn" in spark.table("pred_tbl").columns
    report.write_table(rep, "pred_tbl", if_exists="append")
    assert spark.table("pred_tbl").count() == 2 * n
    report.write_table(rep, "pred_tbl", if_exists="replace")
    assert spark.table("pred_tbl").count() == n
    with pytest.raises(Exception):
        report.write_table(rep, "pred_tbl", if_exists="fail")
    with pytest.raises(ValueError):
        report.write_table(rep, "pred_tbl", if_exists="merge")
