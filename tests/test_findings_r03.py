"""Findings of round 3: work and memory of the timeline queries at size."""

import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fixtures import inv, order, spine_rows
from tidemark import queries as Q
from tidemark.functions.cadence import SMALL_CENTS, change_ratio, yoy_change
from tidemark.operators import snapshot as snap
from tidemark.operators import timeline as tl
from tidemark.session import COMPILED_METHOD


def test_tasks_grow_with_the_input(spark):
    i = snap.load_clean_inputs(spark, SF_SMALL)
    assert i.rows_in == sum(spark.read.parquet(f"{SF_SMALL}/{t}.parquet").count() for t in ("orders", "lineitem"))
    daily = tl.daily_rollup(i.invoices_signed, i.orders, i.backorders, rows_in=9 * tl.TASK_ROWS + 1)
    assert daily.rdd.getNumPartitions() == 10
    assert daily.count() == tl.daily_rollup(i.invoices_signed, i.orders, i.backorders).count()


def test_integer_sums_keep_no_sliding_frame(spark, capsys):
    daily = tl.daily_rollup(*[getattr(snap.load_clean_inputs(spark, SF_SMALL), k)
                              for k in ("invoices_signed", "orders", "backorders")])
    for c in ("w_rev_180", "w_neg_90", "w_ord_30", "w_maint_180", "w_contract", "w_fwd_90", "gap_sum2", "m_rev_6"):
        tl.timeline_features(daily).select(c).explain()
        assert not re.search(r"RangeFrame, -?\d+, -?\d+\)", capsys.readouterr().out), c


def test_methods_are_short_enough_to_be_compiled(spark):
    Q.cadence_snapshot(spark, SF_SMALL)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= COMPILED_METHOD


@pytest.mark.parametrize("cur, prev", [
    (100, 300), (-100, 300), (7, -3), (0, 11), (1, 3), (2 * SMALL_CENTS, 3), (-SMALL_CENTS, 7),
    (9 * 10 ** 18, -9 * 10 ** 18), (5, 9 * 10 ** 18), (None, 5), (5, None), (5, 0)])
def test_change_ratio_is_cut_at_six_decimals(spark, cur, prev):
    row = spark.createDataFrame([(cur, prev)], "cur long, prev long").select(
        change_ratio(F.col("cur"), F.col("prev")).alias("change"),
        yoy_change(F.col("cur"), F.col("prev")).alias("yoy")).first()

    def exact(c):
        if c is None or not prev:
            return None
        millionths = Fraction((c - prev) * 10 ** 6, prev)
        return int(millionths) / 1e6

    assert row["change"] == exact(cur)
    assert row["yoy"] == exact(cur or 0)


def test_totals_give_the_sums_of_windows_with_and_without_rows(spark):
    rows = spine_rows(spark, invoices=[inv(1, "2000-01-10", 100), inv(1, "2000-03-05", -40), inv(1, "2000-09-01", 7)],
                      orders=[order(1, "2000-03-20", rev="5"), order(1, "2000-12-02", rev="1")])
    r = rows[1, "2000-03-01"]
    assert (r["rev_180d"], r["m_rev_3"], r["m_rev_prev_3"], r["forward_rev_90d"]) == (100, 10000, None, -40)
    r = rows[1, "2000-12-01"]
    assert (r["m_rev_3"], r["m_rev_prev_3"], r["m_rev_6"], r["m_rev_ly"]) == (700, None, 700, None)
    assert (r["credit_notes_prev_month"], r["rev_returns_90d"], r["orders_net_30d"]) == (None, 0, None)


def _counted(spark, df):
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema), seen


def test_ranked_snapshot_is_computed_once(spark):
    rows = spark.range(500).select(F.col("id").alias("customer_id"), F.lit("2000-01-01").cast("date").alias("t0"),
                                   (F.col("id") % 2).cast("int").alias("churned_dynamic"),
                                   (F.col("id") % 7).cast("double").alias("severity_score"))
    df, seen = _counted(spark, rows)
    assert [r["position"] for r in snap.positioned(df).orderBy("position").collect()] == list(range(1, 501))
    assert seen.value == 500


def test_fixed_contributions_compute_their_rows_once(spark, monkeypatch):
    df, seen = _counted(spark, Q._latest(spark, SF_SMALL).localCheckpoint())
    monkeypatch.setattr(Q, "_latest", lambda *_: df)
    n = Q.fixed_contributions(spark, SF_SMALL).count()
    Q.fixed_contributions(spark, SF_SMALL).collect()
    assert n and seen.value == 2 * n
