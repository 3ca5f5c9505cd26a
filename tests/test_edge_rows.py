"""Hand-worked edge rows (FIXTURES.md section 4)."""

from decimal import Decimal

import pytest

from fixtures import backorder, feeds, inv, order, snapshot_rows, spine_rows
from tidemark.operators import snapshot as snap
from tidemark.params import CadenceParams


def test_posting_date_preferred_and_sign_rules(spark):
    i, o, b = feeds(spark, [
        inv(1, "2020-01-10", "100.00", "+", posting="2020-01-12"),
        inv(1, "2020-01-10", "-40.00", " "),          # blank sign keeps the negative
        inv(1, "2020-01-11", "30.00", "-"),           # '-' forces negative
        inv(1, "2020-01-11", "5.00", " ", cancelled="X"),   # cancelled: dropped
        inv(1, "2020-01-11", "5.00", " ", cancel_doc=1),    # cancelled doc: dropped
        inv(1, "2020-01-11", "5.00", " ", org="DE01"),      # other org: dropped
        inv(1, "2020-01-11", "7.00", " ", cancelled="  "),  # trailing blanks == ''
    ])
    c = snap.clean_inputs(i, o, b)
    got = sorted((r["tx_date"].isoformat(), r["amt_local_signed"]) for r in c.invoices_signed.collect())
    assert got == [("2020-01-10", Decimal("-40.00")), ("2020-01-11", Decimal("-30.00")),
                   ("2020-01-11", Decimal("7.00")), ("2020-01-12", Decimal("100.00"))]


def test_order_text_cleaning(spark):
    i, o, b = feeds(spark, orders=[
        order(1, "2020-01-05", num="123456  ", rev="-1,234.50"),
        order(1, "2020-01-06", num="12345678", rev="abc"),
        order(1, "2020-01-07", rev="10", reject="   "),       # blank reject code kept
        order(1, "2020-01-08", rev="10", reject="Z1"),        # rejected: dropped
        order("x1", "2020-01-09", rev="10"),                  # bad customer id: dropped
    ])
    rows = sorted(snap.clean_inputs(i, o, b).orders.collect(), key=lambda r: r["order_date"])
    assert len(rows) == 3
    assert rows[0]["planned_revenue"] == Decimal("1234.50") and rows[0]["is_tech"] == 1
    assert rows[1]["planned_revenue"] is None and rows[1]["is_maint"] == 1
    assert rows[2]["is_tech"] == 0 and rows[2]["is_maint"] == 0


def test_single_invoice_day_has_no_snapshot_row(spark):
    rows = snapshot_rows(spark, [inv(1, "2020-01-10", "10"), inv(1, "2020-01-10", "5")],
                         [order(1, "2020-03-03")])
    assert rows == {}


def test_two_invoice_days_one_gap(spark):
    rows = snapshot_rows(spark, [inv(1, "2020-01-10", "10"), inv(1, "2020-01-20", "5")],
                         [order(1, "2020-02-03")])
    r = rows[(1, "2020-02-01")]
    assert r["median_gap_days"] == 10 and r["p90_gap_days"] == 10 and r["cv_gap"] is None
    assert r["recency_days"] == 12


def test_window_edges(spark):
    # t0 = 2020-07-01 (probe from the order); 180 days before = 2020-01-03
    invs = [inv(1, "2020-01-02", "1"),    # t0-181: out of rev_180d
            inv(1, "2020-01-03", "2"),    # t0-180: in
            inv(1, "2020-07-01", "4"),    # t0: not trailing, is forward
            inv(1, "2020-09-28", "8"),    # t0+89: in forward
            inv(1, "2020-09-29", "16")]   # t0+90: out
    rows = spine_rows(spark, invs, [order(1, "2020-07-15")])
    r = rows[(1, "2020-07-01")]
    assert r["rev_180d"] == Decimal("2.00")
    assert r["forward_rev_90d"] == Decimal("12.00")


def test_gap_lookback_edge(spark):
    # t0 = 2022-01-01; lookback starts 2020-01-01
    invs = [inv(1, "2019-12-20", "1"), inv(1, "2020-01-01", "1"),   # gap ends on t0-24m: in
            inv(1, "2021-12-01", "1")]
    rows = spine_rows(spark, invs, [order(1, "2022-01-05")])
    assert rows[(1, "2022-01-01")]["gap_n"] == 2
    invs = [inv(1, "2019-12-20", "1"), inv(1, "2019-12-31", "1"),   # one day earlier: out
            inv(1, "2021-12-01", "1")]
    rows = spine_rows(spark, invs, [order(1, "2022-01-05")])
    assert rows[(1, "2022-01-01")]["gap_n"] == 1


def test_contract_grace_edges(spark):
    invs = [inv(1, "2020-01-02", "1")]
    in30 = spine_rows(spark, invs, [order(1, "2019-06-01", end="2020-01-31")])
    in31 = spine_rows(spark, invs, [order(1, "2019-06-01", end="2020-02-01")])
    before = spine_rows(spark, invs, [order(1, "2019-06-01", start="2019-12-02")])
    assert in30[(1, "2020-01-01")]["in_renewal_grace"] == 1
    assert in31[(1, "2020-01-01")]["in_renewal_grace"] == 0
    assert before[(1, "2020-01-01")]["in_renewal_grace"] == 1


def test_orders_net_split(spark):
    invs = [inv(1, "2020-03-02", "1")]
    rows = spine_rows(spark, invs, [order(1, "2020-02-10", rev="-100"), order(1, "2020-02-20", rev="150")])
    r = rows[(1, "2020-03-01")]
    assert r["orders_pos_30d"] == Decimal("0.00") and r["orders_neg_30d"] == Decimal("50.00")
    r = rows[(1, "2020-02-01")]      # no orders before t0 in 30 days
    assert r["orders_pos_30d"] == Decimal("0.00") and r["orders_neg_30d"] == Decimal("0.00")


def test_backorders_keep_rejected_lines(spark):
    invs = [inv(1, "2020-03-02", "1")]
    rows = spine_rows(spark, invs, [], [backorder(1, "2020-02-15", "1,500"),
                                        backorder(1, "2020-02-16", "7", reject="")])
    assert rows[(1, "2020-03-01")]["backorder_qty_30d"] == 1500.0


@pytest.mark.parametrize("terms,cycle", [("Net 30 annual", 30), ("prepay", 9999), ("Quarterly", 90),
                                         ("yearly", 365), ("whatever", None)])
def test_pay_term_cycle(spark, terms, cycle):
    invs = [inv(1, "2020-01-10", "1"), inv(1, "2020-01-20", "1"), inv(1, "2020-02-03", "1")]
    rows = spine_rows(spark, invs, [order(1, "2020-01-15", terms=terms)])
    r = rows[(1, "2020-02-01")]
    assert r["terms_cycle_days"] == cycle
    assert r["maint_cycle_days"] == (cycle if cycle is not None else 10)


def test_prepay_threshold_and_grace(spark):
    invs = [inv(1, "2020-01-10", "1"), inv(1, "2020-01-20", "1"), inv(1, "2020-02-03", "1")]
    plain = spine_rows(spark, invs, [order(1, "2020-01-15", terms="prepay")])
    grace = spine_rows(spark, invs, [order(1, "2020-01-15", terms="prepay", end="2020-02-10")])
    assert plain[(1, "2020-02-01")]["threshold_days"] == 11999
    assert grace[(1, "2020-02-01")]["threshold_days"] == 12029


def test_threshold_floor_and_recency_equal(spark):
    # consecutive days: median gap 1 -> cycle 1 -> round(1.2) = 1 -> floor 14
    invs = [inv(1, "2020-01-01", "1"), inv(1, "2020-01-02", "1"), inv(1, "2020-01-18", "1")]
    rows = snapshot_rows(spark, invs, [order(1, "2020-02-01")])
    r = rows[(1, "2020-02-01")]
    assert r["threshold_days"] == 14 and r["recency_days"] == 14 and r["churned_dynamic"] == 0
    assert r["churn_reason_dynamic"] is None


def test_trend_ratios_null_rules(spark):
    # previous 3 months revenue 0 -> NULL; no rows in last 3 months -> NULL, not -1
    invs = [inv(1, "2020-01-10", "100"), inv(1, "2020-01-11", "-100"),   # Jan net 0
            inv(1, "2020-05-05", "10")]
    rows = spine_rows(spark, invs, [])
    assert rows[(1, "2020-05-01")]["pct_change_3m"] is None   # prev 3m (Nov-Jan) net 0
    invs = [inv(1, "2020-01-10", "100"), inv(1, "2020-07-05", "10")]
    rows = spine_rows(spark, invs, [])
    r = rows[(1, "2020-07-01")]      # last 3m (Apr-Jun) empty, previous (Jan-Mar) present
    assert r["pct_change_3m"] is None
    assert r["pct_change_6m"] is None   # prev 6m (Jul-Dec 2019) empty


def test_credits_zero_without_revenue_and_hard_label(spark):
    invs = [inv(1, "2020-01-10", "50"), inv(1, "2020-01-11", "-50"), inv(1, "2020-01-20", "5"),
            inv(1, "2020-01-21", "-5"),
            inv(1, "2020-03-03", "20"), inv(1, "2020-03-04", "-20")]
    rows = snapshot_rows(spark, invs, [order(1, "2020-02-05")])
    r = rows[(1, "2020-02-01")]
    assert r["rev_180d"] == Decimal("0.00") and r["rev_returns_90d"] == Decimal("55.00")
    assert r["credits_component"] == 0.0
    r = rows[(1, "2020-03-01")]
    assert r["churned_hard90"] == 1      # forward net 0 counts as churned
    assert r["churn_reason_hard90"] == "No positive posted revenue in the 90 days after t0"


def test_k_mult_does_not_change_snapshot(spark):
    invs = [inv(1, "2020-01-01", "1"), inv(1, "2020-01-09", "1"), inv(1, "2020-02-20", "1"),
            inv(2, "2020-01-05", "3"), inv(2, "2020-03-05", "-1"), inv(2, "2020-04-15", "2")]
    ords = [order(1, "2020-04-01", terms="monthly"), order(2, "2020-05-01")]
    a = snapshot_rows(spark, invs, ords, params=CadenceParams(k_mult=2.0))
    b = snapshot_rows(spark, invs, ords, params=CadenceParams(k_mult=5.0))
    assert a == b and len(a) > 0


def test_reason_text_and_codes(spark):
    invs = [inv(1, "2020-01-01", "100"), inv(1, "2020-01-02", "100"),
            inv(1, "2020-02-01", "-30"), inv(1, "2020-05-01", "1")]
    rows = snapshot_rows(spark, invs, [], [backorder(1, "2020-04-20", "12")])
    r = rows[(1, "2020-05-01")]
    assert r["churned_dynamic"] == 1
    assert r["churn_reason_dynamic"].startswith("Late vs cadence: recency 90d > threshold ")
    assert "; 0 invoices in prior 90d" in r["churn_reason_dynamic"]
    assert "; backorders_30d=12" in r["churn_reason_dynamic"]
    assert r["churn_reason_code_dynamic"].startswith("RECENCY_GT_")
    assert "|NO_INV_90D" in r["churn_reason_code_dynamic"]
    assert 0.0 <= r["severity_score"] <= 100.0


def test_float_text(spark):
    from pyspark.sql import functions as F
    from tidemark.functions.cadence import sql_float_text
    vals = [12.0, 1500.0, 0.5, 1234567.0, 123.456789, 0.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(sql_float_text(F.col("x"))).collect()]
    assert got == ["12", "1500", "0.5", "1.23457e+006", "123.457", "0"]
