"""Text extracts: typed feeds, bad records, counts that add up."""

import pytest

from conftest import SF_SMALL
from tidemark.operators import snapshot as snap
from tidemark.sources import clean_backorders, clean_invoices, clean_orders, extracts, raw_feeds

HEAD = "Sold-To,Billing Date,Posting Date,Local Net Value,+/-,Bill# Doc# Cancelled,Cancelled Billing Doc#,Sales Org\n"


def billing(tmp_path, *lines, head=HEAD):
    path = tmp_path / "billing"
    path.mkdir()
    (path / "a.csv").write_text(head + "".join(x + "\n" for x in lines))
    return str(path)


def test_rows_are_typed_or_kept_as_bad_records(spark, tmp_path):
    path = billing(tmp_path, '1,2001-02-03,,"1,5",-,,0,US01', " 2 ,2001-02-03,2001-02-04,x,,X,0,US01",
                   "C3,2001-02-03,,1,,,0,US01", "4,2001-02-30,,1,,,0,US01", "5,2001-02-03,,1", "6,,,1,,,0,US01",
                   "7,2001-02-03,soon,1,,,0,US01", "8,2001-02-03,,1,,,none,US01", "9,2001-02-03,,1,,,1,DE01",
                   "10,2001-02-03,,1,,,0,DE01")
    feed, bad = extracts.read_extract(spark, extracts.BILLING, path)
    assert sorted(r.customer_id for r in feed.collect()) == [1, 2, 6, 9, 10]
    assert {(r.reason) for r in bad.collect()} == {
        "customer_id: not a bigint", "billing_date: not a date", "malformed row", "posting_date: not a date",
        "cancelled_billing_doc: not a int"}
    assert all(r.feed == "billing" and r.record for r in bad.collect())
    got = {(r.outcome, r.reason): r.n_rows for r in extracts.audit(spark, extracts.BILLING, path).collect()}
    assert got == {("kept", ""): 1, ("filtered", "cancelled"): 1, ("filtered", "no billing date"): 1,
                   ("filtered", "cancelled billing document"): 1, ("filtered", "other organisation"): 1,
                   ("quarantined", "malformed row"): 1, ("quarantined", "customer_id: not a bigint"): 1,
                   ("quarantined", "billing_date: not a date"): 1, ("quarantined", "posting_date: not a date"): 1,
                   ("quarantined", "cancelled_billing_doc: not a int"): 1}


def test_another_layout_is_an_error(spark, tmp_path):
    path = billing(tmp_path, "1,2,3", head="Sold-To,Date,Value\n")
    with pytest.raises(Exception):
        extracts.read_extract(spark, extracts.BILLING, path)[0].collect()


def test_an_empty_extract_gives_nothing(spark, tmp_path):
    path = billing(tmp_path)
    feed, bad = extracts.read_extract(spark, extracts.BILLING, path)
    assert feed.count() == bad.count() == extracts.audit(spark, extracts.BILLING, path).count() == 0


def test_a_snapshot_from_extracts_equals_one_from_the_feeds(spark, tmp_path):
    feeds, read = raw_feeds(spark, SF_SMALL), []
    layouts = (extracts.BILLING, extracts.ORDERS, extracts.BACKORDERS)
    for layout, feed in zip(layouts, feeds):
        path = str(tmp_path / layout.name)
        extracts.write_extract(feed, layout, path)
        got, bad = extracts.read_extract(spark, layout, path)
        assert bad.count() == 0
        read.append(got)
        clean = {"billing": clean_invoices, "orders": clean_orders, "backorders": clean_backorders}[layout.name]
        kept = extracts.audit(spark, layout, path).filter("outcome = 'kept'").first().n_rows
        assert kept == clean(got).count() == clean(feed).count()
    again = snap.cadence_snapshot(snap.spine_features(snap.clean_inputs(*read)))
    want = snap.build_snapshot(spark, SF_SMALL)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, want.collect()))
