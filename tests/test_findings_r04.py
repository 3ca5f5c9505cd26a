"""Findings of round 4: disk of the stored and the ranked snapshot at size."""

import datetime as dt
import math
import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark import session
from tidemark.operators import snapshot as snap
from tidemark.operators import store
from tidemark.operators import timeline as tl

KEYS = ["churned_dynamic", "severity_score", "customer_id", "t0"]


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def gone(spark, before, seconds=10):
    """No shuffle file is there that was not there before (deleting is asynchronous)."""
    until = time.time() + seconds
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return not left


def table_folders(spark):
    """Folders with files of checkpoints or tables in the scratch folder."""
    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return {r for r, _, files in os.walk(top) if any(f.startswith("part-") for f in files)}


def odd_rows(spark, n=3000):
    r = random.Random(4)
    scores = [None, math.nan, 0.0, -0.0, math.inf, -math.inf, 1.5, 2.5, 40.1]
    return spark.createDataFrame(
        [(r.choice([None, 0, 1]), r.choice(scores), r.choice([None, *range(40)]),
          r.choice([None, dt.date(2000, r.randint(1, 12), 1)]), i) for i in range(n)],
        "churned_dynamic int, severity_score double, customer_id long, t0 date, i long")


def test_ranked_snapshot_is_stored_once_and_keeps_no_shuffle_files(spark):
    built = snap.build_snapshot(spark, SF_SMALL)
    shuffles, tables = shuffle_files(spark), table_folders(spark)
    rows = snap.positioned(built)
    assert gone(spark, shuffles)
    assert len(table_folders(spark) - tables) == 1
    n = rows.count()
    assert [r.position for r in rows.select("position").collect()] == list(range(1, n + 1))


def test_positions_of_many_stretches_with_nulls_and_ties(spark, monkeypatch):
    monkeypatch.setattr(snap, "STRETCH_ROWS", 50)
    df = odd_rows(spark)
    plain = lambda rows: [tuple("nan" if isinstance(r[c], float) and math.isnan(r[c]) else r[c] for c in KEYS)
                          for r in rows]
    found = snap.positioned(df)
    assert found.rdd.getNumPartitions() > 40
    rows = found.collect()
    assert [r.position for r in rows] == list(range(1, 3001))
    assert plain(rows) == plain(snap.ranked(df).collect())
    assert sorted(r.i for r in rows) == list(range(3000))
    one = odd_rows(spark, 1)
    assert [r.position for r in snap.positioned(one).collect()] == [1]
    assert snap.positioned(one.limit(0)).columns == [*one.columns, "position"]


def test_probes_are_made_behind_the_exchange(spark, capsys):
    i = snap.load_clean_inputs(spark, SF_SMALL)
    snap.daily_rollup(i.invoices_signed, i.orders, i.backorders).explain()
    plan = capsys.readouterr().out
    merged = plan[:plan.index("Exchange hashpartitioning(customer_id")]
    assert "Generate explode" in merged


def test_the_switch_for_shuffle_files_is_put_back(spark):
    before = spark.conf.get(session.SHUFFLE_CLEANUP, None)
    with session.shuffles_deleted(spark):
        assert spark.conf.get(session.SHUFFLE_CLEANUP) == "true"
    assert spark.conf.get(session.SHUFFLE_CLEANUP, None) == before


def test_a_published_snapshot_is_all_that_stays(spark, tmp_path):
    rows = snap.build_snapshot(spark, SF_SMALL).localCheckpoint()
    shuffles = shuffle_files(spark)
    done = store.publish(rows.repartition(6, "t0"), str(tmp_path))
    assert gone(spark, shuffles)
    assert {n for n in os.listdir(tmp_path) if not n.startswith(".")} == {done.version, store.POINTER}
    months = [d for d in os.listdir(tmp_path / done.version) if d.startswith("month=")]
    assert len(months) == rows.select("t0").distinct().count()
    assert all(len([f for f in os.listdir(tmp_path / done.version / m) if f.endswith(".parquet")]) <= store.FILES
               for m in months)
    with pytest.raises(store.SnapshotRefused):
        store.publish(rows.unionByName(rows.limit(1)), str(tmp_path))
    assert {n for n in os.listdir(tmp_path) if not n.startswith(".")} == {done.version, store.POINTER}


def test_a_refresh_of_many_customers_joins_them_behind_the_exchange(spark, tmp_path, monkeypatch):
    path, days = str(tmp_path), {"invoices": "tx_date", "invoices_signed": "tx_date", "orders": "order_date",
                                 "backorders": "bo_date"}
    every, cut = snap.load_clean_inputs(spark, SF_SMALL), F.lit("2001-05-10").cast("date")
    part = lambda keep: snap.CleanInputs(**{k: getattr(every, k).filter(keep(F.col(d))) for k, d in days.items()})
    store.publish(snap.cadence_snapshot(snap.spine_features(part(lambda d: d < cut))), path)
    monkeypatch.setattr(store, "BROADCAST_CUSTOMERS", 0)
    shuffles = shuffle_files(spark)
    done = store.refresh(spark, path, every, part(lambda d: d >= cut))
    assert gone(spark, shuffles)
    rows = lambda df: sorted(map(tuple, df.select(*snap.SNAPSHOT_COLUMNS).collect()), key=str)
    assert rows(store.read(spark, path)) == rows(snap.build_snapshot(spark, SF_SMALL))
    assert done.version in os.listdir(path) and not any("-" in n[2:] for n in os.listdir(path) if n.startswith("v-"))


@pytest.mark.parametrize("rows_in", [None, 9 * tl.TASK_ROWS + 1])
def test_customers_of_a_refresh_need_no_further_exchange_of_the_days(spark, tmp_path, capsys, monkeypatch, rows_in):
    i = snap.load_clean_inputs(spark, SF_SMALL)
    spark.range(0, 100, 3).toDF("customer_id").write.parquet(str(tmp_path / "c"))
    some = spark.read.parquet(str(tmp_path / "c"))
    found = tl.daily_rollup(i.invoices_signed, i.orders, i.backorders, rows_in, some.union(some))
    found.explain()
    plan = capsys.readouterr().out
    above = plan[:plan.index("Union")]      # the days of all feeds
    assert len(re.findall(r"Exchange hashpartitioning", above)) == 1, plan
    assert rows_in is None or "10), REPARTITION_BY_NUM" in above
    every = tl.daily_rollup(i.invoices_signed, i.orders, i.backorders)
    key = lambda df: sorted((r.customer_id, r.day, str(r.probe), str(r.inv_net)) for r in df.collect())
    assert key(found) == key(every.filter("customer_id < 100 AND customer_id % 3 = 0"))


def test_probes_since_a_month_give_the_same_rows(spark):
    i = snap.load_clean_inputs(spark, SF_SMALL)
    since = dt.date(1997, 4, 1)
    some = snap.cadence_snapshot(snap.spine_features(i, since=since))
    every = snap.cadence_snapshot(snap.spine_features(i)).filter(F.col("t0") >= F.lit(since))
    assert some.count() and not some.exceptAll(every).count() and not every.exceptAll(some).count()
