"""Plan-shape checks: a row of the snapshot is shuffled twice and stays in the
JVM, and its scans read only what they need."""

import re

from conftest import SF_SMALL
from tidemark.operators import snapshot as snap
from tidemark.plans.select import model_rows
from tidemark.queries import ALL_QUERIES
from tidemark.sources.tables import read_table


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hash_keys(plan: str) -> list[str]:
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    return [", ".join(k.strip() for k in re.sub(r"#\d+L?", "", x).split(",")[:-1]) for x in keys]


def test_a_row_is_shuffled_twice_and_stays_in_the_jvm(spark):
    """One exchange a feed by (customer, day), one by customer for all; what
    else is there belongs to the adapter's join of lineitem and orders."""
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (saved, "-1"):      # also as at scale, where nothing is broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            plan = _plan(snap.build_snapshot(spark, SF_SMALL))
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
        keys = [re.sub(r"_groupingexpression|at\.day", "day", k) for k in _hash_keys(plan)]
        ours = [k for k in keys if "orderkey" not in k]
        assert sorted(ours) == ["customer_id"] + ["customer_id, day"] * 3, keys
        assert plan.count("SortMergeJoin") == (limit == "-1")
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
            assert node not in plan, node
        assert "partial_sum" in plan and "partial_max" in plan


def test_feeds_that_are_not_needed_are_not_read(spark):
    plan = _plan(ALL_QUERIES["purchase_gaps"](spark, SF_SMALL))
    assert plan.count("FileScan") == 2      # lineitem, and orders for the adapter's join
    assert sorted(k for k in _hash_keys(plan) if "orderkey" not in k)[0] == "customer_id"


def test_scans_are_pruned_and_pushed(spark):
    plan = _plan(snap.build_snapshot(spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    assert all("l_comment" not in s and "o_comment" not in s for s in schemas)
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan


def test_latest_row_reuses_the_customer_partitioning(spark):
    plan = _plan(model_rows(snap.build_snapshot(spark, SF_SMALL), "churned_hard90", "2001-12-01"))
    # the per-customer max(struct) runs on the window's customer_id partitioning
    assert len([k for k in _hash_keys(plan) if "orderkey" not in k]) == 4
    assert "max(" in plan


def test_a_rewritten_table_is_read_anew(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(3).write.parquet(path)
    assert read_table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(2).selectExpr("id AS other", "'x' AS more").write.mode("overwrite").parquet(path)
    assert read_table(spark, str(tmp_path), "t").columns == ["other", "more"]
