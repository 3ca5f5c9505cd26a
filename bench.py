"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is forced end to end with the ``noop`` sink (every row is
computed, nothing is collected to the driver).  The scoring queries read
the snapshot from a written table, as the production flow does (build ->
write -> score), so they time the scoring stage on its own.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from tidemark.operators import snapshot as snap  # noqa: E402
from tidemark.params import ScoreParams  # noqa: E402
from tidemark.plans import churn  # noqa: E402
from tidemark.plans.select import model_rows  # noqa: E402
from tidemark import queries as Q  # noqa: E402
from tidemark.session import ensure_checkpoint_dir, local_session  # noqa: E402


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="tidemark-bench")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t, 3)

    # stage 1: snapshot build (the flagship) and its operator groups
    timed("cadence_snapshot", lambda: _run(snap.build_snapshot(spark, sf_dir)))
    for name in ["spine_months", "recency_asof", "gap_stats", "revenue_windows",
                 "month_trends", "renewal_grace", "latest_terms_asof"]:
        timed(name, lambda n=name: _run(Q.ALL_QUERIES[n](spark, sf_dir)))

    # full refresh of the snapshot table, then the scoring stage reads it
    # written into the session's reliable (shared) checkpoint folder
    path = ensure_checkpoint_dir(spark).rstrip("/") + "/bench-snapshot"
    timed("snapshot_write", lambda: snap.write_snapshot(snap.build_snapshot(spark, sf_dir), path))
    stored = snap.read_snapshot(spark, path)      # months of the published version
    timed("latest_snapshot_per_customer", lambda: _run(model_rows(stored)))
    timed("prediction_report", lambda: _run(churn.prediction_report(
        stored, ScoreParams(), today=dt.date(2001, 10, 1),
        created_on=dt.datetime(2001, 12, 1, 8, 0, 0))))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
