"""The driver contract in __spark_entry__.py."""

from pyspark.sql import DataFrame

import __spark_entry__ as E
from tidemark.operators.snapshot import SNAPSHOT_SCHEMA


def test_entry_runs_the_snapshot(spark):
    df = E.entry(spark)
    assert isinstance(df, DataFrame)
    assert df.schema.simpleString() == SNAPSHOT_SCHEMA.simpleString()
    assert df.count() > 0


def test_every_oracle_has_a_query():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(isinstance(v, str) and v.strip() for v in s.values())

