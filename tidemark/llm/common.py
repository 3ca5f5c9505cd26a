"""Shared helpers: columns of ``documents``, tables in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ensure_checkpoint_dir

#: words of the contracts: runs of bytes other than ASCII white space
WORD_GAP = "[\\x20\\x09-\\x0D]+"
A_Z, a_z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_written: ContextVar[list[DataFrame] | None] = ContextVar("written", default=None)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage at a table that survives the loss of any executor.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_at = path
    if (tables := _written.get()) is not None:
        tables.append(table)
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` from which nothing is read any more: all
    that was made of them has been written, too."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def last_table_stays() -> Iterator[None]:
    """Of the tables of ``materialise`` written inside, all but the last are
    deleted at the end; after an error they stay."""
    tables: list[DataFrame] = []
    token = _written.set(tables)
    try:
        yield
    finally:
        _written.reset(token)
    discard(*tables[:-1])


def aside(docs: DataFrame, needed: tuple[str, ...], used: set[str],
          run: Callable[[DataFrame], DataFrame], added: tuple[str, ...]) -> DataFrame:
    """``run(docs)``, whose other columns may have the names ``used`` inside.

    Where one has (or has a dot, which Arrow functions refuse), all but the ``needed`` columns travel in one struct. A column
    named like one of those ``added`` gives way to it.
    """
    others = [c for c in docs.columns if c not in (*needed, *added)]
    if not (used | set(added)) & set(docs.columns) and not any("." in c for c in others):
        return run(docs)
    packed = docs.select(*needed, F.struct(F.lit(0).alias("c"), *[
        F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("_rest"))
    out = run(packed)
    back = {c: F.col(f"_rest.c{i}").alias(c) for i, c in enumerate(others)}
    return out.select(*[back.get(c, c) for c in docs.columns if c in back or (c in out.columns and c not in added)], *added)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other code point stays."""
    return F.translate(text, A_Z, a_z)


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it
    (a cluster that has it installed finds its own copy all the same)."""
    import os
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join(p for p in [*paths, root] if p)
