"""Parquet table access.  Column lists are passed so that the scan's
ReadSchema holds only what a query uses (Catalyst would prune anyway; being
explicit keeps the contract visible).  The schema comes from the table itself
at every read, so a table rewritten in place is read as it is now."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df
