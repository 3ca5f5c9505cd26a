"""Session helpers: a local session for tests and the bench, and the
checkpoint directory rule (use the cluster's shared folder; only pick a
local scratch folder when running in local mode and nothing is set)."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, shuffle_partitions: int | None = None,
                  app: str = "tidemark") -> SparkSession:
    parts = shuffle_partitions or (int(cpus) if str(cpus).isdigit() else 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # no Python call-site capture per Column call: it costs several JVM
        # round trips each and the snapshot plan is built from ~1k calls
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: bytecode of a method up to which HotSpot compiles it
COMPILED_METHOD = 8000


def short_methods(spark: SparkSession) -> None:
    """Let no generated method grow beyond what HotSpot compiles.

    The snapshot's derived columns are one long projection.  As one method it
    stays interpreted, several times slower; above this limit Spark evaluates it
    in short methods instead.  A smaller limit that is set already stays.
    """
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) > COMPILED_METHOD:
        spark.conf.set(limit, str(COMPILED_METHOD))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is used
    as is.  Only a local-mode session with nothing configured gets a fresh
    scratch folder (as in tests).  A cluster without one is an error: a
    machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master != "local" and not sc.master.startswith("local["):   # local-cluster has executors
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(for example on the cluster's distributed file system)")
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


#: Spark's switch for what ``shuffles_deleted`` does
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside are deleted when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and the
    next query's files come on top.  For queries whose result is written.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: computed once, its shuffle files deleted."""
    with shuffles_deleted(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
