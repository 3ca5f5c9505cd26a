"""Connected components of a link table by Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex of the component of every vertex in
    ``links`` (a, b).  Each round takes the smallest label among the
    neighbours and then the label of the label; it ends when nothing changes
    (one count a round reaches the driver)."""
    both = materialise(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                       "links")
    written = materialise(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label"))
                          .withColumnRenamed("a", "v"), "labels")
    labels = written
    while True:
        near = (both.join(labels.withColumnRenamed("v", "b"), "b").groupBy("a")
                .agg(F.min("label").alias("near")).withColumnRenamed("a", "v"))
        step = labels.join(near, "v").select("v", "label", F.least("label", "near").alias("best"))
        top = labels.select(F.col("v").alias("best"), F.col("label").alias("top"))
        step = materialise(step.join(top, "best").select(
            "v", F.least("best", "top").alias("label"), (F.least("best", "top") != F.col("label")).alias("moved")),
            "labels")
        discard(written)
        written, labels = step, step.select("v", "label")
        if step.filter("moved").isEmpty():
            discard(both)
            return labels
