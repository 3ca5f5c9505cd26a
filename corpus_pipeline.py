"""Corpus pipeline: five stages over ``documents``, each one of the operators.

A stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it
as Parquet into the shared folder and reads it back as the next stage's docs.
What a stage has written on its way, and its input, are deleted behind it.
Every stage but the last returns all columns of its input, in their order.

Rows are followed by doc_id.  Rows that share a doc_id share its verdict in
stages 2 and 4; of rows equal in doc_id and text one stays in stage 2.  Null
doc_ids are matched as equal.  Empty input gives empty output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, jaccard_join, kneser_ney, suffix_dedup
from tidemark.llm.common import discard, last_table_stays, materialise, on_workers, read

#: near duplicates: shingles of so many words, and their similarity in percent
NEAR_SHINGLE, NEAR_PERCENT = 5, 80

#: no SQL: the model, the components and the byte-level BPE are beyond it
ORACLE_SQL = None


def _carried(docs: DataFrame, *needed: str) -> DataFrame:
    """``needed`` columns, and all columns but the text in one struct ``_rest``
    so that none of their names can clash."""
    return docs.select(*needed, F.struct(*[c for c in docs.columns if c != "text"]).alias("_rest"))


def _restored(out: DataFrame, like: DataFrame) -> DataFrame:
    return out.select(*[F.col("text") if c == "text" else F.col("_rest").getField(c).alias(c)
                        for c in like.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps."""
    on_workers(spark)
    labels = read(spark, sf_dir, "labels")
    model = kneser_ney.fit(docs.select("doc_id", "text"), labels)
    scored = materialise(kneser_ney.score(_carried(docs, "doc_id", "lang", "text"), model, keep_text=True), "scored")
    discard(model)
    return _restored(kneser_ney.judge(scored, labels).filter("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of links: the one with the smallest doc_id."""
    on_workers(spark)
    groups = jaccard_join.jaccard_components(docs.select("doc_id", "text"), NEAR_SHINGLE, NEAR_PERCENT)
    stay = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(
        F.col("doc_id").alias("_id")).distinct()
    kept = docs.join(stay, docs["doc_id"].eqNullSafe(stay["_id"]), "left_semi")
    packed = _carried(kept, "doc_id", "text")
    same = Window.partitionBy("doc_id", "_hash").orderBy("_hash")
    first = packed.withColumn("_hash", F.xxhash64("text")).withColumn("_copy", F.row_number().over(same))
    return _restored(first.filter("_copy = 1"), docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that repeat an earlier string; a code point that
    is cut in two goes with them.  ``n_chars`` is counted again."""
    on_workers(spark)
    out = suffix_dedup.remove_repeats(_carried(docs, "doc_id", "text"), as_text=True)
    restored = _restored(out.withColumnRenamed("kept", "text"), docs)
    if "n_chars" in docs.columns:
        restored = restored.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return restored


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word inside a benchmark window."""
    on_workers(spark)
    found = decontaminate.find_benchmark(docs.select("doc_id", "text"), read(spark, sf_dir, "benchmark"))
    hit = found.filter(F.size("hits") > 0).select(F.col("doc_id").alias("_id")).distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["_id"]), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the ids of every remaining text and of their decoded bytes."""
    on_workers(spark)
    return bpe.digests(docs)


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates),
          ("suffix-array dedup", repeats), ("benchmark decontamination", benchmark),
          ("byte-level BPE", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with last_table_stays():
            docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        discard(*before)
        before = [docs]
    return docs
