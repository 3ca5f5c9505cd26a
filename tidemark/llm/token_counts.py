"""Operator 8 - token counts as delta-maintained rollups.

Totals by (source, lang, tokenizer) are never recomputed from the corpus: each
batch of signed events is reduced to additive deltas, and the totals are the
sums of the committed batches.

    insert  (+1 document, +tokens)
    delete  (-1 document, -tokens)
    revise  (-1, -old tokens) under the old key, (+1, +new tokens) under the
            new one; with an unchanged key that is (0, new - old)

A batch is one folder of Parquet.  The writer's success marker is the commit:
a batch that has it is skipped when it is sent again, one that lacks it (its
job was lost half-way) is overwritten.  ``compact`` folds old batches into one
base batch that names what it holds, so a replay of those is skipped as well.

Defined results: null text has no tokens; null sources, languages and
tokenizers are groups of their own; repeated events within a batch count as
often as they occur; an empty batch commits nothing but its name; a total
whose documents are all deleted is left out; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import encode
from tidemark.llm.common import WORD_GAP, materialise, read, shared_path

KEYS = ("source", "lang", "tokenizer")


def count_bytes(text: Column) -> Column:
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long")


def count_words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), WORD_GAP), lambda w: w != "")).cast("long")


#: tokenizer version -> token count of a text column
TOKENIZERS: dict[str, Callable[[Column], Column]] = {"bytes-v1": count_bytes, "words-v1": count_words}


def deltas(events: DataFrame) -> DataFrame:
    """Additive deltas by key of events (op, source, lang, tokenizer, tokens,
    and for revisions old_source, old_lang, old_tokenizer, old_tokens)."""
    def part(op: str, sign: int, prefix: str = "") -> Column:
        return F.when(F.col("op") == op, F.array(F.struct(
            *[F.col(prefix + k).alias(k) for k in KEYS], F.lit(sign).alias("docs"),
            (F.col(prefix + "tokens") * sign).alias("tokens"))))

    none = F.array().cast("array<struct<source:string,lang:string,tokenizer:string,docs:int,tokens:bigint>>")
    signed = F.concat(*[F.coalesce(p, none) for p in (
        part("insert", 1), part("delete", -1), part("revise", 1), part("revise", -1, "old_"))])
    return (events.select(F.inline(signed)).groupBy(*KEYS)
            .agg(F.sum("docs").cast("long").alias("n_docs"), F.sum("tokens").alias("n_tokens")))


class Rollup:
    """Committed batches of deltas in one folder of a shared file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        files, path = self._files()
        if not files.exists(path):
            return []
        named = [s.getPath() for s in files.listStatus(path) if s.isDirectory()]
        done = [p.getName() for p in named
                if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
        return sorted(x.removeprefix("batch=") for x in done if x.startswith("batch="))

    def _read(self, names: list[str]) -> DataFrame:
        return self.spark.read.schema(
            "source string, lang string, tokenizer string, n_docs long, n_tokens long, held array<string>"
        ).parquet(*[f"{self.path}/batch={n}" for n in names])

    def held(self) -> set[str]:
        """Committed batches and those folded into them."""
        names = self.batches()
        if not names:
            return set()
        inner = self._read(names).filter("held is not null").select(F.explode("held")).distinct()
        return set(names) | {r[0] for r in inner.toLocalIterator()}

    def commit(self, batch: str, events: DataFrame) -> bool:
        """Apply a batch once; False if it had been applied."""
        if batch in self.held():
            return False
        deltas(events).withColumn("held", F.lit(None).cast("array<string>")) \
            .write.mode("overwrite").parquet(f"{self.path}/batch={batch}")
        return True

    def totals(self) -> DataFrame:
        names = self.batches()
        empty = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
        if not names:
            return self.spark.createDataFrame([], empty)
        return (self._read(self._live(names)).filter("held is null").groupBy(*KEYS)
                .agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .filter("n_docs <> 0 or n_tokens <> 0"))

    def _live(self, names: list[str]) -> list[str]:
        """Batches not folded into another one."""
        inner = self._read(names).filter("held is not null").select(F.explode("held")).distinct()
        folded = {r[0] for r in inner.toLocalIterator()}
        return [n for n in names if n not in folded]

    def compact(self, batch: str) -> None:
        """Fold all committed batches into ``batch``; the folders stay, unread."""
        names = self._live(self.batches())
        if not names or batch in self.held():
            return
        row = self.spark.createDataFrame([(names,)], "held array<string>")
        (self.totals().unionByName(row, allowMissingColumns=True)
         .write.mode("overwrite").parquet(f"{self.path}/batch={batch}"))


def _events(counts: DataFrame, op: str, version: str, tokens: Column,
            old: tuple[str, Column] | None = None) -> DataFrame:
    """Events of one tokenizer version; ``old``: the version and count that a revision replaces."""
    nothing = [F.lit(None).cast("string")] * 3 + [F.lit(None).cast("long")]
    before = nothing if old is None else [F.col("source"), F.col("lang"), F.lit(old[0]), old[1]]
    return counts.select(
        F.lit(op).alias("op"), "source", "lang", F.lit(version).alias("tokenizer"), tokens.alias("tokens"),
        *[c.alias(f"old_{name}") for c, name in zip(before, (*KEYS, "tokens"))])


def _rolled_up(counts: DataFrame, estimated: str, per_token: int) -> DataFrame:
    """Totals after three batches, one of them sent twice, over ``counts``
    (doc_id, source, lang, sha of the text, bytes-v1 and the count ``estimated``).

    All documents come with their bytes and an estimate of the other count (a
    token for so many bytes) under a version of its own; the estimate is revised
    to the exact count, which changes the version, thus the key; later copies of
    equal texts are deleted.
    """
    spark, exact, guess = counts.sparkSession, F.col(f"`{estimated}`"), F.floor(F.col("bytes-v1") / per_token)
    estimate = f"{estimated}-estimate"
    inserts = _events(counts, "insert", "bytes-v1", F.col("bytes-v1")).unionByName(
        _events(counts, "insert", estimate, guess))
    revised = _events(counts, "revise", estimated, exact, (estimate, guess))
    # the first document of each text, by aggregate and join: a text may fill a third of the rows
    firsts = counts.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    copies = counts.join(firsts, "sha").filter("NOT doc_id <=> first")      # a null doc_id comes last
    deletes = _events(copies, "delete", "bytes-v1", F.col("bytes-v1")).unionByName(
        _events(copies, "delete", estimated, exact))
    rollup = Rollup(spark, shared_path(spark, "rollup"))
    rollup.commit("0001", inserts)
    rollup.commit("0002", revised)
    rollup.commit("0002", revised)     # a replay changes nothing
    rollup.compact("base-0002")
    rollup.commit("0003", deletes)
    return rollup.totals()


def _counted(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select("doc_id", "source", "lang", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha"),
                       *[f(F.col("text")).alias(name) for name, f in TOKENIZERS.items()], *more)


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    """Totals of bytes and words of the documents that are left, see ``_rolled_up``."""
    counted = _counted(read(spark, sf_dir, "documents"))
    return _rolled_up(materialise(counted, "token-counts"), "words-v1", 6)


def token_counts_bpe(spark, sf_dir: str) -> DataFrame:
    """The same batches with the ids of the byte-level BPE counted in place of the words."""
    coded = encode(_counted(read(spark, sf_dir, "documents"), "text"))
    counted = coded.withColumn("byte_bpe_50k", F.size("ids").cast("long")).drop("ids")
    return _rolled_up(materialise(counted, "token-counts"), "byte_bpe_50k", 4)
