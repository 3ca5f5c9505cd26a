"""Operator 10 - quality rules with risk-controlled thresholds (native).

Only DataFrame functions: per-document measurements are array expressions of
one row (no shuffle of text), thresholds come from small aggregate tables.

Rules.  Each rule is an integer score per thousand (``RULES``); a document
fails a rule when its score exceeds the rule's cutoff in its stratum
(language).  A cutoff is chosen on labelled clean holdout documents.  With k
of n of them above a cutoff, the exact binomial p-value of "the false-rejection
rate is above ``alpha``" is P(Bin(n, alpha) <= k).  The cutoffs of ``GRID`` are
tested in fixed sequence, from the loosest to the strictest, up to the first
one that is not proven: a wrong cutoff can only be chosen if the first wrong
one of the sequence passes, so a sequence needs no correction for its length.
``delta`` is divided by the number of sequences, one a (stratum, rule); with
confidence ``1 - delta`` every chosen cutoff keeps its rate.  A stratum with
fewer clean documents than ``minimum_holdout`` proves no cutoff and rejects
nothing beyond the base rules.  The bound holds for each rule; all rules of a
stratum together reject at most len(RULES) * alpha.

Defined results: null text has no words and fails the base; an empty table
gives no rows; null strata form one stratum; repeated rows are measured row by
row; rows whose label is missing do not calibrate; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD_GAP, materialise, read

WINDOW = 8
#: score per thousand of each rule: (name, numerator, denominator)
RULES = (("symbols", "n_symbols", "word_chars"),
         ("dup_lines", "n_dup_lines", "n_lines"),
         ("repeats", "n_repeat_words", "n_words"),
         ("capitals", "n_capitals", "word_chars"),
         ("long_words", "word_chars", "n_words"))
#: candidate cutoffs per thousand; scores of mean word length are 1000 x
GRID = {"symbols": (500, 300, 200, 150, 100, 70, 50, 30, 20, 10),
        "dup_lines": (900, 700, 500, 400, 300, 200, 150, 100),
        "repeats": (900, 700, 500, 400, 300, 250, 200, 150, 100),
        "capitals": (900, 700, 500, 400, 300, 200, 150, 100),
        "long_words": (40000, 30000, 20000, 15000, 12000, 10000, 9000, 8000)}


@dataclass(frozen=True)
class Risk:
    alpha: float = 0.01   # largest tolerated share of clean documents rejected
    delta: float = 0.05   # chance that any chosen cutoff breaks alpha


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WORD_GAP), lambda w: w != "")


def _with_repeat_words(df: DataFrame) -> DataFrame:
    """``n_repeat_words`` from ``_hashes``: words in windows that occur twice.

    Each step is a column of its own: an array that a lambda looks into must
    be a column, or it would be computed again for every element.
    """
    marked, starts = F.col("_marked"), F.col("_starts")
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    repeats = F.size(F.array_distinct("_hashes")) < F.size("_hashes")
    twin = lambda m, j: (
        ((j > 0) & (marked[F.greatest(j - 1, F.lit(0))]["h"] == m["h"]))
        | ((j < F.size(marked) - 1) & (marked[F.least(j + 1, F.size(marked) - 1)]["h"] == m["h"])))
    gap = lambda s, j: F.when(
        j < F.size(starts) - 1,
        F.least(F.lit(WINDOW), starts[F.least(j + 1, F.size(starts) - 1)] - s)).otherwise(WINDOW)
    return (df.withColumn("_marked", F.when(repeats, F.sort_array(F.transform(
                "_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none))
            .withColumn("_starts", F.sort_array(F.transform(F.filter(marked, twin), lambda m: m["i"])))
            .withColumn("n_repeat_words", F.aggregate(
                F.transform(starts, gap), F.lit(0).cast("long"), lambda a, x: a + x)))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the base measurements of every text."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda s: F.length(F.translate(s, " \t\x0b\x0c\r", "")) > 0)
    chars = F.length(F.translate(text, " \t\n\x0b\x0c\r", ""))
    out = (docs.withColumn("_words", _words(text))
           .withColumn("n_words", F.size("_words").cast("long"))
           .withColumn("word_chars", chars.cast("long"))
           .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"))
           .withColumn("n_capitals", (F.length(text) - F.length(F.translate(
               text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long"))
           .withColumn("_lines", lines)
           .withColumn("n_lines", F.size("_lines").cast("long"))
           .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
           .withColumn("_hashes", F.when(F.col("n_words") >= WINDOW, F.transform(
               F.sequence(F.lit(1), F.col("n_words").cast("int") - (WINDOW - 1)),
               lambda i: F.xxhash64(F.slice("_words", i, WINDOW))))
               .otherwise(F.array().cast("array<long>"))))
    out = _with_repeat_words(out)
    base = (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)
    return out.withColumn("base_failed", base).drop(
        "_words", "_lines", "_hashes", "_marked", "_starts")


def score(name: str) -> Column:
    """The rule's score per thousand, 0 where its denominator is 0."""
    _, top, bottom = next(r for r in RULES if r[0] == name)
    return F.when(F.col(bottom) > 0, F.expr(f"{top} * 1000 div {bottom}")).otherwise(F.lit(0).cast("long"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """Exact P(Bin(n, p) <= k) for k < n p; 1 beyond (no proof is possible).

    Sums the pmf downwards from k: log pmf(k) by the recurrence from
    pmf(0) = (1-p)^n, then terms relative to pmf(k), which only shrink.
    """
    odds = math.log(p) - math.log1p(-p)
    up_to = lambda hi: F.when(hi >= 1, F.sequence(F.lit(1).cast("long"), hi))
    none = F.array().cast("array<long>")
    log_pk = F.aggregate(
        F.coalesce(up_to(k), none), n * math.log1p(-p),
        lambda acc, i: acc + F.log((n - i + 1) / i) + F.lit(odds))
    rel = F.aggregate(
        F.coalesce(F.reverse(up_to(k)), none),
        F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("sum")),
        lambda acc, i: F.struct(
            (acc["term"] * i / (n - i + 1) * math.exp(-odds)).alias("term"),
            (acc["sum"] + acc["term"] * i / (n - i + 1) * math.exp(-odds)).alias("sum")))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.exp(log_pk + F.log(rel["sum"])))


def minimum_holdout(strata: int, risk: Risk = Risk()) -> int:
    """Clean documents that a stratum needs to prove a cutoff above which none of them lies."""
    return math.ceil(math.log(risk.delta / (strata * len(RULES))) / math.log1p(-risk.alpha))


def calibrate(measured: DataFrame, labels: DataFrame, risk: Risk = Risk(),
              stratum: str = "lang") -> DataFrame:
    """(stratum, rule, cutoff): the last proven cutoff of every sequence.

    ``labels`` has (doc_id, quality); its clean rows that pass the base rules
    are the holdout.  Counts per (stratum, rule, cutoff) come from one
    aggregate per (stratum, rule, score) with map-side combining.
    """
    clean = labels.filter(F.col("quality") == 1).select("doc_id").distinct()
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), score(name).alias("score"))
                      for name, _, _ in RULES])
    grid = F.create_map(*[x for name, cuts in GRID.items()
                          for x in (F.lit(name), F.array(*[F.lit(c) for c in cuts]))])
    held = measured.filter(~F.col("base_failed")).join(clean, "doc_id", "left_semi")
    counts = (
        held.select(F.col(stratum).alias("stratum"), F.inline(rules))
        .groupBy("stratum", "rule", "score").agg(F.count("*").alias("n"))
        .select("stratum", "rule", "score", "n", F.explode(grid[F.col("rule")]).alias("cutoff"))
        .groupBy("stratum", "rule", "cutoff")
        .agg(F.sum("n").alias("n"),
             F.sum(F.when(F.col("score") > F.col("cutoff"), F.col("n")).otherwise(0)).alias("k")))
    sequences = counts.agg(F.count_distinct(F.struct("stratum", "rule"))).scalar()
    proven = binomial_tail(F.col("k"), F.col("n"), risk.alpha) <= F.lit(risk.delta) / sequences
    loosest_first = Window.partitionBy("stratum", "rule").orderBy(F.desc("cutoff"))
    tested = counts.withColumn("proven", proven).withColumn("all", F.bool_and("proven").over(loosest_first))
    return tested.filter("all").groupBy("stratum", "rule").agg(F.min("cutoff").cast("long").alias("cutoff"))


def apply_rules(measured: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``measured`` with ``kept``; the cutoffs of a stratum travel as one map."""
    per = cutoffs.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cuts"))
    joined = measured.join(per, measured[stratum].eqNullSafe(per["stratum"]), "left").drop("stratum")
    broken = F.lit(False)
    for name, _, _ in RULES:
        broken = broken | F.coalesce(score(name) > F.col("_cuts")[name], F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~broken).drop("_cuts")


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Measurements and verdict of every document; cutoffs per language from
    the clean labels."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    measured = materialise(measure(docs).drop("text"), "op10-measured")
    cutoffs = calibrate(measured, read(spark, sf_dir, "labels"))
    out = apply_rules(measured, cutoffs)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                      "n_repeat_words", "base_failed", "kept")
