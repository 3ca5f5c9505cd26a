"""Operator 6 - chat formatting with Spark expressions only.

Turn rows are collected per conversation as structs and sorted; adjacent
turns of one role share one block; the formatted text and the loss mask are
array expressions over the sorted turns.  No UDF, no driver work.

A conversation is formatted as

    <s> [INST]role[/INST]text<t>text [INST]role[/INST]text ... </s>

(without the blanks).  A new ``[INST]role[/INST]`` header starts where the
role changes; ``<t>`` separates turns merged into one block, so merging loses
no turn boundary.  Control strings inside roles and texts are escaped by one
more backslash after their first character (``</s>`` -> ``<\\/s>``,
``<\\/s>`` -> ``<\\\\/s>``), which is a bijection, so parsing restores the
exact input.

Defined results: a null text or role counts as empty; rows of a null
``conv_id`` form one conversation; turns are ordered by (turn, role, text)
with nulls first, so ties and repeated rows have one order and every row is
kept; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BOS, EOS, OPEN, CLOSE, NEXT = "<s>", "</s>", "[INST]", "[/INST]", "<t>"
_TAIL = "(/?s>|t>|/?INST\\])"
#: elements of one inner prefix sum; keeps long conversations linear
_RUN = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, "([<\\[])(\\\\*)" + _TAIL, "$1\\\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, "([<\\[])\\\\(\\\\*)" + _TAIL, "$1$2$3")


def _running(lengths: Column) -> Column:
    """Sums of the elements before each element, over runs of ``_RUN``."""
    zero = F.lit(0).cast("long")

    def before(xs: Column) -> Column:
        return F.aggregate(
            xs, F.struct(zero.alias("sum"), F.array().cast("array<long>").alias("seen")),
            lambda acc, x: F.struct((acc["sum"] + x).alias("sum"),
                                    F.array_append(acc["seen"], acc["sum"]).alias("seen")))["seen"]

    def total(xs: Column) -> Column:
        return F.aggregate(xs, zero, lambda a, x: a + x)

    n = F.size(lengths)
    firsts = F.when(n > 0, F.sequence(F.lit(1), n, F.lit(_RUN))).otherwise(F.array().cast("array<int>"))
    runs = F.transform(firsts, lambda i: F.slice(lengths, i, _RUN))
    return F.flatten(F.zip_with(runs, before(F.transform(runs, total)),
                                lambda xs, base: F.transform(before(xs), lambda b: b + base)))


def format_conversations(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss_mask) from rows (conv_id, turn, role, text).

    ``loss_mask`` lists (start, length) of the texts of ``loss_role``, in code
    points of ``formatted`` from 0, one entry per turn.
    """
    grouped = (
        turns.select("conv_id", F.struct(
            F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text")).alias("t"))
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))
    same = lambda i: (i > 0) & (F.col("turns")[F.greatest(i - 1, F.lit(0))]["role"]
                                == F.col("turns")[i]["role"])
    pieces = grouped.withColumn("pieces", F.transform("turns", lambda t, i: F.struct(
        F.when(same(i), F.lit(NEXT))
        .otherwise(F.concat(F.lit(OPEN), escape(t["role"]), F.lit(CLOSE))).alias("head"),
        escape(t["text"]).alias("body"), (t["role"] == loss_role).alias("loss"))))
    placed = pieces.withColumn("starts", _running(F.transform(
        "pieces", lambda p: (F.length(p["head"]) + F.length(p["body"])).cast("long"))))
    spans = F.transform(
        F.filter(F.arrays_zip("pieces", "starts"), lambda z: z["pieces"]["loss"]),
        lambda z: F.struct(
            (z["starts"] + F.length(z["pieces"]["head"]) + len(BOS)).alias("start"),
            F.length(z["pieces"]["body"]).cast("long").alias("length")))
    body = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"])), "")
    return placed.select(
        "conv_id", F.concat(F.lit(BOS), body, F.lit(EOS)).alias("formatted"),
        spans.alias("loss_mask"))


def parse_turns(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    inner = F.substring(formatted, F.lit(len(BOS) + 1), F.length(formatted) - len(BOS) - len(EOS))
    blocks = F.filter(F.split(inner, "\\[INST\\]"), lambda b, i: i > 0)

    def of(block: Column) -> Column:
        parts = F.split(block, "\\[/INST\\]")
        return F.transform(F.split(parts[1], NEXT), lambda t: F.struct(
            unescape(parts[0]).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, of))


def masked_text(formatted: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(mask, lambda m: unescape(
        F.substring(formatted, (m["start"] + 1).cast("int"), m["length"].cast("int")))), "")


def op6_chat_format(spark, sf_dir: str) -> DataFrame:
    """Every conversation and conversation -1, with digests read back from
    the formatted text and its loss mask."""
    from tidemark.llm.common import read

    said = F.lit("</s>[INST] ok [/INST]")
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    out = format_conversations(turns.unionByName(extra))
    back = out.select(
        "conv_id", "formatted", parse_turns(F.col("formatted")).alias("turns"),
        masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
