"""Operator 1 - n-gram Jaccard join with token-combination prefixes.

Documents are sets of distinct word shingles; two link when their Jaccard
similarity is at least ``percent`` / 100.  Equal sets are one vertex from the
start (by a 128-bit signature), so copies are never paired.  The shingle length
and ``percent`` are a ``Link``; op1 takes the defaults (3 words, 90), and n/10,
n/19, 0.9 below are those of its 90 percent.

1. Candidates.  A set of n shingles that links with another set misses at most
   k = n/10 of its shingles there.  Of its k + j smallest shingles by hash
   (j = n/6 + 1) at least j must therefore occur in another document.  Only
   these shingles are shuffled; shared ones are counted in the map task first
   and leave one row per batch, however common they are.  Sets that fail the
   test link with nothing and are done.
2. Prefixes.  The remaining sets order their shingles from rare to frequent
   among themselves.  Shingles of one set only are sure misses.  Rare shingles
   (in at most ``RARE`` sets) are indexed singly, frequent ones as pairs; a pair
   class that keeps c shingles survives c - 1 misses, so a prefix is extended
   until it survives more misses than a link allows.  Sets of more than
   ``long`` shingles index frequent shingles singly as well (their pairs would
   grow with the square of the length); between 0.9 long and long both forms
   are written, so every linked pair has a form in common.  The shorter set
   of a pair may miss n/19 only and uses a shorter prefix; a key holds its
   place in the order, which bounds what can still overlap.
3. Stars.  Per key the set with the fewest misses so far is compared with the
   other sets of the key, which is linear in the key's rows; links are verified
   exactly on the shingles, and components are formed.
4. The rest.  Within a key only sets outside the star's component are compared
   with sets of other components, again exactly.  So every pair of different
   components that shares a key has been verified, and no link between them is
   lost; pairs inside a component are not listed.

Defined results: words are runs of bytes other than ASCII white space, A-Z
lower-cased; with fewer words than a shingle the whole sequence is one; null,
empty or blank texts have no shingles and link with nothing; equal rows and
rows sharing a doc_id link by their sets like others; a null doc_id is never
the smallest of a component unless it is alone; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytesview import LOWER, MIX, flat, mix, slices, tidy, words
from tidemark.llm.common import discard, materialise, read
from tidemark.llm.components import connected_components

PERCENT = 90
SHINGLE = 3
RARE = 32


@dataclass(frozen=True)
class Link:
    """What makes a link, and the bounds that follow from it."""
    shingle: int = SHINGLE
    percent: int = PERCENT

    @property
    def small(self) -> int:
        """Smaller sets link with equal sets only: n of n + 1 is not enough."""
        return -(-self.percent // (100 - self.percent))

    @property
    def long(self) -> int:
        """Longest set with paired shingles; it may miss 25 whatever the percent."""
        return 2560 // (100 - self.percent)

    def misses(self, n):
        """Shingles that a set of n may miss in a linked set."""
        return n * (100 - self.percent) // 100

    def short_misses(self, n):
        """The same if the linked set is at least as large."""
        return n - -(-2 * self.percent * n // (100 + self.percent))

_WORD = np.ones(256, bool)
_WORD[[0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20]] = False


def shingles(batch: pa.RecordBatch, size: int = SHINGLE):
    """(row, hash) of the distinct shingles of each row, by row and hash."""
    rows, hashes, base = [], [], 0
    for part in slices(batch, "text"):
        word, row = words(*flat(part.column("text")), _WORD, LOWER)
        count = np.bincount(row, minlength=len(part))
        inside = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        left = count[row] - inside
        pad = np.append(word, np.zeros(size, np.uint64))
        gram = word * np.uint64(MIX[1])
        for k in range(1, size):
            gram = mix(gram) * np.uint64(MIX[k % 4]) + np.where(left > k, pad[k:k + len(word)], np.uint64(k))
        keep = (left >= size) | (inside == 0)
        gram, row = mix(gram[keep]), row[keep]
        by = np.lexsort((gram, row))
        gram, row = gram[by], row[by]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
        rows.append(row[new] + base)
        hashes.append(gram[new])
        base += len(part)
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows), np.concatenate(hashes)


def _signatures(row, gram, n_rows):
    """Two sums over each row's shingles: equal sets have equal signatures."""
    out = []
    for seed in (MIX[2], MIX[3]):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(gram ^ np.uint64(seed)))])
        edge = np.searchsorted(row, np.arange(n_rows + 1))
        out.append((total[edge[1:]] - total[edge[:-1]]).view(np.int64))
    return out


def _needed(n):
    """Of the misses + j leading shingles that are looked up, j must be shared;
    every j up to n - misses is right."""
    return n // 6 + 1


def first_pass(link: Link):
    """mapInArrow: a row per document (n, s1, s2, shared: the leading shingles
    that other documents of the batch have), a row per other leading shingle,
    and one row without a doc_id per shingle shared within the batch."""
    @tidy
    def run(batches):
        names = ["h", "doc_id", "n", "s1", "s2", "shared"]
        for batch in batches:
            row, gram = shingles(batch, link.shingle)
            n = np.bincount(row, minlength=len(batch))
            s1, s2 = _signatures(row, gram, len(batch))
            rank = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            lead = (n[row] >= link.small) & (rank < (link.misses(n) + _needed(n))[row])
            row, gram = row[lead], gram[lead]
            value, at, times = np.unique(gram, return_inverse=True, return_counts=True)
            common = times[at] > 1
            shared = np.bincount(row[common], minlength=len(batch))
            told = value[times > 1]
            ids = batch.column("doc_id")
            m = int((~common).sum())
            blank = lambda size, kind: pa.nulls(size, kind)
            yield pa.RecordBatch.from_arrays([
                pa.array(s1), ids, pa.array(n, pa.int32()), pa.array(s1), pa.array(s2),
                pa.array(shared, pa.int32())], names)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([gram[~common], told]).view(np.int64)),
                pa.concat_arrays([ids.take(pa.array(row[~common])), pa.nulls(len(told), pa.int64())]),
                blank(m + len(told), pa.int32()), blank(m + len(told), pa.int64()),
                blank(m + len(told), pa.int64()),
                pa.array(np.concatenate([np.ones(m), np.zeros(len(told))]), pa.int32())], names)
    return run


def _vertices(docs: DataFrame, link: Link) -> tuple[DataFrame, DataFrame]:
    """(documents (doc_id, n, s1, s2), sets (s1, s2, n, rep, copies, shared)), both written."""
    rows = docs.select("doc_id", "text").mapInArrow(
        first_pass(link), "h long, doc_id long, n int, s1 long, s2 long, shared int")
    times = F.count("*").over(Window.partitionBy("h"))
    rows = materialise(
        rows.withColumn("times", times)
        .filter(F.col("n").isNotNull() | ((F.col("times") > 1) & (F.col("shared") == 1)))
        .select("doc_id", "n", "s1", "s2", "shared"), "shingles")
    elsewhere = rows.filter("n is null").groupBy("doc_id").agg(F.count("*").alias("elsewhere")) \
        .withColumnRenamed("doc_id", "_id")
    known = rows.filter("n is not null")
    counted = known.join(elsewhere, known["doc_id"].eqNullSafe(elsewhere["_id"]), "left")
    sets = counted.filter("n > 0").groupBy("s1", "s2").agg(
        F.max("n").alias("n"), F.min("doc_id").alias("rep"), F.count("*").alias("copies"),
        F.max(F.col("shared") + F.coalesce("elsewhere", F.lit(0))).alias("shared"))
    sets, known = materialise(sets, "sets"), materialise(known.select("doc_id", "n", "s1", "s2"), "documents")
    discard(rows)
    return known, sets


def second_pass(link: Link):
    """mapInArrow: (doc_id, s1, s2, h): all shingles of each document."""
    @tidy
    def run(batches):
        for batch in batches:
            row, gram = shingles(batch, link.shingle)
            n = np.bincount(row, minlength=len(batch))
            s1, s2 = _signatures(row, gram, len(batch))
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(s1), pa.array(s2),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(gram.view(np.int64)))],
                ["doc_id", "s1", "s2", "h"])
    return run


def _candidates(docs: DataFrame, sets: DataFrame, link: Link) -> DataFrame:
    """(v, s1, s2, n, h): the sets that may link with another set, each once.

    A set whose rows all have a null doc_id has rep null: rows without a doc_id
    are all read then, not joined by it.
    """
    may = sets.filter((F.col("n") >= link.small) & (F.col("shared") >= F.floor(F.col("n") / 6) + 1))
    may = may.select("s1", "s2", "n", "rep")
    ids = may.select(F.col("rep").alias("doc_id")).filter("doc_id is not null").distinct()
    rows = docs.select("doc_id", "text")
    texts = rows.join(ids, "doc_id", "left_semi")
    if not may.filter("rep is null").isEmpty():
        texts = texts.unionByName(rows.filter("doc_id is null"))
    found = texts.mapInArrow(second_pass(link), "doc_id long, s1 long, s2 long, h array<long>")
    return materialise(
        found.join(may, ["s1", "s2"]).filter(F.col("doc_id").eqNullSafe(F.col("rep")))
        .dropDuplicates(["s1", "s2"])     # rows that share a doc_id and a set
        .select(F.monotonically_increasing_id().alias("v"), "s1", "s2", "n", "h"), "candidates")


def _common(candidates: DataFrame, link: Link) -> DataFrame:
    """(v, n, t): the shingles that other candidates have too, rarest first,
    of the candidates that still may link."""
    single = candidates.select("v", "n", F.explode("h").alias("h"))
    times = single.groupBy("h").agg(F.count("*").alias("df")).filter("df > 1")
    lists = (single.join(times, "h").groupBy("v", "n")
             .agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("t")))
    return materialise(lists.filter(
        F.col("n") - F.size("t") <= F.floor(F.col("n") * (100 - link.percent) / 100)), "common")


def _prefix(misses: int, n_rare: int, n_frequent: int, paired: bool) -> tuple[int, int]:
    """Rare and frequent shingles of a prefix that survives ``misses`` misses."""
    rare = min(n_rare, misses + 1)
    if rare == misses + 1:
        return rare, 0
    return rare, min(n_frequent, misses + 1 - rare + (1 if paired else 0))


def keys(link: Link):
    """mapInArrow: index rows (key, v, n, place, short) of each set.

    ``place`` is the number of shingles before the key's first one; ``short``
    keys belong to the prefix for partners that are at least as large.
    """
    @tidy
    def run(batches):
        names = ["key", "v", "n", "place", "short"]
        for batch in batches:
            lists = batch.column("t")
            edge = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            df_all = lists.flatten().field(0).to_numpy()
            h_all = lists.flatten().field(1).to_numpy().view(np.uint64)
            out = []
            for i, (v, n) in enumerate(zip(batch.column("v").to_pylist(), batch.column("n").to_pylist())):
                df, h = df_all[edge[i]:edge[i + 1]], h_all[edge[i]:edge[i + 1]]
                alone = n - len(h)
                n_rare = int(np.searchsorted(df, RARE, "right"))
                many, few = link.misses(n) - alone, link.short_misses(n) - alone
                for paired in ([True] if n <= link.long else []) + (
                        [False] if 100 * n >= link.percent * link.long else []):
                    rare, often = _prefix(many, n_rare, len(h) - n_rare, paired)
                    if few < 0:
                        s_rare = s_often = 0
                    else:
                        s_rare, s_often = _prefix(few, n_rare, len(h) - n_rare, paired)
                    tag = np.uint64(MIX[0] if paired else MIX[1])
                    place = np.arange(rare)
                    key = mix(h[:rare] ^ tag)
                    short = place < s_rare
                    f = h[n_rare:n_rare + often]
                    if paired:
                        x, y = np.triu_indices(len(f), 1)
                        more = mix(mix(f[x] ^ tag) * np.uint64(MIX[2]) + f[y])
                        where, soon = n_rare + x, y < s_often
                    else:
                        more, where = mix(f ^ tag), n_rare + np.arange(len(f))
                        soon = np.arange(len(f)) < s_often
                    key = np.concatenate([key, more])
                    out.append((key.view(np.int64), np.full(len(key), v), np.full(len(key), n),
                                np.concatenate([place, where]) + alone, np.concatenate([short, soon])))
            if out:
                key, v, n, place, short = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(v, pa.int64()), pa.array(n, pa.int32()),
                     pa.array(place, pa.int32()), pa.array(short.astype(bool))], names)
    return run


def _fits(x: str, y: str, percent: int):
    """Sizes and places leave room for the overlap that a link needs."""
    c = lambda side, name: F.col(f"{side}.{name}")
    first = (c(x, "n") < c(y, "n")) | ((c(x, "n") == c(y, "n")) & (c(x, "v") < c(y, "v")))
    need = F.ceil((c(x, "n") + c(y, "n")) * percent / (100 + percent))
    return (F.when(first, c(x, "short")).otherwise(c(y, "short"))
            & (F.least(c(x, "n"), c(y, "n")) * 100 >= F.greatest(c(x, "n"), c(y, "n")) * percent)
            & (need <= F.least(c(x, "n") - c(x, "place"), c(y, "n") - c(y, "place"))))


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("x.v", "y.v").alias("a"), F.greatest("x.v", "y.v").alias("b")).distinct()


def _verified(pairs: DataFrame, common: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by exact intersection."""
    side = common.select("v", "n", F.transform("t", lambda t: t["h"]).alias("h"))
    left = side.select(F.col("v").alias("a"), F.col("n").alias("na"), F.col("h").alias("ha"))
    right = side.select(F.col("v").alias("b"), F.col("n").alias("nb"), F.col("h").alias("hb"))
    both = pairs.join(left, "a").join(right, "b").select(
        "a", "b", "na", "nb", F.size(F.array_intersect("ha", "hb")).alias("both"))
    return materialise(both.filter(
        F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b"), "links")


def links(common: DataFrame, link: Link) -> DataFrame:
    """(a, b): verified links whose components are those of all links."""
    rows = common.mapInArrow(keys(link), "key long, v long, n int, place int, short boolean")
    rows = materialise(rows, "keys")
    best = rows.groupBy("key").agg(
        F.min(F.struct((F.col("place") / F.col("n")).alias("part"), "v", "n", "place", "short")).alias("p"),
        F.count("*").alias("rows")).filter("rows > 1")
    best = materialise(best.select("key", "p.v", "p.n", "p.place", "p.short"), "stars")
    star = _pairs(rows.alias("x").join(best.alias("y"), "key").filter((F.col("x.v") != F.col("y.v")) & _fits("x", "y", link.percent)))
    found = _verified(star, common, link.percent)
    label = connected_components(found)

    def labelled(df: DataFrame) -> DataFrame:
        return df.join(label, "v", "left").withColumn("label", F.coalesce("label", "v"))

    named = materialise(labelled(rows).join(
        labelled(best).select("key", F.col("label").alias("star")), "key"), "named")
    discard(rows, best)
    outside = named.filter("label <> star")
    rest = _pairs(outside.alias("x").join(named.alias("y"), "key").filter(
        (F.col("x.label") != F.col("y.label")) & _fits("x", "y", link.percent)))
    more = _verified(rest, common, link.percent)
    discard(named)
    return found.unionByName(more)


def jaccard_components(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, s1, s2) for every row of ``docs``."""
    link = Link(shingle, percent)
    known, sets = _vertices(docs, link)
    candidates = _candidates(docs, sets, link)
    common = _common(candidates, link)
    known_as = materialise(candidates.select("v", "s1", "s2"), "vertices")
    discard(candidates)
    label = connected_components(links(common, link))
    discard(common)
    linked = known_as.join(label, "v").select("s1", "s2", "label")
    members = linked.join(sets.select("s1", "s2", "rep"), ["s1", "s2"])
    smallest = members.groupBy("label").agg(F.min("rep").alias("component"))
    linked = members.join(smallest, "label").select("s1", "s2", "component")
    # only sets with copies or links need a look-up
    named = (sets.join(linked, ["s1", "s2"], "left")
             .filter("copies > 1 or component is not null")
             .select("s1", "s2", F.coalesce("component", "rep").alias("component")))
    # as a table of its own, so that a hot set of the join can be split at run time
    named = materialise(named, "components")
    return known.join(named, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"), "s1", "s2")


def op1_jaccard_join(spark, sf_dir: str) -> DataFrame:
    """Every document with its component of links."""
    return jaccard_components(read(spark, sf_dir, "documents")).drop("s1", "s2")
