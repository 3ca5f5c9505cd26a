"""Operator 11 - ranked lexical search, document FP-tree.

Every document becomes a *restricted term vector*: the terms that occur in the
queries, with their counts (tf), ordered by document frequency, most frequent
first.  Vectors are range-partitioned and sorted by that order, so documents
that begin with the same terms are neighbours.  A task builds one tree per
batch of neighbours (``Tree``): a node stands for a shared path, and holds the
largest tf of every term below it and the smallest m (the length figure of the
score).  They bound the score of any document below: a term's part grows with
tf and falls with m.

Each item is searched depth first, best child first; a node is left out when its
bound is below the item's tenth score so far (or equals it and no smaller doc_id
lies below).  A leaf is scored in whole.  A task returns ten documents per item
at most, and a ranking per item picks the ten of all tasks.

Documents are never compared with each other and are shuffled once, as vectors;
equal vectors are dealt to tasks by doc_id.  The items go to the tasks in blocks
of about ``PAIRS`` (item, term) pairs, whatever the size of the query set; each
block reads the documents anew.

Defined results: null or empty documents have no terms, count nowhere and are
never found; items without terms give no rows; rows of ``items`` that share an
item_id (null included) are one item with the terms of all its rows; documents
that share a doc_id are ranked row by row; a null doc_id sorts last; empty tables
give no rows.  Other columns are not read.  Texts of any length are read whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytesview import LOWER, coded_words, slices, tidy
from tidemark.llm.common import lower_ascii, materialise, read

#: fixed value: characters of terms
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP = 10
LEAF = 32                  # documents of a leaf, unless their vectors are equal
PAIRS = 1 << 20            # (item, term) pairs of a block of items
LAST = np.iinfo(np.int64).max

_CLASS = LOWER.copy()
_CLASS[[b for b in range(128) if not chr(b).isalnum()]] = 0x20


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times): the terms of every item."""
    words = F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(TERM), F.lit(0))
    return (items.select("item_id", F.explode(words).alias("term"))
            .groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times")))


def term_vectors(docs: DataFrame, terms: pa.Array) -> DataFrame:
    """(doc_id, n, terms, tfs) of every document with a term: n counts all of its
    terms, ``terms`` numbers those that are asked for and ``tfs`` counts them."""
    @tidy
    def run(batches):
        for batch in (part for whole in batches for part in slices(whole, "text")):
            words, start, _, ends = coded_words(batch.column("text"), _CLASS, b" ")
            row = np.searchsorted(ends, start, "right") - 1
            number = pc.fill_null(pc.index_in(words.dictionary, value_set=terms), -1).to_numpy()
            number = number[words.indices.to_numpy()].astype(np.int64)
            asked = number >= 0
            key, tf = np.unique(row[asked] * max(len(terms), 1) + number[asked], return_counts=True)
            n = np.bincount(row, minlength=len(batch))
            ends = pa.array(np.searchsorted(key // max(len(terms), 1), np.arange(len(batch) + 1)).astype(np.int32))
            out = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n.astype(np.int64)),
                 pa.ListArray.from_arrays(ends, pa.array((key % max(len(terms), 1)).astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(tf.astype(np.int32)))], ["doc_id", "n", "terms", "tfs"])
            yield out.filter(pa.array(n > 0))

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _paths(vectors: DataFrame, rank: np.ndarray, n_docs: int, n_words: int) -> DataFrame:
    """(doc_id, m, path, tfs): vectors in the order of the ranks."""
    @tidy
    def run(batches):
        for batch in batches:
            terms, tfs = batch.column("terms"), batch.column("tfs")
            row = np.repeat(np.arange(len(batch)), pc.list_value_length(terms).to_numpy())
            path = rank[terms.flatten().to_numpy()]
            order = np.lexsort((path, row))
            ends = pa.array(np.searchsorted(row, np.arange(len(batch) + 1)).astype(np.int32))
            m = 25 + 75 * batch.column("n").to_numpy() * n_docs // n_words
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(m),
                 pa.ListArray.from_arrays(ends, pa.array(path[order].astype(np.int32))),
                 pa.ListArray.from_arrays(ends, pa.array(tfs.flatten().to_numpy()[order]))],
                ["doc_id", "m", "path", "tfs"])

    return vectors.filter(F.size("terms") > 0).mapInArrow(
        run, "doc_id long, m long, path array<int>, tfs array<int>")


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What one term adds to a score, before its weight (0 for tf 0)."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _largest(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the largest value of each."""
    if not len(key):
        return key, value
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.maximum.reduceat(value[order], first)


class Tree:
    """FP-tree over documents sorted by path: node i covers documents
    ``lo[i]:hi[i]``; its children are ``children[i]`` (leaf: none)."""

    def __init__(self, ids: np.ndarray, m: np.ndarray, ends: np.ndarray, path: np.ndarray, tf: np.ndarray,
                 width: int, leaf: int = LEAF):
        self.ids, self.ends, self.path, self.width = ids, ends, path.astype(np.int64), width
        self.parts = part(tf, np.repeat(m, np.diff(ends)))
        self.lo, self.hi, self.children, level = [0], [len(ids)], [[]], [0]
        open_nodes = [(0, 0)]
        while open_nodes:
            node, depth = open_nodes.pop()
            for a, b, d in self._split(self.lo[node], self.hi[node], depth, leaf):
                child = len(self.lo)
                self.lo.append(a)
                self.hi.append(b)
                self.children.append([])
                self.children[node].append(child)
                level.append(level[node] + 1)
                if d is not None:
                    open_nodes.append((child, d))
        self.children = [np.array(c, np.int64) for c in self.children]
        self._bounds(np.array(level), m, tf)

    def _split(self, lo, hi, depth, leaf):
        """(lo, hi, depth or None) of a node's children: one per next term;
        neighbours with few documents share a leaf."""
        ends, path = self.ends, self.path
        if hi - lo <= leaf:
            return []
        a, b = path[ends[lo]:ends[lo + 1]], path[ends[hi - 1]:ends[hi]]
        short = min(len(a), len(b))
        differs = np.flatnonzero(a[depth:short] != b[depth:short])
        depth = depth + int(differs[0]) if len(differs) else short
        if depth == len(b):                        # all vectors are equal
            return []
        length = np.diff(ends[lo:hi + 1])
        done = lo + int(np.searchsorted(length > depth, True)) if length[0] == depth else lo
        rest = path[ends[done:hi] + depth]
        edges = [*([lo] if done > lo else []), done, *(done + 1 + np.flatnonzero(np.diff(rest))).tolist(), hi]
        out, start = [], None
        for a, b in zip(edges, edges[1:]):
            if b - a > leaf:
                if start is not None:
                    out.append((start, a, None))
                    start = None
                out.append((a, b, None if b <= done else depth + 1))
            elif start is None:
                start = a
            elif b - start > leaf:
                out.append((start, a, None))
                start = a
        if start is not None:
            out.append((start, hi, None))
        return out

    def _bounds(self, level, m, tf):
        """Per node the smallest m and doc_id; per node and term the largest tf."""
        lo, count = np.array(self.lo), len(self.lo)
        self.m = np.array([m[a:b].min() for a, b in zip(self.lo, self.hi)], np.int64)
        self.first_id = np.array([self.ids[a:b].min() for a, b in zip(self.lo, self.hi)])
        parent = np.zeros(count, np.int64)
        for i, below in enumerate(self.children):
            parent[below] = i
        is_leaf = np.array([not len(c) for c in self.children])
        leaves = np.flatnonzero(is_leaf)[np.argsort(lo[is_leaf], kind="stable")]
        owner = np.repeat(leaves, np.diff(np.append(self.ends[lo[leaves]], self.ends[-1])))
        key, value = _largest(owner * self.width + self.path, tf.astype(np.int64))
        at_level = level[key // self.width]
        keys, values = [key], [value]
        up_key, up_value = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for depth in range(int(level.max()), 0, -1):
            here = at_level == depth
            key_, value_ = np.concatenate([key[here], up_key]), np.concatenate([value[here], up_value])
            up_key, up_value = _largest(parent[key_ // self.width] * self.width + key_ % self.width, value_)
            keys.append(up_key)
            values.append(up_value)
        key, value = np.concatenate(keys), np.concatenate(values)
        order = np.argsort(key)
        self.key, self.value = key[order], value[order]

    def bounds(self, nodes: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The score that no document below each node exceeds."""
        wanted = nodes[:, None] * self.width + terms[None, :]
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        tf = np.where(self.key[at] == wanted, self.value[at], 0)
        return (part(tf, self.m[nodes][:, None]) * weights).sum(axis=1)

    def search(self, terms: np.ndarray, weights: np.ndarray, dense: np.ndarray,
               best: list[tuple[int, int]], top: int = TOP) -> None:
        """Bring ``best`` (pairs of -score and doc_id, in order) up to date."""
        hopeless = lambda bound, node: bound <= 0 or len(best) == top and (
            bound < -best[-1][0] or bound == -best[-1][0] and self.first_id[node] >= best[-1][1])
        stack = [(int(self.bounds(np.zeros(1, np.int64), terms, weights)[0]), 0)]
        while stack:
            bound, node = stack.pop()
            if hopeless(bound, node):
                continue
            below = self.children[node]
            if len(below):
                bounds = self.bounds(below, terms, weights)
                stack += [(int(bounds[i]), int(below[i])) for i in np.argsort(bounds, kind="stable")]
                continue
            a, b = self.lo[node], self.hi[node]
            entries = slice(self.ends[a], self.ends[b])
            scores = np.add.reduceat(dense[self.path[entries]] * self.parts[entries], self.ends[a:b] - self.ends[a])
            ids = self.ids[a:b]
            order = np.lexsort((ids, -scores))[:top]
            best += [(-int(scores[i]), int(ids[i])) for i in order if scores[i] > 0]
            best.sort()
            del best[top:]


def _found(paths: DataFrame, items: pa.Table, item_ids: pa.Array, width: int, leaf: int, top: int) -> DataFrame:
    """(item_id, doc_id, score): the best documents of every task for every item.
    ``items`` has (item, rank, weight), sorted by item."""
    number, rank, weight = (items[c].to_numpy() for c in ("item", "rank", "weight"))
    ends = np.searchsorted(number, np.arange(len(item_ids) + 1))

    @tidy
    def run(batches):
        best = [[] for _ in range(len(item_ids))]
        dense = np.zeros(width, np.int64)
        for batch in batches:
            path, tfs = batch.column("path"), batch.column("tfs")
            tree = Tree(pc.fill_null(batch.column("doc_id"), LAST).to_numpy(),
                        batch.column("m").to_numpy(),
                        np.concatenate([[0], np.cumsum(pc.list_value_length(path).to_numpy())]),
                        path.flatten().to_numpy(), tfs.flatten().to_numpy(), width, leaf)
            for i, found in enumerate(best):
                mine = slice(ends[i], ends[i + 1])
                dense[rank[mine]] = weight[mine]
                tree.search(rank[mine], weight[mine], dense, found, top)
                dense[rank[mine]] = 0
        rows = [(i, d, -s) for i, found in enumerate(best) for s, d in found]
        if rows:
            i, d, s = (np.array(x, np.int64) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [item_ids.take(pa.array(i)), pa.array(d, mask=d == LAST), pa.array(s)],
                ["item_id", "doc_id", "score"])

    return paths.mapInArrow(run, "item_id long, doc_id long, score long")


def _block(docs: DataFrame, asked: DataFrame, leaf: int, top: int) -> DataFrame | None:
    table = asked.toArrow().sort_by([("item_id", "ascending"), ("term", "ascending")])
    if not len(table):
        return None
    terms = pc.unique(table["term"].combine_chunks()).sort()
    item_ids = pc.unique(table["item_id"].combine_chunks())
    vectors = materialise(term_vectors(docs, terms), "term-vectors")
    size = vectors.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("words")).first()
    n_docs, n_words = size["docs"], size["words"] or 1
    held = vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).toArrow()
    df = np.zeros(len(terms), np.int64)
    df[held["t"].to_numpy()] = held["df"].to_numpy()
    rank = np.empty(len(terms), np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(len(terms))
    w = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    term = pc.index_in(table["term"].combine_chunks(), value_set=terms).to_numpy()
    items = pa.table({"item": pc.index_in(table["item_id"].combine_chunks(), value_set=item_ids),
                      "rank": rank[term], "weight": w[term] * table["times"].to_numpy()})
    paths = _paths(vectors, rank, n_docs, n_words)
    near = paths.repartitionByRange("path", "doc_id").sortWithinPartitions("path")
    return _found(near, items, item_ids, len(terms), leaf, top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, leaf: int = LEAF, pairs: int = PAIRS) -> DataFrame:
    """The ``top`` highest-scoring documents of every item: (item_id, rank, doc_id, score)."""
    asked = materialise(item_terms(items.select(F.col("item_id").cast("long").alias("item_id"), "text")), "item-terms")
    blocks = max(1, math.ceil(asked.count() / pairs))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    found = asked.sparkSession.createDataFrame([], "item_id long, doc_id long, score long")
    for i in range(blocks):
        one = _block(docs, asked.filter(block == i), leaf, top)
        found = found if one is None else found.unionByName(one)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))


def op11_lexical_search(spark, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
