"""Operator 9 - benchmark decontamination over a positional inverted index.

Every benchmark item gives windows of ``WINDOW`` consecutive words (an item of
fewer words is one window).  The training side is stored as a positional
inverted index, sharded by document: for each document the postings (term,
position) of the terms that occur in some window, as Parquet in the shared
folder.  A query takes the terms of each window from the rarest to the most
common (postings counted over the whole index), reads the rarest term's list,
shifts it by the term's offset in the window, and intersects it with the
shifted lists of the next terms; what survives all of them is an exact
occurrence.  Proximity matches (all words of a window close together, in any
order) look each further term up within ``slack`` words of the rarest one.

The benchmark is a query set: it is taken in blocks of ``BLOCK`` windows, and
what a task holds of it (terms and windows of one block) is bounded by that.
The documents are never shuffled, and no document is joined with an item.

Defined results: null text has no words; an item without words has no window;
items that share an item_id count as one, and those with a null item_id as one
item named "null"; repeated documents are matched row
by row; an empty benchmark hits nothing; an empty table gives no rows; other
columns are kept by ``remove_hits`` and ignored here.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesview import LOWER, flat, prefix_hash, range_hash, tidy, words
from tidemark.llm.common import aside, lower_ascii, materialise, read

WINDOW = 10
BLOCK = 100_000          # windows of one block of the benchmark
GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = True
_WORD[0x80:] = True


@dataclass
class Block:
    """Windows of one block: term numbers by window and offset, -1 beyond its end."""
    terms: np.ndarray        # sorted word hashes; a term's number is its place
    grid: np.ndarray         # (windows, WINDOW) term numbers
    item: np.ndarray         # item of each window, an index into ids
    ids: list                # item_id as strings


def _block(rows) -> Block:
    hashes = [np.array([_hash(w) for w in r["words"]], np.uint64) for r in rows]
    terms = np.unique(np.concatenate(hashes))
    ids = sorted({r["item_id"] for r in rows})
    number = {k: i for i, k in enumerate(ids)}
    grid = np.full((len(rows), WINDOW), -1, np.int64)
    for i, h in enumerate(hashes):
        grid[i, :len(h)] = np.searchsorted(terms, h)
    item = np.array([number[r["item_id"]] for r in rows])
    seen = np.unique(np.column_stack([item, grid]), axis=0)
    return Block(terms, seen[:, 1:], seen[:, 0], ids)


def _hash(word: str) -> int:
    body = np.frombuffer(word.encode(), np.uint8)
    return int(range_hash(prefix_hash(body), np.array([0]), np.array([len(body)]))[0])


def windows(benchmark: DataFrame) -> DataFrame:
    """(item_id string, words) for every window of every item."""
    w = F.filter(F.split(lower_ascii(F.coalesce("text", F.lit(""))), GAP), lambda x: x != "")
    name = F.coalesce(F.col("item_id").cast("string"), F.lit("null"))
    items = benchmark.select(name.alias("item_id"), w.alias("w")).filter(F.size("w") > 0)
    return items.select("item_id", F.explode(F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("w") - (WINDOW - 1), F.lit(1))),
        lambda i: F.slice("w", i, WINDOW))).alias("words")).distinct()


def blocks(benchmark: DataFrame):
    """Blocks of at most BLOCK windows, read one after the other."""
    rows = []
    for r in windows(benchmark).toLocalIterator():
        rows.append(r)
        if len(rows) == BLOCK:
            yield _block(rows)
            rows = []
    if rows:
        yield _block(rows)


def build_index(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """(every column but the text, n_words, term array<int>, place array<int>): the postings of
    ``terms`` in each document, by place; stored in the shared folder."""
    @tidy
    def run(batches):
        for batch in batches:
            body, offsets = flat(batch.column("text"))
            hashes, row = words(body, offsets, _WORD, LOWER)
            count = np.bincount(row, minlength=len(batch))
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            number = np.minimum(np.searchsorted(terms, hashes), max(len(terms) - 1, 0))
            known = terms[number] == hashes if len(terms) else np.zeros(len(hashes), bool)
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[known], minlength=len(batch)))])
            ends = pa.array(ends.astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(x[known].astype(np.int32)))
                     for x in (number, place)]
            keep = [i for i, f in enumerate(batch.schema.names) if f != "text"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [pa.array(count.astype(np.int64))] + lists,
                [batch.schema.names[i] for i in keep] + ["n_words", "term", "place"])

    rest = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    return materialise(docs.mapInArrow(
        run, ", ".join(rest + ["n_words long", "term array<int>", "place array<int>"])), "postings")


def postings_count(index: DataFrame, n_terms: int) -> np.ndarray:
    """Postings of each term over the whole index (at most n_terms rows come back)."""
    @tidy
    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("term").flatten().to_numpy(), minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "n"])

    out = np.zeros(n_terms, np.int64)
    counted = index.select("term").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    for r in counted.toLocalIterator():
        out[r["term"]] = r["n"]
    return out


def _intersect(key, term, grid, order):
    """(window, key of its first word) of every exact occurrence.

    ``key`` ascends over (document, place); ``term`` is the term at each key.
    Candidates come from the rarest term of each window and are intersected
    with the shifted lists of the others in ascending order of their counts.
    """
    by = np.argsort(term, kind="stable")
    lists = term[by]
    rare = grid[np.arange(len(grid)), order[:, 0]]
    low, high = np.searchsorted(lists, rare, "left"), np.searchsorted(lists, rare, "right")
    n = high - low
    window = np.repeat(np.arange(len(grid)), n)
    place = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    first = key[by[place]] - order[window, 0]
    for k in range(1, grid.shape[1]):
        if not len(window):
            break
        offset = order[window, k]
        need = grid[window, offset]
        at = np.minimum(np.searchsorted(key, first + offset), len(key) - 1)
        ok = (need < 0) | ((key[at] == first + offset) & (term[at] == need))
        window, first = window[ok], first[ok]
    return window, first


def _near(key, term, n_terms, grid, order, slack):
    """Windows and keys of their rarest term where every other term occurs
    within ``slack`` words more than the window's length."""
    far = int(key[-1]) + 1 + 4 * (WINDOW + slack)
    by = np.argsort(term, kind="stable")
    lists = term[by] * far + key[by]
    rare = grid[np.arange(len(grid)), order[:, 0]]
    low, high = np.searchsorted(lists, rare * far), np.searchsorted(lists, (rare + 1) * far)
    n = high - low
    window = np.repeat(np.arange(len(grid)), n)
    place = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = key[by[place]]
    reach = (grid >= 0).sum(axis=1) + slack
    for k in range(1, grid.shape[1]):
        if not len(window):
            break
        need = grid[window, order[window, k]]
        lo = np.maximum(at - reach[window] + 1, 0)
        j = np.minimum(np.searchsorted(lists, need * far + lo), len(lists) - 1)
        ok = (need < 0) | (lists[j] < need * far + at + reach[window]) & (lists[j] >= need * far + lo)
        window, at = window[ok], at[ok]
    return window, at


def search(index: DataFrame, block: Block, counts: np.ndarray, slack: int = 5) -> DataFrame:
    """The index's own columns, n_words, ``hits`` (places of words inside exact
    occurrences), ``items`` and ``near_items`` (item_ids, sorted strings)."""
    cost = np.where(block.grid >= 0, counts[np.maximum(block.grid, 0)], np.iinfo(np.int64).max)
    order = np.argsort(cost, axis=1, kind="stable")   # missing offsets come last
    live = cost.min(axis=1) > 0
    grid, order, item = block.grid[live], order[live], block.item[live]
    ids = np.array(block.ids, dtype=object)
    n_terms = len(block.terms)

    def listed(row, number, n):
        pair = np.unique(np.column_stack([row, number]), axis=0) if len(row) else np.zeros((0, 2), np.int64)
        ends = np.concatenate([[0], np.cumsum(np.bincount(pair[:, 0], minlength=n))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids[pair[:, 1]], pa.string()))

    @tidy
    def run(batches):
        for batch in batches:
            term_col, place_col = batch.column("term"), batch.column("place")
            n = len(batch)
            count = np.diff(term_col.offsets.to_numpy())
            term = term_col.flatten().to_numpy().astype(np.int64)
            place = place_col.flatten().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(n), count)
            # rows lie 2 * (window + slack) apart, so no match reaches over
            pad = 2 * (WINDOW + slack)
            size = batch.column("n_words").to_numpy() + pad
            base = np.cumsum(size) - size
            key = base[row] + place
            covered = np.zeros(len(key) + 1, np.int64)
            window = near = np.zeros(0, np.int64)
            hit_row = near_row = np.zeros(0, np.int64)
            if len(key) and len(grid):
                window, first = _intersect(key, term, grid, order)
                at = np.searchsorted(key, first)
                np.add.at(covered, at, 1)
                np.add.at(covered, at + (grid[window] >= 0).sum(axis=1), -1)
                hit_row = row[at] if len(at) else hit_row
                near, spot = _near(key, term, n_terms, grid, order, slack)
                near_row = row[np.searchsorted(key, spot)] if len(spot) else near_row
            hit = np.cumsum(covered[:-1]) > 0
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[hit], minlength=n))]).astype(np.int32)
            hits = pa.ListArray.from_arrays(pa.array(ends), pa.array(place[hit].astype(np.int32)))
            keep = [i for i, f in enumerate(batch.schema.names) if f not in ("term", "place")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [hits, listed(hit_row, item[window], n),
                                                   listed(near_row, item[near], n)],
                [batch.schema.names[i] for i in keep] + ["hits", "items", "near_items"])

    rest = [f"`{f.name}` {f.dataType.simpleString()}" for f in index.schema if f.name not in ("term", "place")]
    return index.mapInArrow(run, ", ".join(
        rest + ["hits array<int>", "items array<string>", "near_items array<string>"]))


def find_benchmark(docs: DataFrame, benchmark: DataFrame, slack: int = 5) -> DataFrame:
    """``docs`` without its text but with n_words, hits, items, near_items.

    With several blocks the results of a row are merged by its number, which is
    written with the documents' own columns first. Columns of other names are kept.
    """
    inside = {"_row", "term", "place"}
    return aside(docs, ("text",), inside, lambda df: _find(df, benchmark, slack),
                 ("n_words", "hits", "items", "near_items"))


def _find(docs: DataFrame, benchmark: DataFrame, slack: int) -> DataFrame:
    found = []
    for block in blocks(benchmark):
        index = build_index(docs.withColumn("_row", F.monotonically_increasing_id()), block.terms)
        found.append(search(index, block, postings_count(index, len(block.terms)), slack))
    if not found:
        index = build_index(docs.withColumn("_row", F.monotonically_increasing_id()), np.zeros(0, np.uint64))
        none = F.array().cast("array<string>")
        found = [index.drop("term", "place").withColumns({
            "hits": F.array().cast("array<int>"), "items": none, "near_items": none})]
    if len(found) == 1:
        return found[0].drop("_row")
    together = found[0]
    for more in found[1:]:
        together = together.unionByName(more)
    own = [f for f in docs.columns if f != "text"]
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c)
    return together.groupBy("_row").agg(
        *[F.first(c).alias(c) for c in own], F.first("n_words").alias("n_words"),
        union("hits"), union("items"), union("near_items")).drop("_row")


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item."""
    out = find_benchmark(read(spark, sf_dir, "documents").select("doc_id", "text"),
                         read(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))
