"""Operator 12 - phrase collocation mining, HAT-trie counting.

A phrase is ``2 .. longest`` words in a row inside one piece of a text.  Whatever
holds ``least`` times has parts that hold as often, so the texts are read four times:

1. words: counts per task, added up by Spark;
2. a sieve: pairs of words are counted by hash slot.  A pair found
   ``least`` times lies in a slot that counts as much; few others do;
3. pairs in such slots, counted exactly, and a second sieve, of longer phrases
   all of whose pairs lie in such slots;
4. longer phrases in frequent slots of the second sieve whose pairs are all
   frequent, by a bit filter (``BITS``).

Sieves (``SLOTS`` to ``MOST_SLOTS``, by the number of words) and filter let
through every frequent phrase; whatever else they let through is counted
exactly, so their sizes change volumes and never results.

A task counts phrases in a HAT-trie (``HatTrie``): nodes by word id near the
root, hash containers of the remaining ids below, which burst into a node when
they grow beyond ``BURST`` entries.  When a task holds ``LIMIT`` entries, its
largest subtrees leave whole, as runs sorted by word id.  A run is cut by prefix
partition (hash of the language and the first two words, so a hot word is spread
over the words behind it) and packed, one row per part, with the texts of its
phrases.  Spark deals and sorts these rows by prefix partition, and a task merges
the runs of one partition after the other.

Score of a candidate (frequent phrase): the lowest floor(1000 a n / (l r)) over
its cuts, in 128-bit integers (decimals).  Candidates that lie in a longer one
as often as they occur are dropped; a chain of one-word extensions shows every
such case, so only neighbours in length are compared.

Defined results: null texts are empty, null languages are ``und``; texts of
white space have no words; repeated rows count as often as they are there; an
empty table has no phrases; columns other than ``lang`` and ``text`` are not
read.  Texts of any length are read in whole.
"""

from __future__ import annotations

from itertools import compress, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytesview import (
    LOWER, MIX, coded_words, flat, mix, prefix_hash, range_hash, slices, tidy,
)
from tidemark.llm.common import discard, materialise, read

SLICE = 1 << 22            # bytes of text counted at once
BURST = 4_096              # entries of a container
DEPTH = 3                  # word ids that the trie's nodes may consume
LIMIT = 1 << 19            # entries a task holds
BITS = 1 << 24             # bits of the filter of frequent pairs
SLOTS, MOST_SLOTS = 1 << 26, 1 << 28   # slots of a sieve
SPAN = 1 << 14             # neighbouring slots that travel together (with SLOTS)
DISTINCT = 1 << 20         # words with a count that a task holds
PENDING = 1 << 22          # slots with a count that a task holds
RUN = 1 << 18              # phrases of a run
MERGED = 1 << 20           # phrases of a prefix partition that wait for a merge
SPREAD, PREFIXES = 4, 256  # prefix partitions of a task, and of all at most
PARTS = 16                 # parts of a language that are ranked on their own first

#: fixed values: bytes that end a piece, bytes between words
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"

_CLASS = LOWER.copy()
_CLASS[list(GAPS)] = 0x20
_CLASS[list(ENDS)] = 0x0A


def _words(text: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(words of all texts in order, whether a word lies in one piece with the next)."""
    words, start, body, ends = coded_words(text, _CLASS, b" \n")
    breaks = body == 0x0A
    breaks[ends[ends < len(body)]] = True
    joined = np.zeros(len(start), bool)
    joined[:-1] = True
    behind = np.searchsorted(start, np.flatnonzero(breaks))
    joined[behind[behind > 0] - 1] = False
    return words, joined


def _by_language(batches):
    """(language, texts): texts of one language, about ``SLICE`` bytes if there are so many."""
    waiting: dict[str, list[pa.Array]] = {}
    held: dict[str, int] = {}

    def whole(one):
        del held[one]
        return one, pa.concat_arrays(waiting.pop(one))

    for batch in (part for whole in batches for part in slices(whole, "text", SLICE)):
        lang = batch.column("lang")
        for one in pc.unique(lang).to_pylist():
            texts = batch.column("text").filter(pc.equal(lang, one))
            size = pc.sum(pc.binary_length(texts)).as_py() or 0
            if one in held and held[one] + size > SLICE:
                yield whole(one)
            waiting.setdefault(one, []).append(texts)
            held[one] = held.get(one, 0) + size
        while sum(held.values()) > 4 * SLICE:
            yield whole(max(held, key=held.get))
    for one in list(held):
        yield whole(one)


def _hashes(lang: str, words: pa.Array) -> np.ndarray:
    body, ends = flat(words)
    tag = np.frombuffer(lang.encode(), np.uint8)
    salt = range_hash(prefix_hash(tag), np.zeros(1, np.int64), np.array([len(tag)]))
    return mix(range_hash(prefix_hash(body), ends[:-1], ends[1:]) + salt[0])


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(MIX[0]) + b)


def _places(h: np.ndarray, bits: int) -> np.ndarray:
    """Three bit numbers per hash."""
    step = mix(h) | np.uint64(1)
    return np.stack([(h + np.uint64(i) * step) % np.uint64(bits) for i in range(3)])


def _bit(at: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return ((mask[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)


def _passes(h: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return _bit(_places(h, len(mask) * 64), mask).all(axis=0)


def _in_sieve(h: np.ndarray, mask: np.ndarray) -> np.ndarray:
    return _bit(h % np.uint64(len(mask) * 64), mask)


def _dealt(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _to_mask(rows: DataFrame, bits: int) -> np.ndarray:
    """Words of 64 bits from rows (slot, mask); ``bits`` bounds what reaches the driver."""
    table = rows.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[table["slot"].to_numpy()] = table["mask"].to_numpy().view(np.uint64)
    return out


def bit_filter(pairs: DataFrame, bits: int = BITS) -> np.ndarray:
    """The bits of every pair (lang, phrase), three each."""
    @tidy
    def run(batches):
        for batch in batches:
            for one in pc.unique(batch.column("lang")).to_pylist():
                parts = pc.split_pattern(batch.column("phrase").filter(pc.equal(batch.column("lang"), one)), " ")
                at = _places(_pair_hash(_hashes(one, pc.list_element(parts, 0)),
                                        _hashes(one, pc.list_element(parts, 1))), bits).ravel()
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at >> np.uint64(6)).astype(np.int64)),
                     pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], ["slot", "mask"])

    return _to_mask(pairs.select("lang", "phrase").mapInArrow(run, "slot long, mask long"), bits)


def _added(slots: np.ndarray, counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct slots in order, their counts added up, ``most`` at most."""
    if not len(slots):
        return slots, counts
    both = slots.astype(np.uint64) << np.uint64(16)
    both |= counts
    both.sort()
    at = (both >> np.uint64(16)).astype(np.uint32)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    total = np.add.reduceat(both & np.uint64(0xFFFF), first)
    return at[first], np.minimum(total, np.uint64(most)).astype(np.uint16)


def _span(slots: int) -> int:
    return min(slots, max(SPAN, min(slots * SPAN // SLOTS, 1 << 16)))


class _SlotCounts:
    """Counts by hash slot of a task, ``most`` at most, given away when there are
    more than ``PENDING``.  What comes in is added up only once there is much of it."""

    def __init__(self, slots: int, most: int):
        self.slots, self.most, self.span = slots, most, _span(slots)
        self._empty()

    def _empty(self):
        self.held = np.zeros(0, np.uint32), np.zeros(0, np.uint16)
        self.new, self.waiting = [], 0

    def add(self, h: np.ndarray) -> bool:
        """Whether it is time for ``rows``."""
        at, n = np.unique((h % np.uint64(self.slots)).astype(np.uint32), return_counts=True)
        self.new.append((at, np.minimum(n, self.most).astype(np.uint16)))
        self.waiting += len(at)
        if self.waiting > PENDING // 2:
            self._add_up()
        return len(self.held[0]) > PENDING

    def _add_up(self):
        at, counts = zip(self.held, *self.new)
        self.held = _added(np.concatenate(at), np.concatenate(counts), self.most)
        self.new, self.waiting = [], 0

    def rows(self) -> list[pa.Array]:
        """Ranges of slots and their packed counts, of everything since the last call."""
        self._add_up()
        at, counts = self.held
        self._empty()
        first = np.searchsorted(at // self.span, np.arange(self.slots // self.span + 1))
        used = np.flatnonzero(np.diff(first))
        packed = [zstandard.compress((at[a:b] % self.span).astype(np.uint16).tobytes() + counts[a:b].tobytes())
                  for a, b in zip(first[used], first[used + 1])]
        return [pa.array(used.astype(np.int32)), pa.array(packed, pa.binary())]


def _most(least: int) -> int:
    """The highest count of a slot: enough to tell that ``least`` was reached."""
    return min(least, 65_535)


def _sieve(counted: DataFrame, least: int, slots: int) -> np.ndarray:
    """One bit per slot from rows (range, counts): ``least`` or more were counted in it."""
    most, span = _most(least), _span(slots)

    @tidy
    def add(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, packed in zip(batch.column("range").to_pylist(), batch.column("counts")):
                both = np.frombuffer(zstandard.decompress(packed.as_buffer()), np.uint16)
                place, n = both[:len(both) // 2], both[len(both) // 2:]
                held = total.setdefault(number, np.zeros(span, np.uint16))
                held[place] = np.minimum(held[place].astype(np.int64) + n, most)
        for number, held in total.items():
            mask = np.packbits(held >= most, bitorder="little").view(np.uint64)
            used = np.flatnonzero(mask)
            yield pa.RecordBatch.from_arrays([pa.array(number * (span // 64) + used),
                                              pa.array(mask[used].view(np.int64))], ["slot", "mask"])

    dealt = counted.repartition(_dealt(counted), "range")
    return _to_mask(dealt.mapInArrow(add, "slot long, mask long"), slots)


def pair_sieve(docs: DataFrame, least: int, slots: int = SLOTS) -> np.ndarray:
    """One bit per slot: pairs of words in it were found ``least`` times or more."""
    @tidy
    def count(batches):
        seen = _SlotCounts(slots, _most(least))
        for lang, texts in _by_language(batches):
            words, joined = _words(texts)
            h = _hashes(lang, words.dictionary)[words.indices.to_numpy()]
            at = np.flatnonzero(joined)
            if seen.add(_pair_hash(h[at], h[at + 1])):
                yield pa.RecordBatch.from_arrays(seen.rows(), ["range", "counts"])
        yield pa.RecordBatch.from_arrays(seen.rows(), ["range", "counts"])

    return _sieve(docs.mapInArrow(count, "range int, counts binary"), least, slots)


class _Node(dict):
    """Children by word id (four bytes): nodes or containers."""


class HatTrie:
    """Counts of sequences of word ids, each id four bytes (highest first)."""

    def __init__(self, longest: int, burst: int = BURST):
        self.root, self.size, self.longest, self.burst = _Node(), 0, longest, burst

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        """Distinct sequences, one per row, in order, and their counts."""
        if not len(rows):
            return
        rows = np.ascontiguousarray(rows.astype(">u4"))
        keys = rows.view(f"V{4 * rows.shape[1]}").ravel().tolist()
        self._descend(self.root, 0, keys, counts.tolist(), np.flatnonzero(np.diff(rows[:, 0])) + 1)

    def _descend(self, node, depth, keys, counts, edges=None):
        if edges is None:
            edges = [i for i in range(1, len(keys)) if keys[i][:4] != keys[i - 1][:4]]
        bounds = [0, *map(int, edges), len(keys)]
        for a, b in zip(bounds, bounds[1:]):
            head, rest = keys[a][:4], [k[4:] for k in keys[a:b]]
            child = node.get(head)
            if type(child) is _Node:
                self._descend(child, depth + 1, rest, counts[a:b])
                continue
            if child is None:
                child = node[head] = {}
            before, get = len(child), child.get
            for key, n in zip(rest, counts[a:b]):
                child[key] = get(key, 0) + n
            self.size += len(child) - before
            if len(child) > self.burst and depth + 1 < min(DEPTH, self.longest - 1):
                node[head] = self._burst(child)

    @staticmethod
    def _burst(container: dict) -> _Node:
        node = _Node()
        for key, n in container.items():
            node.setdefault(key[:4], {})[key[4:]] = n
        return node

    @staticmethod
    def _entries(child) -> int:
        return sum(map(HatTrie._entries, child.values())) if type(child) is _Node else len(child)

    def _run(self, prefix: bytes, child):
        if type(child) is _Node:
            for key in sorted(child):
                yield from self._run(prefix + key, child[key])
        else:
            yield from sorted([(prefix + key, n) for key, n in child.items()])

    def spill(self, keep: int):
        """Take out the largest subtrees until ``keep`` entries are left, each as
        a sorted run of (key, count)."""
        sizes = sorted(((self._entries(c), head) for head, c in self.root.items()), reverse=True)
        for entries, head in sizes:
            if self.size <= keep:
                return
            child = self.root.pop(head)
            self.size -= entries
            yield from self._run(head, child)


def _packed_runs(lang: str, vocabulary: list[str], run, prefixes: int):
    """Batches (lang, prefix, n, run): the phrases of a run by prefix partition,
    n counts of eight bytes and then the phrases, one a line."""
    words = pa.array(vocabulary, pa.string())
    h = _hashes(lang, words)

    def phrases(size, keys):
        ids = np.frombuffer(b"".join(keys), ">u4").reshape(-1, size // 4).astype(np.int32)
        return (pc.binary_join_element_wise(*[words.take(pa.array(ids[:, j])) for j in range(ids.shape[1])], " "),
                (_pair_hash(h[ids[:, 0]], h[ids[:, 1]]) % np.uint64(prefixes)).astype(np.int64))

    run = iter(run)
    while some := list(islice(run, RUN)):
        keys, counts = zip(*some)
        sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        texts, prefix = zip(*(phrases(size, compress(keys, (sizes == size).tolist())) for size in np.unique(sizes).tolist()))
        prefix = np.concatenate(prefix)
        counts = np.fromiter(counts, np.int64, len(keys))[np.argsort(sizes, kind="stable")]
        order = np.argsort(prefix, kind="stable")
        counts = counts[order]
        first = np.searchsorted(prefix[order], np.arange(prefixes + 1))
        used = np.flatnonzero(np.diff(first))
        ends = np.append(first[used], len(counts)).astype(np.int32)
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), pa.concat_arrays(texts).take(pa.array(order))), "\n")
        packed = [zstandard.compress(counts[a:b].tobytes() + x.as_buffer().to_pybytes())
                  for a, b, x in zip(ends, ends[1:], lines)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)),
             pa.array(np.diff(ends)), pa.array(packed, pa.binary())], ["lang", "prefix", "n", "run"])


def _longer_hashes(h, joined, longest, sieve=None):
    """(size, starts, hashes) of the phrases of 2 .. ``longest`` words of a slice;
    ``joined[i]`` says that words i and i + 1 may lie in a phrase.  Of more than
    two words: only those in slots of ``sieve``, if there is one."""
    at = np.flatnonzero(joined)
    longer = h[at]
    for size in range(2, longest + 1):
        if size > 2:
            good = joined[at + size - 2]
            at, longer = at[good], longer[good]
        longer = _pair_hash(longer, h[at + size - 1])
        if size > 2 and sieve is not None:
            good = _in_sieve(longer, sieve)
            at, longer = at[good], longer[good]
        yield size, at, longer


def _phrases(ids, h, joined, sizes, sieve=None):
    """(rows of word ids, counts) of the distinct phrases of a slice, by size."""
    for size, at, _ in _longer_hashes(h, joined, max(sizes), sieve):
        if size in sizes:
            group = ids[at].astype(np.uint64)
            for j in range(1, size - 1):
                group = np.unique((group << np.uint64(32)) | ids[at + j].astype(np.uint64), return_inverse=True)[1]
                group = group.astype(np.uint64)
            key = (group << np.uint64(32)) | ids[at + size - 1].astype(np.uint64)
            if size == 2:
                key, counts = np.unique(key, return_counts=True)
                yield np.stack([key >> np.uint64(32), key & np.uint64(0xFFFFFFFF)], axis=1), counts
            else:
                _, place, counts = np.unique(key, return_index=True, return_counts=True)
                yield ids[at[place][:, None] + np.arange(size)], counts


def phrase_runs(docs: DataFrame, passes, sizes: tuple[int, ...], limit: int = LIMIT, burst: int = BURST,
                sieve: np.ndarray | None = None, longer: tuple[int, int, int] | None = None) -> DataFrame:
    """(lang, prefix, n, run): sorted runs of phrase counts of every task.  Only
    phrases whose pairs pass ``passes`` (of their hashes) and that lie in slots of
    ``sieve`` count.  With ``longer`` (longest, least, slots) there are rows without
    a language, too: (range, counts of slots) as (prefix, run), for a sieve of phrases
    of 3 .. longest words."""
    prefixes = min(SPREAD * _dealt(docs), PREFIXES)

    def slot_rows(seen):
        at, counts = seen.rows()
        return pa.RecordBatch.from_arrays([pa.nulls(len(at), pa.string()), at, pa.nulls(len(at), pa.int32()), counts],
                                          ["lang", "prefix", "n", "run"])

    @tidy
    def run(batches):
        tries: dict[str, tuple[HatTrie, dict, list]] = {}
        seen = _SlotCounts(longer[2], _most(longer[1])) if longer else None
        for lang, texts in _by_language(batches):
            trie, number, vocabulary = tries.setdefault(lang, (HatTrie(max(sizes), burst), {}, []))
            words, joined = _words(texts)
            codes = words.indices.to_numpy()
            h = _hashes(lang, words.dictionary)[codes]
            at = np.flatnonzero(joined)
            at = at[passes(_pair_hash(h[at], h[at + 1]))]
            joined[:] = False
            joined[at] = True
            if longer:
                for size, _, hashes in _longer_hashes(h, joined, longer[0]):
                    if size > 2 and seen.add(hashes):
                        yield slot_rows(seen)
            used = np.zeros(len(words.dictionary), bool)
            used[codes[at]] = used[codes[at + 1]] = True
            ids = np.zeros(len(used), np.int64)
            for i, word in zip(np.flatnonzero(used).tolist(), words.dictionary.filter(pa.array(used)).to_pylist()):
                if word not in number:
                    number[word] = len(vocabulary)
                    vocabulary.append(word)
                ids[i] = number[word]
            for rows, counts in _phrases(ids[codes], h, joined, sizes, sieve):
                trie.add(rows, counts)
                if sum(t.size for t, _, _ in tries.values()) > limit:
                    for one, (full, _, known) in tries.items():
                        yield from _packed_runs(one, known, full.spill(full.size // 2), prefixes)
        for lang, (trie, _, vocabulary) in tries.items():
            yield from _packed_runs(lang, vocabulary, trie.spill(-1), prefixes)
        if longer:
            yield slot_rows(seen)

    return docs.mapInArrow(run, "lang string, prefix int, n int, run binary")


def _added_up(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("phrase").aggregate([("f", "sum")]).rename_columns(["phrase", "f"])


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, phrase, f): counts of words; a null phrase counts all words."""
    @tidy
    def run(batches):
        held: dict[str, list[pa.Table]] = {}
        waiting = 0

        def all_rows():
            for lang, tables in held.items():
                for batch in _added_up(tables).combine_chunks().to_batches():
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(batch), pa.string()), *batch.columns],
                                                     ["lang", "phrase", "f"])
            held.clear()

        for lang, texts in _by_language(batches):
            words, _ = _words(texts)
            counts = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            known = pa.concat_arrays([words.dictionary, pa.nulls(1, pa.string())])
            held.setdefault(lang, []).append(
                pa.table({"phrase": known, "f": pa.array(np.append(counts, len(words)).astype(np.int64))}))
            waiting += len(known)
            if waiting > DISTINCT:
                for one, tables in held.items():
                    held[one] = [_added_up(tables)]
                waiting = sum(len(tables[0]) for tables in held.values())
                if waiting > DISTINCT // 2:
                    yield from all_rows()
                    waiting = 0
        yield from all_rows()

    return (docs.mapInArrow(run, "lang string, phrase string, f long")
            .groupBy("lang", "phrase").agg(F.sum("f").alias("f")))


def merge_runs(runs: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, f) of frequent phrases: the runs of each prefix partition merged."""
    @tidy
    def run(batches):
        now, waiting, rows = None, {}, {}

        def finished():
            for lang, tables in waiting.items():
                out = _added_up(tables)
                out = out.filter(pc.greater_equal(out["f"], least)).combine_chunks()
                yield from out.add_column(0, "lang", pa.array([lang] * len(out), pa.string())).to_batches()
            waiting.clear()
            rows.clear()

        for batch in batches:
            for lang, prefix, n, packed in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if prefix != now:
                    yield from finished()
                    now = prefix
                body = zstandard.decompress(packed)
                phrases = pc.split_pattern(pa.array([body[8 * n:]], pa.binary()).cast(pa.string()), "\n").flatten()
                tables = waiting.setdefault(lang, [])
                tables.append(pa.table({"phrase": phrases, "f": pa.array(np.frombuffer(body, np.int64, n))}))
                rows[lang] = rows.get(lang, 0) + n
                if rows[lang] > 2 * max(MERGED, len(tables[0])):
                    waiting[lang] = [_added_up(tables)]
                    rows[lang] = len(waiting[lang][0])
        yield from finished()

    near = runs.repartition(_dealt(runs), "prefix").sortWithinPartitions("prefix")
    return near.mapInArrow(run, "lang string, phrase string, f long")


def slots_for(words: DataFrame) -> int:
    """Slots of the sieves: at most eight words a slot, as far as ``MOST_SLOTS`` allow."""
    n = words.filter("phrase IS NULL").agg(F.sum("f")).first()[0] or 0
    return min(MOST_SLOTS, max(SLOTS, 1 << (n // 8).bit_length()))


def frequent(docs: DataFrame, least: int = 100, longest: int = 5, bits: int = BITS, slots: int | None = None,
             limit: int = LIMIT, burst: int = BURST) -> tuple[DataFrame, DataFrame]:
    """(totals, counts): (lang, n) and (lang, phrase, size, f) of every phrase of
    1 .. ``longest`` words found at least ``least`` times."""
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text")).filter("text != ''")
    words = materialise(word_counts(docs).filter(F.col("phrase").isNull() | (F.col("f") >= least)), "words")
    slots = slots or slots_for(words)
    mask = pair_sieve(docs, least, slots)
    counted = materialise(phrase_runs(docs, lambda h: _in_sieve(h, mask), (2,), limit, burst,
                                      longer=(longest, least, slots) if longest > 2 else None), "runs")
    pairs = materialise(merge_runs(counted.filter("lang IS NOT NULL"), least), "pairs")
    found = words.filter("phrase IS NOT NULL").unionByName(pairs)
    if longest > 2:
        sieve = _sieve(counted.filter("lang IS NULL").select(F.col("prefix").alias("range"), F.col("run").alias("counts")),
                       least, slots)
        known = bit_filter(pairs, bits)
        runs = phrase_runs(docs, lambda h: _passes(h, known), tuple(range(3, longest + 1)), limit, burst, sieve)
        found = found.unionByName(materialise(merge_runs(runs, least), "phrases"))
    discard(counted)
    counts = found.select("lang", "phrase", (F.length("phrase") - F.length(F.replace("phrase", F.lit(" "))) + 1).alias("size"), "f")
    return words.filter("phrase IS NULL").select("lang", F.col("f").alias("n")), counts


def mine(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, **memory) -> DataFrame:
    """The ``top`` phrases of every language by score, with a, l, r and n."""
    totals, counts = frequent(docs, least, longest, **memory)
    some = counts.filter("size > 1").withColumnRenamed("f", "a")
    # the longest parts of a phrase that occur as often: they say nothing more
    words = lambda n: F.expr(f"substring_index(phrase, ' ', {n})")  # noqa: E731 (the first n, or the last -n)
    inner = (some.filter("size > 2")
             .select("lang", "a", F.explode(F.array(words("size - 1"), words("1 - size"))).alias("phrase")))
    kept = some.join(inner, ["lang", "phrase", "a"], "left_anti")
    cuts = (kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", "a", "k", words("k").alias("first"), words("k - size").alias("rest")))
    part = lambda name, value: counts.select("lang", F.col("phrase").alias(name), F.col("f").alias(value))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    valued = (cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
              .join(totals, "lang")
              .withColumns({"over": wide("a") * 1000 * wide("n"), "under": wide("l") * wide("r")})
              .withColumn("score", F.expr("over div under")))
    best = (valued.groupBy("lang", "phrase", "a", "n")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
            .select("lang", "phrase", "a", "best.l", "best.r", "n", "best.score"))
    # the best of every part of a language first, so that no task gets all of one
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).orderBy(*order)
    best = best.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    whole = Window.partitionBy("lang").orderBy(*order)
    return (best.withColumn("rank", F.row_number().over(whole)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op12_collocations(spark, sf_dir: str) -> DataFrame:
    """The 2000 strongest collocations of each language."""
    return mine(read(spark, sf_dir, "documents"))
