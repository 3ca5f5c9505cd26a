"""Operator 2 - exact substring dedup by prefix-free parsing.

Every byte covered by a string of ``LENGTH`` bytes that also starts earlier
(smaller doc_id, or the same document and an earlier start) is removed.

Parse.  A rolling hash of ``GRAM`` bytes runs over each text.  The trigger of a
start s is the leftmost position of the smallest hash in s .. s+LENGTH-GRAM, so
it depends on the LENGTH bytes at s alone: equal strings have their trigger at
the same relative place.  Consecutive starts with one trigger make a phrase;
a phrase spans the strings of all its starts, so neighbours overlap by
LENGTH-1 bytes (no phrase is a prefix of the next context).  About one start
in 39 opens a phrase.

Dictionary and parse order.  Two equal strings lie in phrases with the same
trigger bytes.  Phrases are therefore grouped by trigger: equal phrases stand
for equal runs of suffixes, so all but the first in corpus order are duplicate
as a whole (copied text costs one dictionary entry however often it occurs);
where one trigger has several distinct phrases, the suffixes of these
dictionary entries are sorted (by the hash of their first LENGTH bytes: only
equality at that depth matters) and all but the first in corpus order are
duplicate.  Nothing is compared pairwise.

Skew.  A common phrase is combined in the map task: later copies inside one
batch leave as merged runs and need no key.  A trigger with more than ``HOT``
distinct phrases in a batch is salted by its phrases and announced by one
beacon row.  Triggers with at most ``CLOSE`` phrases have their dictionary
entries sorted in one task; for the others every suffix is a row of its own,
keyed by its hash, again combined in the map task.  Both ways are exact.

Defined results: null text is empty; texts shorter than LENGTH keep all
bytes; rows are identified by (doc_id, CRC of the text), so repeated equal
rows get the same result as one row; rows sharing a doc_id are ordered by CRC;
a null doc_id sorts first; an empty table gives no rows; other columns are
kept by ``remove_repeats``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bytesview import MIX, flat, mix, prefix_hash, range_hash, tidy
from tidemark.llm.common import aside, materialise, read

LENGTH = 100
GRAM = 24
SPAN = LENGTH - GRAM + 1        # hash positions inside one string
PIECE = 1 << 18                 # bytes hashed at once
HOT = 32                        # distinct phrases of a trigger in one batch
CLOSE = 512                     # phrases of a trigger that one task compares

_PHRASES = "key long, ph long, doc_id long, place long, tag long"
FIRST, DUP, SALTED, BEACON = 0, 1, 2, 3


def _pieces(offsets: np.ndarray):
    """(document, first byte, end byte) pieces; long texts overlap by LENGTH-1.

    Yields lists of pieces of about PIECE bytes together.
    """
    group, size = [], 0
    for d in range(len(offsets) - 1):
        start, end = int(offsets[d]), int(offsets[d + 1])
        while end - start >= LENGTH:
            stop = min(end, start + PIECE)
            group.append((d, start, stop))
            size += stop - start
            if size >= PIECE:
                yield group
                group, size = [], 0
            if stop == end:
                break
            start = stop - LENGTH + 1
    if group:
        yield group


def _grams(body: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at every position of ``body``."""
    words = np.ndarray((len(body) - 7,), dtype="<u8", buffer=np.ascontiguousarray(body), strides=(1,)).copy()
    n = len(body) - GRAM + 1
    x = words[:n] * np.uint64(MIX[0])
    x += (words[8:8 + n] ^ (words[8:8 + n] >> np.uint64(29))) * np.uint64(MIX[1])
    x += (words[16:16 + n] ^ (words[16:16 + n] >> np.uint64(31))) * np.uint64(MIX[2])
    return mix(x)


def _window_min(key: np.ndarray) -> np.ndarray:
    """Minimum of every SPAN consecutive keys."""
    width, least = 1, key
    while width * 2 <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.minimum(least[:len(key) - SPAN + 1], least[SPAN - width:]) if width < SPAN else least


def _parse(body: np.ndarray, offsets: np.ndarray):
    """Phrases of a batch: arrays (trigger hash, phrase hash, row, first start, starts)."""
    out = []
    for group in _pieces(offsets):
        text = np.concatenate([body[s:e] for _, s, e in group])
        lens = np.array([e - s for _, s, e in group])
        at = np.concatenate([[0], np.cumsum(lens)])
        gram = _grams(text)
        place = np.arange(len(gram), dtype=np.uint64)
        low = np.uint64((1 << 23) - 1)
        owner = (_window_min((gram & ~low) | place) & low).astype(np.int64)
        starts = np.arange(len(owner))
        piece = np.searchsorted(at, starts, "right") - 1
        ok = starts + LENGTH <= at[piece + 1]
        new = np.ones(len(owner), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (piece[1:] != piece[:-1])
        first = np.flatnonzero(new & ok)
        # a phrase ends where the next one or the invalid tail begins
        edge = np.flatnonzero(new | ~ok)
        following = np.append(edge, len(owner))[np.searchsorted(edge, first, "right")]
        n = following - first
        prefix = prefix_hash(text)
        end = first + n - 1 + LENGTH
        phrase = range_hash(prefix, first, end) ^ mix((owner[first] - first).astype(np.uint64) + np.uint64(1))
        p = piece[first]
        row = np.array([d for d, _, _ in group])[p]
        base = np.array([s for _, s, _ in group])[p] - at[:-1][p]
        out.append((gram[owner[first]].view(np.int64), phrase.view(np.int64), row,
                    first + base - offsets[row], n))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))


def _order(batch: pa.RecordBatch) -> np.ndarray:
    """Dense rank of every row in (doc_id, crc) order, null first."""
    ids = batch.column("doc_id")
    keys = (batch.column("crc").to_numpy(), ids.fill_null(0).to_numpy(zero_copy_only=False),
            np.asarray(ids.is_valid()))
    by = np.lexsort(keys)
    step = np.zeros(len(by), np.int64)
    for k in keys:
        step[1:] |= k[by][1:] != k[by][:-1]
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(step)
    return rank


def _later(same: np.ndarray, rank: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Sorted rows that equal the row before and lie elsewhere."""
    out = np.zeros(len(rank), bool)
    out[1:] = same & ((rank[1:] != rank[:-1]) | (place[1:] != place[:-1]))
    return out


def _runs(row, start, n):
    """Merge runs of starts of one row that touch; sorted by (row, start)."""
    by = np.lexsort((start, row))
    row, start, end = row[by], start[by], (start + n)[by]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (start[1:] > end[:-1])
    first = np.flatnonzero(new)
    return row[first], start[first], (np.maximum.reduceat(end, first) if len(first) else end) - start[first]


def _place(batch, row, start):
    """Columns doc_id and place (CRC and start, in one long that keeps their order)."""
    crc = batch.column("crc").to_numpy().astype(np.int64)
    return batch.column("doc_id").take(pa.array(row)), pa.array((crc[row] << 32) | start)


@tidy
def parse_phrases(batches):
    """mapInArrow: documents (doc_id, crc, text) to phrase rows.

    ``key`` is the trigger, xor-ed with the salt of hot ones; ``tag`` holds
    starts << 16 | salt << 4 | kind.  Copies inside the batch leave as merged
    runs that meet nothing else.
    """
    names = ["key", "ph", "doc_id", "place", "tag"]
    for batch in batches:
        body, offsets = flat(batch.column("text"))
        a, ph, row, l, n = _parse(body, offsets)
        if not len(a):
            continue
        rank = _order(batch)[row]
        by = np.lexsort((l, rank, ph, a))
        a, ph, row, l, n, rank = a[by], ph[by], row[by], l[by], n[by], rank[by]
        dup = _later((a[1:] == a[:-1]) & (ph[1:] == ph[:-1]), rank, l)
        d_row, d_l, d_n = _runs(row[dup], l[dup], n[dup])
        a, ph, row, l, n = a[~dup], ph[~dup], row[~dup], l[~dup], n[~dup]
        new = np.ones(len(a), bool)
        new[1:] = a[1:] != a[:-1]
        group = np.cumsum(new) - 1
        hot = np.bincount(group)[group] > HOT
        salt = np.where(hot, 1 + (ph & 1023), 0)
        told = a[new & hot]
        ids, place = _place(batch, np.concatenate([row, d_row]), np.concatenate([l, d_l]))
        d_key = mix((d_row * 8191 + d_l).astype(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([a ^ (salt << 48), d_key])),
            pa.array(np.concatenate([ph, np.zeros(len(d_l), np.int64)])), ids, place,
            pa.array(np.concatenate([(n << 16) | (salt << 4) | np.where(hot, SALTED, FIRST),
                                     (d_n << 16) | DUP]))], names)
        if len(told):
            k = len(told)
            zero = pa.array(np.zeros(k, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(told), zero, pa.nulls(k, pa.int64()), zero, pa.array(np.full(k, BEACON))], names)


def _elsewhere(order):
    """Equal to the row before in ``order``, and not the same place of the corpus."""
    here = F.struct("doc_id", "place")
    return F.lag(here).over(order).isNotNull() & ~F.lag(here).over(order).eqNullSafe(here)


def classify(phrases: DataFrame) -> DataFrame:
    """Phrase rows that matter: ``whole`` duplicates (trigger null), and first
    phrases whose trigger has other phrases too, which need the suffix step
    (``hot``: too many to be compared in one task)."""
    trigger = Window.partitionBy("key")
    equal = Window.partitionBy("key", "ph").orderBy(F.col("doc_id").asc_nulls_first(), "place")
    kind, salt = F.col("tag").bitwiseAND(15), F.shiftright("tag", 4).bitwiseAND(4095)
    hot = ((kind == SALTED) | (F.max((kind == BEACON).cast("int")).over(trigger) == 1)
           | (F.count("*").over(trigger) > CLOSE))
    return (
        phrases.withColumn("hot", hot)
        .withColumn("_many", F.col("hot") | (F.min("ph").over(trigger) != F.max("ph").over(trigger)))
        .filter(kind != BEACON)
        .withColumn("whole", (kind == DUP) | _elsewhere(equal))
        .filter(F.col("whole") | F.col("_many"))
        .select("doc_id", F.shiftright("place", 32).cast("int").alias("crc"),
                F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("l"),
                F.shiftright("tag", 16).cast("int").alias("n"),
                F.when(~F.col("whole"), F.col("key").bitwiseXOR(F.shiftleft(salt, 48))).alias("a"), "hot"))


def _opened(batch):
    """(document, text, l, n, a) of the listed phrases of each document of a batch."""
    body, offsets = flat(batch.column("text"))
    lists = batch.column("phrases")
    edge = np.concatenate([[0], np.cumsum(np.diff(lists.offsets.to_numpy()))])
    fields = lists.flatten()
    l, n, a = (fields.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
    for d in range(len(batch)):
        mine = slice(edge[d], edge[d + 1])
        yield d, body[offsets[d]:offsets[d + 1]], l[mine], n[mine], a[mine]


@tidy
def suffixes(batches):
    """mapInArrow: the suffixes of hot phrases, one row each."""
    names = ["a", "g", "salt", "doc_id", "place", "dup"]
    for batch in batches:
        got = []
        for d, text, l, n, a in _opened(batch):
            start = np.repeat(l, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            key = np.repeat(a, n)
            by = np.argsort(start, kind="stable")
            start, key = start[by], key[by]
            # hash the covered stretches in pieces of bounded size
            cut = np.flatnonzero(np.append(True, (start[1:] // PIECE) != (start[:-1] // PIECE)))
            for x, y in zip(cut, np.append(cut[1:], len(start))):
                low = int(start[x])
                prefix = prefix_hash(text[low:int(start[y - 1]) + LENGTH])
                s = start[x:y] - low
                got.append((key[x:y], range_hash(prefix, s, s + LENGTH).view(np.int64),
                            np.full(y - x, d), start[x:y]))
        if not got:
            continue
        a, g, row, s = (np.concatenate(x) for x in zip(*got))
        rank = _order(batch)[row]
        by = np.lexsort((s, rank, g, a))
        a, g, row, s, rank = a[by], g[by], row[by], s[by], rank[by]
        dup = _later((a[1:] == a[:-1]) & (g[1:] == g[:-1]), rank, s)
        ids, place = _place(batch, row, s)
        yield pa.RecordBatch.from_arrays([
            pa.array(a), pa.array(g), pa.array(np.where(dup, 1 + ((g ^ s) & 1023), 0), pa.int32()),
            ids, place, pa.array(dup)], names)


@tidy
def contexts(batches):
    """mapInArrow: the bytes of phrases that few others share a trigger with."""
    names = ["a", "doc_id", "crc", "l", "bytes"]
    for batch in batches:
        rows = [(d, int(ll), int(aa), text[ll:ll + nn - 1 + LENGTH].tobytes())
                for d, text, l, n, a in _opened(batch) for ll, nn, aa in zip(l, n, a)]
        if rows:
            d, l, a, text = zip(*rows)
            at = pa.array(d)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), batch.column("doc_id").take(at), batch.column("crc").take(at),
                 pa.array(l, pa.int32()), pa.array(text, pa.binary())], names)


def _compare(table: pa.RecordBatch) -> pa.RecordBatch:
    """Runs of suffixes of whole trigger groups that occur earlier."""
    data = table.column("bytes").cast(pa.large_binary())
    offsets = np.frombuffer(data.buffers()[1], np.int64)[data.offset:data.offset + len(data) + 1]
    body = np.frombuffer(data.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    n = np.diff(offsets) - LENGTH + 1
    row = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = offsets[row] + inside
    g = range_hash(prefix_hash(body), at, at + LENGTH)
    a = table.column("a").to_numpy()[row]
    s = table.column("l").to_numpy().astype(np.int64)[row] + inside
    rank = _order(table)[row]
    by = np.lexsort((s, rank, g, a))
    a, g, row, s, rank = a[by], g[by], row[by], s[by], rank[by]
    dup = _later((a[1:] == a[:-1]) & (g[1:] == g[:-1]), rank, s)
    row, start, count = _runs(row[dup], s[dup], np.ones(int(dup.sum()), np.int64))
    ids, crc = table.column("doc_id").take(pa.array(row)), table.column("crc").take(pa.array(row))
    return pa.RecordBatch.from_arrays(
        [ids, crc, pa.array(start, pa.int32()), pa.array(count, pa.int32())], ["doc_id", "crc", "l", "n"])


@tidy
def compare(batches):
    """mapInArrow over rows sorted by trigger; a group may span batches."""
    held = None
    for batch in batches:
        if not len(batch):
            continue
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        a = batch.column("a").to_numpy()
        last = int(np.searchsorted(a, a[-1], "left"))
        if last:
            yield _compare(batch.slice(0, last))
        held = batch.slice(last)
    if held is not None:
        yield _compare(held)


def _keyed(docs: DataFrame) -> DataFrame:
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")) - (1 << 31)
    return docs.withColumn("crc", crc.cast("int"))


def duplicate_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, crc, ranges): starts whose LENGTH bytes occur earlier, as
    array of (l, n) runs of starts."""
    keyed = _keyed(docs).select("doc_id", "crc", "text")
    phrases = keyed.mapInArrow(parse_phrases, _PHRASES)
    marked = materialise(classify(phrases), "phrases")

    def listed(hot: bool) -> DataFrame:
        lists = (marked.filter(F.col("a").isNotNull() & (F.col("hot") == hot)).groupBy("doc_id", "crc")
                 .agg(F.collect_list(F.struct("l", "n", "a")).alias("phrases"))
                 .withColumnsRenamed({"doc_id": "_id", "crc": "_crc"}))
        on = keyed["doc_id"].eqNullSafe(lists["_id"]) & (keyed["crc"] == lists["_crc"])
        return keyed.join(lists, on).select("doc_id", "crc", "text", "phrases")

    order = Window.partitionBy("a", "g", "salt").orderBy(F.col("doc_id").asc_nulls_first(), "place")
    many = (listed(True).mapInArrow(
                suffixes, "a long, g long, salt int, doc_id long, place long, dup boolean")
            .withColumn("dup", F.col("dup") | _elsewhere(order)).filter("dup")
            .select("doc_id", F.shiftright("place", 32).cast("int").alias("crc"),
                    F.col("place").bitwiseAND(0xFFFFFFFF).cast("int").alias("l"), F.lit(1).alias("n")))
    few = (listed(False).mapInArrow(contexts, "a long, doc_id long, crc int, l int, bytes binary")
           .repartition("a").sortWithinPartitions("a")
           .mapInArrow(compare, "doc_id long, crc int, l int, n int"))
    return (marked.filter(F.col("a").isNull()).select("doc_id", "crc", "l", "n")
            .unionByName(many).unionByName(few)
            .groupBy("doc_id", "crc").agg(F.collect_list(F.struct("l", "n")).alias("ranges")))


def _spans(ranges, size: int) -> np.ndarray:
    """Maximal removed runs [start, end) of one text."""
    if ranges is None or not len(ranges):
        return np.zeros((0, 2), np.int64)
    l = ranges.field(0).to_numpy().astype(np.int64)
    n = ranges.field(1).to_numpy().astype(np.int64)
    _, start, length = _runs(np.zeros(len(l), np.int64), l, n - 1 + LENGTH)
    return np.stack([start, start + length], axis=1)


def _cut(batches, as_text: bool = False):
    """mapInArrow: add the removed spans and the kept bytes to each document."""
    for batch in batches:
        body, offsets = flat(batch.column("text"))
        ranges = batch.column("ranges")
        spans, kept = [], []
        for d in range(len(batch)):
            text = body[offsets[d]:offsets[d + 1]]
            at = _spans(ranges[d].values, len(text))
            spans.append([{"start": int(s), "end": int(e)} for s, e in at])
            stay = np.ones(len(text), bool)
            for s, e in at:
                stay[s:e] = False
            kept.append(text[stay].tobytes() if len(at) else text.tobytes())
        keep = [i for i, f in enumerate(batch.schema.names) if f not in ("ranges", "text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column(i) for i in keep]
            + [pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
               pa.array(np.diff(offsets), pa.int64()),
               pa.array([k.decode(errors="ignore") for k in kept], pa.string()) if as_text
               else pa.array(kept, pa.binary())],
            [batch.schema.names[i] for i in keep] + ["spans", "n_bytes", "kept"])


def remove_repeats(docs: DataFrame, as_text: bool = False) -> DataFrame:
    """``docs`` without its text but with ``spans`` (removed byte ranges),
    ``n_bytes`` and ``kept``: the remaining bytes, or as text (a code point
    that was cut in two goes with the cut). Columns of other names are kept."""
    return aside(docs, ("doc_id", "text"), {"crc", "_id", "_crc"}, lambda df: _without_repeats(df, as_text),
                 ("spans", "n_bytes", "kept"))


def _without_repeats(docs: DataFrame, as_text: bool) -> DataFrame:
    ranges = duplicate_ranges(docs).withColumnsRenamed({"doc_id": "_id", "crc": "_crc"})
    keyed = _keyed(docs)
    joined = keyed.join(ranges, keyed["doc_id"].eqNullSafe(ranges["_id"])
                        & (keyed["crc"] == ranges["_crc"]), "left").drop("_id", "_crc", "crc")
    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text")
    kind = "string" if as_text else "binary"
    return joined.mapInArrow(
        tidy(lambda batches: _cut(batches, as_text)),
        f"{rest}, spans array<struct<start:int,end:int>>, n_bytes long, kept {kind}")


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document: what repeats of an earlier LENGTH-byte string leave."""
    out = remove_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id", "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
