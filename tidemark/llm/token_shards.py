"""Operator 4 - training-order materialisation of token ids.

Every document becomes its ids and one end id, cut into sequences of
``LENGTH`` ids (the last one padded).  The sequences are numbered 0 .. S-1 in
table order: a running number inside each input partition plus the sequences of
the partitions before (one number a partition, as zipWithIndex does).  A keyed
Feistel network permutes these numbers; a value outside 0 .. S-1 is permuted
again until it falls inside (cycle-walking), so the slots are a bijection of the
numbers and need neither a sort nor a table.  Slots are the training order.
Ranges of ``SHARD`` slots are written as one file each, of fixed-size records:

    record = doc_id int64, seq int32, count int32, LENGTH ids uint16

so slot s is at byte (s mod SHARD) * RECORD of file s div SHARD, and a reader
stopped after slot s goes on at s + 1 (``read_slots``).  A file is written under
a name of its own and then moved to its place, so a lost or repeated task
leaves whole files only.

Ids are needed twice (to count and to write) and are kept in executor memory
meanwhile; partitions that do not fit or are lost are encoded again.  (Stored in
the shared folder they would pass the disk budget next to shuffle and files.)  A
word with the spaces before it is encoded once per slice of texts (``_encoded``).
Every shard is one partition of the shuffle, by its number, and every file is
checked to hold its slots without a gap: rows that came in another order the
second time could not go unnoticed.

Defined results: null text is empty: one sequence with the end id alone;
repeated rows and rows sharing a doc_id are documents of their own; a null
doc_id is written as -1; an empty table writes no file; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import default_vocabulary, encoding
from tidemark.llm.bytesview import MIX, flat, mix, slices, tidy
from tidemark.llm.common import materialise, read, shared_path

LENGTH = 256
SLICE = 1 << 23            # bytes of text encoded at once
SHARD = 16_384
END = 50_256
ROUNDS = 6
HEAD = np.dtype([("doc_id", "<i8"), ("seq", "<i4"), ("count", "<i4"), ("ids", "<u2", (LENGTH,))])
RECORD = HEAD.itemsize


def permute(number: np.ndarray, size: int, key: int) -> np.ndarray:
    """The slot of every number: a keyed bijection of 0 .. size-1."""
    half = max(1, ((max(size - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    value = number.astype(np.uint64)
    todo = np.arange(len(value))
    while len(todo):
        left, right = value[todo] >> np.uint64(half), value[todo] & mask
        for r in range(ROUNDS):
            secret = np.uint64((key * MIX[0] + r * MIX[1]) & ((1 << 64) - 1))
            left, right = right, left ^ (mix(right ^ secret) & mask)
        value[todo] = (left << np.uint64(half)) | right
        todo = todo[value[todo] >= np.uint64(size)]
    return value.astype(np.int64)


def _chunks(text: pa.Array, pattern: str) -> tuple[np.ndarray, pa.Array]:
    """(chunks per text, chunks): texts cut before every space behind a printable
    ASCII character.  The public pattern never matches across such a place, and
    what it matches behind it does not depend on the text before; for any other
    pattern a text is one chunk."""
    body, ends = flat(text)
    firsts = ends[:-1][np.diff(ends) > 0]
    cuts = np.zeros(0, np.int64)
    if pattern == default_vocabulary()[1]:
        here = (body[1:] == 0x20) & (body[:-1] > 0x20) & (body[:-1] < 0x7F)
        cuts = np.flatnonzero(here) + 1
        cuts = cuts[~np.isin(cuts, firsts)]
    starts = np.insert(cuts, np.searchsorted(cuts, firsts), firsts)
    counts = np.diff(np.searchsorted(starts, ends))
    offsets = np.append(starts, len(body)).astype(np.int32)
    return counts, pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(body))


@lru_cache(maxsize=2)
def _token_bytes(path: str, pattern: str) -> np.ndarray:
    enc = encoding(path, pattern)
    return np.array([len(enc.decode_single_token_bytes(i)) for i in range(enc.max_token_value + 1)], np.int64)


def _distinct_ids(chunks: pa.Array, vocabulary: tuple[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, how many each chunk has) of distinct chunks, in order.

    Chunks that begin with a space and end in a printable ASCII character may
    follow each other in one text and are cut apart again by the bytes of their
    ids; the few others are encoded one by one."""
    enc, width = encoding(*vocabulary), _token_bytes(*vocabulary)
    body, ends = flat(chunks)
    begin, end = body[ends[:-1]], body[ends[1:] - 1]
    together = (begin == 0x20) & (end > 0x20) & (end < 0x7F)
    order = np.concatenate([np.flatnonzero(together), np.flatnonzero(~together)])
    joined = "".join(chunks.filter(pa.array(together)).to_pylist())
    ids = np.asarray(enc.encode_to_numpy(joined) if joined else [], np.int64)
    size = np.diff(ends)[together]
    tokens = np.diff(np.searchsorted(np.cumsum(width[ids]), np.concatenate([[0], np.cumsum(size)]), "right"))
    rest = [enc.encode_ordinary(c) for c in chunks.filter(pa.array(~together)).to_pylist()]
    ids = np.concatenate([ids, np.fromiter(chain.from_iterable(rest), np.int64)])
    length = np.concatenate([tokens, [len(x) for x in rest]]).astype(np.int64)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return _picked(ids.astype(np.uint16), length, place)[0], length[place]


def _picked(values: np.ndarray, length: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, ends) of the lists ``picks``; list i has ``length[i]`` values."""
    first = np.cumsum(length) - length
    size = length[picks]
    at = np.concatenate([[0], np.cumsum(size)])
    return values[np.repeat(first[picks] - at[:-1], size) + np.arange(at[-1])], at


def _encoded(text: pa.Array, vocabulary: tuple[str, str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts in order, each text's closed by ``END``; where each text
    begins and the last one ends).  Equal chunks are encoded once."""
    counts, chunks = _chunks(text, vocabulary[1])
    if not len(chunks):
        return np.full(len(text), END, "<u2"), np.arange(len(text) + 1)
    coded = chunks.dictionary_encode()
    if vocabulary[1] == default_vocabulary()[1]:
        values, length = _distinct_ids(coded.dictionary, vocabulary)
    else:
        known = [encoding(*vocabulary).encode_ordinary(c) for c in coded.dictionary.to_pylist()]
        length = np.array([len(x) for x in known], np.int64)
        values = np.fromiter(chain.from_iterable(known), np.uint16, int(length.sum()))
    ids, at = _picked(values, length, coded.indices.to_numpy())
    ends = at[np.concatenate([[0], np.cumsum(counts)])]
    return np.insert(ids, ends[1:], END).astype("<u2"), ends + np.arange(len(ends))


def _per_text(ends: np.ndarray) -> np.ndarray:
    return -(-np.diff(ends) // LENGTH)


def sequences(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, seq, ids binary): uint16 ids, one row per sequence."""
    @tidy
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE):
                ids, ends = _encoded(batch.column("text"), (path, pattern))
                n = _per_text(ends)
                rows = np.repeat(np.arange(len(n)), n)
                seq = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
                start = np.append(ends[rows] + seq * LENGTH, len(ids)) * 2
                parts = pa.BinaryArray.from_buffers(
                    pa.binary(), len(rows), [None, pa.py_buffer(start.astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(rows)), pa.array(seq.astype(np.int32)), parts],
                    ["doc_id", "seq", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, seq int, ids binary")


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` with ``number`` 0 .. S-1, and S."""
    rows = rows.withColumn("part", F.shiftright("_id", 33))
    counts = rows.groupBy("part").agg(F.count("*").alias("n")).toPandas().sort_values("part")  # one row a partition
    total = int(counts.n.sum())
    counts["base"] = counts.n.cumsum() - counts.n
    base = rows.sparkSession.createDataFrame(counts[["part", "base"]], "part long, base long")
    inside = F.col("_id").bitwiseAND((1 << 33) - 1)
    return rows.join(F.broadcast(base), "part").withColumn(
        "number", F.col("base") + inside).drop("part", "base", "_id"), total


@dataclass(frozen=True)
class Shards:
    """A written set of shards."""
    path: str
    total: int
    slots: int = SHARD      # of each file

    def name(self, shard: int) -> str:
        return f"{self.path}/shard-{shard:08d}.bin"


def _files(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_shards(docs: DataFrame, path: str, key: int = 1, vocabulary: tuple[str, str] | None = None,
                 slots: int = SHARD) -> tuple[Shards, DataFrame]:
    """Write ``docs`` in training order; (shards, (shard, records) per file)."""
    vocabulary = vocabulary or default_vocabulary()
    rows = sequences(docs, *vocabulary).withColumn("_id", F.monotonically_increasing_id())
    rows = rows.persist(StorageLevel.MEMORY_ONLY)
    numbered, total = _numbered(rows)
    target = Shards(path.rstrip("/"), total, slots)

    @F.pandas_udf("long")
    def slot(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), total, key))

    @tidy
    def write(batches):
        import uuid
        rows = list(batches)           # one shard
        if rows:
            yield _write(target, pa.Table.from_batches(rows), uuid.uuid4().hex)

    placed = (numbered.withColumn("slot", slot("number")).withColumn("shard", F.floor(F.col("slot") / slots))
              .select("shard", "slot", F.coalesce("doc_id", F.lit(-1)).alias("doc_id"), "seq", "ids"))
    shards = max(1, -(-total // slots))
    ranged = placed.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("slot")
    written = materialise(ranged.mapInArrow(write, "shard long, records long"), "manifest")
    rows.unpersist()
    return target, written


def _write(target: Shards, table: pa.Table, attempt: str) -> pa.RecordBatch:
    shard = table.column("shard")[0].as_py()
    records = np.zeros(len(table), HEAD)
    records["doc_id"] = table.column("doc_id").to_numpy()
    records["seq"] = table.column("seq").to_numpy()
    records["ids"] = END
    slot = table.column("slot").to_numpy()
    expected = min(target.slots, target.total - shard * target.slots)
    if not np.array_equal(slot, shard * target.slots + np.arange(expected)):
        raise RuntimeError("the input came in another order when it was read again; write it as a table first")
    count = pc.binary_length(table.column("ids")).to_numpy() // 2
    records["count"] = count
    body, _ = flat(table.column("ids").combine_chunks())
    row = np.repeat(np.arange(len(count)), count)
    records["ids"][row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)] = body.view("<u2")
    files, name = _files(target.name(shard))
    files.create_dir(name.rpartition("/")[0], recursive=True)
    with files.open_output_stream(f"{name}.{attempt}") as out:
        out.write(records.tobytes())
    files.move(f"{name}.{attempt}", name)
    return pa.RecordBatch.from_arrays([pa.array([shard]), pa.array([len(records)])], ["shard", "records"])


def read_slots(target: Shards, start: int = 0, count: int | None = None) -> np.ndarray:
    """Records from slot ``start`` on, sequentially, at most ``count`` of them
    and at most to the end of the file."""
    files, name = _files(target.name(start // target.slots))
    with files.open_input_file(name) as f:
        f.seek(start % target.slots * RECORD)
        data = f.read() if count is None else f.read(count * RECORD)
    return np.frombuffer(data, HEAD)


def read_back(spark: SparkSession, target: Shards, written: DataFrame) -> DataFrame:
    """One row per record of the files: (doc_id, seq, slot, shard, place,
    n_tokens, ids_crc32), read file by file in parallel."""
    @tidy
    def run(batches):
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                for part in range(0, target.slots, 2048):
                    got = read_slots(target, shard * target.slots + part, 2048)
                    if not len(got):
                        break
                    body = np.ascontiguousarray(got["ids"]).tobytes()
                    crc = [zlib.crc32(body[2 * LENGTH * i:2 * LENGTH * i + 2 * n])
                           for i, n in enumerate(got["count"].tolist())]
                    slot = shard * target.slots + part + np.arange(len(got))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(got["doc_id"]), pa.array(got["seq"]), pa.array(slot),
                        pa.array(np.full(len(got), shard)), pa.array(slot % target.slots * RECORD),
                        pa.array(got["count"].astype(np.int64)), pa.array(crc, pa.int64())],
                        ["doc_id", "seq", "slot", "shard", "place", "n_tokens", "ids_crc32"])

    files = max(1, -(-target.total // target.slots))
    return written.select("shard").repartitionById(files, F.col("shard").cast("int")).mapInArrow(
        run, "doc_id long, seq int, slot long, shard long, place long, n_tokens long, ids_crc32 long")


def op4_token_shards(spark, sf_dir: str) -> DataFrame:
    """Every sequence of every document, as read back from its shard."""
    docs = read(spark, sf_dir, "documents")
    target, written = write_shards(docs, shared_path(spark, "token-shards"))
    return read_back(spark, target, written)
