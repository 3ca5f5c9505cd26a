"""Operator 13 - SentencePiece encoding and decoding, distinct-chunk table.

The model puts the marker U+2581 before a text and in place of every space.  No
piece holds a marker behind another character (``check_model`` proves it for the
given model), so nothing is merged across the start of a *marked word*: a run of
markers and the characters up to the next marker.  The ids of a text are the
ids of its marked words in order.

1. *Cut.*  About ``BLOCK`` bytes of texts make a block, one row.  Its distinct words
   get numbers; each text becomes the sequence of its word numbers (compressed).
2. *Segment.*  The distinct words of every block go to the task of their hash
   bucket, which looks each distinct word up in its table and segments it when
   it is new (a table above ``TABLE`` words starts anew, so memory is bounded).
3. *Join.*  The ids come back to their block and are joined to the texts by
   position.  Texts are shuffled as word numbers, never as rows per word.

A word that holds a third of all positions is sent once per block; a block has
a bounded number of texts, so no group grows with the input.  Blocks are named
by place and content: were an input to come in another order the second time it
is read, its blocks would find no ids and the job would stop, not go wrong.

Decoding: ``decode`` is the library's, for any list of ids; ``encode(back=True)``
decodes each distinct word of a block once and joins the texts by position.

Defined results: null and empty texts have no ids and decode to the empty text;
repeated rows and rows sharing a doc_id are encoded one by one; an empty table
gives no rows; other columns are kept, whatever their names (a column named
``ids`` or ``decoded`` is replaced).  A text of any length is one block at least.
The model is a file (``path``) installed on every worker.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bytesview import flat, prefix_hash, range_hash, slices, tidy
from tidemark.llm.common import read

MARK = "▁"
BLOCK = 1 << 23
TABLE = 1 << 19


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=8)
def check_model(path: str) -> None:
    """Raise unless marked words can be segmented one by one."""
    from sentencepiece import sentencepiece_model_pb2
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    rules = model.normalizer_spec
    crossing = [p.piece for p in model.pieces if MARK in p.piece.lstrip(MARK)]
    if crossing:
        raise ValueError(f"pieces cross a white-space marker: {crossing[:3]}")
    if model.trainer_spec.model_type != 2:
        raise ValueError("not a BPE model")
    if (rules.precompiled_charsmap or rules.remove_extra_whitespaces or not rules.add_dummy_prefix
            or not rules.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix):
        raise ValueError("the model changes texts before it segments them")


def cut_words(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(words per text, words): the marked words in order, without their first
    marker and with spaces for the others."""
    body, ends = flat(pc.replace_substring(text, MARK, " "))
    space = body == 0x20
    follows = np.zeros(len(body), bool)
    follows[1:] = ~space[:-1]
    follows[ends[:-1][ends[:-1] < len(body)]] = False
    cuts = np.flatnonzero(space & follows)          # the first marker of every further word
    firsts = ends[:-1][np.diff(ends) > 0]
    starts = np.insert(cuts + 1, np.searchsorted(cuts, firsts), firsts)
    starts = starts - np.searchsorted(cuts, starts)  # the cut bytes go
    counts = np.diff(np.searchsorted(cuts, ends)) + (np.diff(ends) > 0)
    left = np.delete(body, cuts)
    offsets = np.append(starts, len(left)).astype(np.int32)
    return counts, pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(left))


def _numbered(text: pa.Array, buckets: int, place: str):
    """(name, words per text, numbers, distinct words, first number of each bucket)."""
    counts, words = cut_words(text)
    coded = words.dictionary_encode()
    table, codes = coded.dictionary, coded.indices.to_numpy()
    body, ends = flat(table)
    bucket = (range_hash(prefix_hash(body), ends[:-1], ends[1:]) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    kind = "<u2" if len(order) <= 1 << 16 else "<u4"
    numbers = number[codes].astype(kind)
    table = table.take(pa.array(order))
    name = hashlib.blake2b(b"".join(bytes(memoryview(x)) for x in (*flat(table), counts, numbers)), digest_size=8)
    return f"{place}-{name.hexdigest()}", counts, numbers, table, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _packed(*parts) -> bytes:
    return zstandard.ZstdCompressor().compress(b"".join(bytes(memoryview(p)) for p in parts))


def _unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


def _blocks(batches, size: int, buckets: int):
    number, place = 0, TaskContext.get().partitionId()
    for batch in (part for whole in batches for part in slices(whole, "t", size)):
        yield batch, _numbered(batch.column("t"), buckets, f"{place}-{number}")
        number += 1


def _words(docs: DataFrame, buckets: int, size: int) -> DataFrame:
    """(block, bucket, words): the distinct words of every block, by bucket,
    joined by markers."""
    @tidy
    def run(batches):
        for _, (name, _, _, table, first) in _blocks(batches, size, buckets):
            used = np.flatnonzero(np.diff(first))
            ends = np.append(first[used], len(table)).astype(np.int32)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), table), MARK)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)),
                 pa.array([_packed(x.as_buffer()) for x in joined], pa.binary())], ["block", "bucket", "words"])

    return docs.mapInArrow(run, "block string, bucket int, words binary")


def _numbers(docs: DataFrame, buckets: int, size: int) -> DataFrame:
    """(block, rows, counts, numbers, width): the texts of every block as the
    numbers of their words."""
    @tidy
    def run(batches):
        for batch, (name, counts, numbers, _, _) in _blocks(batches, size, buckets):
            whole = pa.array([0, len(batch)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.ListArray.from_arrays(whole, batch.column("row")),
                 pa.ListArray.from_arrays(whole, pa.array(counts.astype(np.int64))),
                 pa.array([_packed(numbers)], pa.binary()), pa.array([numbers.itemsize], pa.int32())],
                ["block", "rows", "counts", "numbers", "width"])

    return docs.mapInArrow(run, T.StructType([
        T.StructField("block", T.StringType()), T.StructField("rows", T.ArrayType(docs.schema["row"].dataType)),
        T.StructField("counts", T.ArrayType(T.LongType())),
        T.StructField("numbers", T.BinaryType()), T.StructField("width", T.IntegerType())]))


def _gather(values: np.ndarray, length: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, ends) of the lists ``picks``; list i has ``length[i]`` values."""
    first = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    size = length[picks].astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size)])
    return values[np.repeat(first[picks] - ends[:-1], size) + np.arange(ends[-1])], ends


class WordTable:
    """Ids of distinct words, each segmented once; starts anew above ``size``."""

    def __init__(self, path: str, size: int):
        self.sp, self.size = processor(path), size
        self.number: dict[str, int] = {}
        self.ids: list[list[int]] = []

    def lookup(self, words: list[str]) -> list[list[int]]:
        new = [w for w in words if w not in self.number]
        if len(self.ids) + len(new) > self.size:
            self.number, self.ids, new = {}, [], words
        self.number.update(zip(new, range(len(self.ids), len(self.ids) + len(new))))
        self.ids += self.sp.encode(new, num_threads=1)
        if "" in self.number:           # a marker with nothing behind it
            self.ids[self.number[""]] = [self.sp.piece_to_id(MARK)]
        return [self.ids[self.number[w]] for w in words]


def segment(words: DataFrame, path: str, table_size: int = TABLE) -> DataFrame:
    """(block, bucket, n, ids): the ids of the words of each row: ``n`` lengths,
    then the ids, four bytes each."""
    @tidy
    def run(batches):
        table = WordTable(path, table_size)
        for batch in (whole.slice(i, 32) for whole in batches for i in range(0, len(whole), 32)):
            lists = pc.split_pattern(pa.array([_unpacked(x.as_buffer()) for x in batch.column("words")],
                                              pa.binary()).cast(pa.string()), MARK)
            coded = lists.flatten().dictionary_encode()
            ids = table.lookup(coded.dictionary.to_pylist())
            length = np.array([len(x) for x in ids], np.int32)
            values = np.fromiter(chain.from_iterable(ids), np.int32, int(length.sum()))
            picks, n = coded.indices.to_numpy(), pc.list_value_length(lists).to_numpy()
            found, ends = _gather(values, length, picks)
            at = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("bucket"), pa.array(n.astype(np.int32)),
                 pa.array([_packed(length[picks[a:b]], found[ends[a]:ends[b]]) for a, b in zip(at, at[1:])], pa.binary())],
                ["block", "bucket", "n", "ids"])

    return words.mapInArrow(run, "block string, bucket int, n int, ids binary")


def _joined(rows: DataFrame, ids: DataFrame, path: str, back: bool) -> DataFrame:
    """(row, ids[, decoded]): the ids of the words of each block at their positions."""
    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        found = found.sort_by("bucket")
        if len(texts) != 1 or not len(found):
            raise RuntimeError("the input came in another order when it was read again; write it as a table first")
        parts = [np.split(np.frombuffer(_unpacked(x), np.int32), [n])
                 for x, n in zip(found["ids"].to_pylist(), found["n"].to_pylist())]
        length, values = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        numbers = np.frombuffer(_unpacked(texts["numbers"][0].as_py()), f"<u{texts['width'][0].as_py()}")
        numbers = numbers.astype(np.int64)
        picked, at = _gather(values, length, numbers)
        ends = np.concatenate([[0], np.cumsum(texts["counts"].combine_chunks().flatten().to_numpy())])
        out = [texts["rows"].combine_chunks().flatten(),
               pa.ListArray.from_arrays(pa.array(at[ends].astype(np.int32)), pa.array(picked))]
        if back:
            first = np.cumsum(length)[:-1]
            plain = pa.array(processor(path).decode([x.tolist() for x in np.split(values, first)]), pa.string())
            words = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), plain.take(pa.array(numbers)))
            out.append(pc.binary_join(words, " "))
        return pa.table(out, ["row", "ids"] + ["decoded"] * back)

    fields = [T.StructField("row", rows.schema["rows"].dataType.elementType),
              T.StructField("ids", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField("decoded", T.StringType())] * back
    return rows.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(run, T.StructType(fields))


def encode(docs: DataFrame, path: str | None = None, text: str = "text", back: bool = False,
           size: int = BLOCK) -> DataFrame:
    """``docs`` with ``ids`` (array<int>) in place of its text; with ``back``
    also ``decoded``, the text that the ids stand for."""
    path = path or default_model()
    check_model(path)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in docs.columns if c not in {text, "ids"} | ({"decoded"} if back else set())]
    packed = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("row"),
                         F.col(f"`{text}`").alias("t"))
    empty = F.coalesce(F.length("t") == 0, F.lit(True))
    full = packed.filter(~empty)
    ids = segment(_words(full, buckets, size).repartition(buckets, "bucket"), path)
    out = _joined(_numbers(full, buckets, size), ids, path, back)
    none = packed.filter(empty).select("row", F.array().cast("array<int>").alias("ids"),
                                       *[F.lit("").alias("decoded")] * back)
    return out.unionByName(none).select(*[F.col(f"row.`{c}`").alias(c) for c in rest], "ids", *["decoded"] * back)


def decode(df: DataFrame, path: str | None = None) -> DataFrame:
    """``df`` with ``decoded``: the text of ``ids`` (null: the empty text)."""
    path = path or default_model()

    @tidy
    def run(batches):
        sp = processor(path)
        for batch in (whole.slice(i, 256) for whole in batches for i in range(0, len(whole), 256)):
            texts = [sp.decode(x) if x else "" for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(batch.columns + [pa.array(texts, pa.string())],
                                             batch.schema.names + ["decoded"])

    df = df.drop("decoded")
    return df.mapInArrow(run, T.StructType([*df.schema, T.StructField("decoded", T.StringType())]))


def digests(docs: DataFrame) -> DataFrame:
    out = encode(docs.select("doc_id", "text"), back=True)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_sentence_pieces(spark, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every whole text, as digests."""
    return digests(read(spark, sf_dir, "documents"))
