"""Operator 7 - byte-level BPE encoding and decoding, overlapping chunks.

A text longer than ``CHUNK`` code points is cut into chunks that overlap by
``OVERLAP``.  Every chunk is pre-tokenised on its own, from its first code
point, in parallel.  A pre-token depends only on the text after its start, so
once two neighbouring chunks have one boundary in common inside their overlap
they agree from there on: that boundary is where they are stitched.  (Only
boundaries after a code point that is no white space count: a run of white
space is split by what follows it.)  The text
is then cut at these boundaries into pieces, which are encoded in parallel, and
the ids of the pieces in order are the ids of the whole text.  If a pair of
chunks shares no boundary (one pre-token longer than the overlap), the last
stitched piece runs to the end of the text, which is exact as well.  Texts of
at most ``CHUNK`` code points are one chunk and one piece.

Decoding looks every id up in the vocabulary and concatenates raw bytes.

Defined results: null text is empty and has no ids; repeated rows and rows
sharing a doc_id are encoded one by one; an empty table gives no rows; other
columns of any name but ``ids`` and ``decoded`` are kept by ``encode`` and ``decode``.  The vocabulary is a file of
ranks (``path``), installed on every worker; it is read once per worker.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bytesview import slices, tidy
from tidemark.llm.common import aside, read

CHUNK = 32_768
OVERLAP = 2_048
#: code points at a chunk's end whose pre-tokens may change with what follows
EDGE = 4


def default_vocabulary() -> tuple[str, str]:
    """(path of the rank file, pre-token pattern)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _pattern(pattern: str):
    import regex
    return regex.compile(pattern)


def _decoded(enc, lists: pa.ListArray) -> pa.Array:
    return pa.array([enc.decode_bytes(x.values.to_numpy(zero_copy_only=False).tolist()) if x.is_valid else b""
                     for x in lists], pa.binary())


def _with_ids(df: DataFrame, column: str, path: str, pattern: str, back: bool = False) -> DataFrame:
    """``df`` with ``ids`` (array<int>) in place of the text ``column``; with
    ``back`` the ids are decoded in the same worker into ``decoded``."""
    @tidy
    def run(batches):
        enc = encoding(path, pattern)
        for batch in (part for whole in batches for part in slices(whole, column)):
            at = batch.schema.get_field_index(column)
            keep = [i for i in range(batch.num_columns) if i != at]
            ids = [enc.encode_to_numpy(t) if t else np.zeros(0, np.uint32)
                   for t in batch.column(at).to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            values = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in keep] + [lists] + ([_decoded(enc, lists)] if back else []),
                [batch.schema.names[i] for i in keep] + ["ids"] + (["decoded"] if back else []))

    rest = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != column]
    return df.mapInArrow(run, ", ".join(rest + ["ids array<int>"] + (["decoded binary"] if back else [])))


def _boundaries(chunks: DataFrame, pattern: str) -> DataFrame:
    """(_row, chunk, heads, tails): pre-token boundaries of each chunk inside
    its overlap with the chunk before and with the chunk after."""
    @tidy
    def run(batches):
        find = _pattern(pattern).finditer
        for batch in batches:
            heads, tails = [], []
            for no, text in zip(batch.column("chunk").to_pylist(), batch.column("body").to_pylist()):
                base = no * CHUNK
                ends = np.array([m.end() for m in find(text) if not m[0][-1].isspace()], np.int64)
                ends = ends[ends <= len(text) - EDGE]
                heads.append((ends[ends < OVERLAP] + base).tolist())
                tails.append((ends[ends >= CHUNK] + base).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("chunk"),
                 pa.array(heads, pa.list_(pa.int64())), pa.array(tails, pa.list_(pa.int64()))],
                ["_row", "chunk", "heads", "tails"])

    return chunks.mapInArrow(run, "_row long, chunk int, heads array<long>, tails array<long>")


def _cuts(bounds: DataFrame) -> DataFrame:
    """(_row, cuts): where the pieces of each text start.

    The stitch of chunk c is the first boundary that the tail of c-1 and the
    head of c have in common; cuts end at the first pair without one.
    """
    before = bounds.select("_row", (F.col("chunk") + 1).alias("chunk"), "tails")
    pairs = bounds.filter("chunk > 0").select("_row", "chunk", "heads").join(before, ["_row", "chunk"])
    stitched = pairs.select("_row", "chunk", F.array_min(F.array_intersect("heads", "tails")).alias("at"))
    lists = stitched.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("chunk", "at"))).alias("s"))
    lost = F.array_position(F.transform("s", lambda x: x["at"].isNull()), True)
    good = F.when(lost > 0, F.slice("s", F.lit(1), (lost - 1).cast("int"))).otherwise(F.col("s"))
    return lists.select("_row", F.concat(
        F.array(F.lit(0).cast("long")), F.transform(good, lambda x: x["at"])).alias("cuts"))


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None,
           text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with ``ids`` (array<int>) in place of its text; with ``back``
    also ``decoded`` (binary), the bytes that the ids stand for."""
    if path is None:
        path, pattern = default_vocabulary()
    return aside(docs, (text,), {"_row"}, lambda df: _encode(df, path, pattern, text, back),
                 ("ids", "decoded") if back else ("ids",))


def _encode(docs: DataFrame, path: str, pattern: str, text: str, back: bool) -> DataFrame:
    # the row number only has to be the same in both reads of one plan
    rows = docs.withColumn("_row", F.monotonically_increasing_id())
    body = F.col(text)
    long = F.coalesce(F.length(body) > CHUNK, F.lit(False))
    short = _with_ids(docs.filter(~long), text, path, pattern, back)

    whole = rows.filter(long)
    n = F.length(body)
    chunks = whole.select("_row", body.alias("t"), F.explode(F.sequence(
        F.lit(0), F.floor((n - 1) / CHUNK).cast("int"))).alias("chunk")).select(
        "_row", "chunk", F.substring("t", F.col("chunk") * CHUNK + 1, F.lit(CHUNK + OVERLAP)).alias("body"))
    cuts = _cuts(_boundaries(chunks.repartition("_row", "chunk"), pattern))
    cut = whole.select("_row", body.alias("t")).join(cuts, "_row")
    pieces = cut.select("_row", "t", F.posexplode(F.arrays_zip(
        F.col("cuts").alias("cuts"),
        F.concat(F.slice("cuts", 2, F.size("cuts")), F.array(F.length("t").cast("long"))).alias("ends")
    )).alias("piece", "z")).select("_row", "piece", F.substring(
        F.col("t"), (F.col("z.cuts") + 1).cast("int"), (F.col("z.ends") - F.col("z.cuts")).cast("int")).alias("t"))
    coded = _with_ids(pieces.repartition("_row", "piece"), "t", path, pattern)
    joined = coded.groupBy("_row").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("piece", "ids"))), lambda x: x["ids"])).alias("ids"))
    joined = whole.drop(text).join(joined, "_row").drop("_row")
    return short.unionByName(decode(joined, path, pattern) if back else joined)


def decode(df: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``df`` with ``decoded`` (binary): the raw bytes of ``ids`` in order."""
    if path is None:
        path, pattern = default_vocabulary()
    return aside(df, ("ids",), set(), lambda plain: _decode(plain, path, pattern), ("decoded",))


def _decode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    @tidy
    def run(batches):
        enc = encoding(path, pattern)
        for batch in (whole.slice(i, 256) for whole in batches for i in range(0, len(whole), 256)):
            yield pa.RecordBatch.from_arrays(
                batch.columns + [_decoded(enc, batch.column("ids"))], batch.schema.names + ["decoded"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    return df.mapInArrow(run, ", ".join(fields + ["decoded binary"]))


def digests(docs: DataFrame) -> DataFrame:
    out = encode(docs.select("doc_id", "text"), back=True)
    return out.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every whole text, as digests."""
    return digests(read(spark, sf_dir, "documents"))
