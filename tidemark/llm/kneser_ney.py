"""Operator 3 - quality classifier: interpolated modified Kneser-Ney model.

The model predicts UTF-8 bytes from the ``ORDER - 1`` bytes before.  Its counts come
from all trusted text (labels with quality 1 and toxic 0), and the n-grams it
holds grow with that text: none is dropped and none is broadcast.  Bytes leave
no unknown symbol in any language.

Training is Spark aggregates and joins on n-grams: counts by fold, continuation
counts of the lower orders, three discounts per order, the mass that each context
leaves to the order below, and a join per order for the interpolated probability.
There are ``FOLDS`` models, built in one pass with the model's number as a key;
model k has not seen the texts of fold k.  A text's fold is a hash of the text, so
every document, trusted or not, is scored by a model that has not seen it.

Scoring joins the distinct n-grams of all orders of a block of texts (about
``BLOCK`` bytes of one fold in one task) with the count shards: packed requests
meet the shard of their context, packed answers return to the block's texts.  A
shard's model is held in a task's memory, requests stream past it.
An n-gram's log probability is a sum over the orders: where order n has seen it,
log p_n - log p_(n-1), else the log of the mass its context leaves, 0 for unseen contexts.

A document's perplexity is per byte, its end included.  Per language, and per
length class of LENGTHS (short texts vary more), the threshold is the ``quantile``
of the trusted scores times ``margin``; documents above it are rejected.  The
quantile is shrunk, on the log scale, towards the one of all languages (relative to each
language's median) with the weight of ``PRIOR`` documents, by the same formula at
every size.  A language without trusted documents takes its own median of all documents.

Defined results: null text is an empty text; a null language is a language of
its own; repeated rows are scored row by row; without trusted text the model is
uniform and nothing is rejected; an empty table gives no rows; other columns, of
any name but those added, are kept by ``score`` and ``judge``.  The texts are read twice; a
table that comes in another order the second time stops the job.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.bytesview import flat, slices, tidy
from tidemark.llm.common import discard, materialise, read

ORDER = 5                       # bytes of an n-gram
EDGE = 0xFF                     # before and behind a text; no UTF-8 text holds this byte
TAG = 48                        # a key is the order above this bit and the bytes below it
SPREAD = 1_000_003              # contexts go to shards by their remainder
BLOCK = 1 << 24                 # bytes of text whose n-grams are asked for at once
FILTER_BITS = 1 << 22           # of the pre-filter for trusted documents
FOLDS = 5
PRIOR = 30
LENGTHS = (64, 128, 256, 512, 1024)


@dataclass(frozen=True)
class Cut:
    quantile: float = 0.99
    margin: float = 1.15


def _fold(text: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(FOLDS)).cast("int")


def _grams(body: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of every predicted byte (each text's end too) and the
    first one of each row."""
    n, before = len(offsets) - 1, ORDER - 1
    padded = np.full(len(body) + ORDER * n, EDGE, np.uint8)
    row = np.repeat(np.arange(n), np.diff(offsets))
    padded[np.arange(len(body)) + ORDER * row + before] = body
    size = len(padded) - before
    gram = np.zeros(size, np.int64)
    for k in range(ORDER):
        gram <<= 8
        gram |= padded[k:k + size]
    keep = np.ones(size, bool)
    following = offsets[1:-1] + ORDER * np.arange(1, n)
    for k in range(1, ORDER):
        keep[following - k] = False
    return gram[keep], offsets[:-1] + np.arange(n)


def _distinct(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of the texts and their counts."""
    keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for part in slices(pa.RecordBatch.from_arrays([texts], ["t"]), "t"):
        k, c = np.unique(_grams(*flat(part.column("t")))[0], return_counts=True)
        keys.append(k)
        counts.append(c)
    k, at = np.unique(np.concatenate(keys), return_inverse=True)
    return k, np.bincount(at, weights=np.concatenate(counts), minlength=len(k)).astype(np.int64)


@tidy
def _count(batches):
    """mapInArrow: n-gram counts of each batch by fold."""
    for batch in batches:
        folds = batch.column("fold").to_numpy()
        for fold in np.unique(folds):
            k, c = _distinct(batch.filter(pa.array(folds == fold)).column("text"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), fold, np.int32)), pa.array(k), pa.array(c)], ["fold", "gram", "c"])


def _filtered(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``ids``.

    A bit field of fixed size drops most others before the join moves any
    text; it may only let too many through, and the join is exact.
    """
    spark = docs.sparkSession
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).cast("int")
    bits = np.zeros(FILTER_BITS, bool)
    used = ids.select(slot.alias("slot")).distinct()
    for batch in used.toArrow().to_batches():   # at most FILTER_BITS numbers
        bits[batch.column(0).to_numpy()] = True
    field = spark.sparkContext.broadcast(np.packbits(bits).tobytes())

    @tidy
    def pick(batches):
        known = np.unpackbits(np.frombuffer(field.value, np.uint8)).astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(known[batch.column("_slot").to_numpy()])).drop_columns("_slot")

    rest = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    likely = docs.withColumn("_slot", slot).mapInArrow(pick, rest)
    return likely.join(ids.select("doc_id").distinct(), "doc_id", "left_semi")


def gram_counts(trusted: DataFrame) -> DataFrame:
    """(fold, gram, c) of trusted texts (fold, text)."""
    return trusted.select("fold", "text").mapInArrow(_count, "fold int, gram long, c long").groupBy(
        "fold", "gram").agg(F.sum("c").alias("c"))


def _by_model(counts: DataFrame, folds: int) -> DataFrame:
    """(fold, gram, c): the counts that model ``fold`` sees, those of the other folds."""
    whole = counts.groupBy("gram").agg(
        F.sum("c").alias("all"), F.map_from_entries(F.collect_list(F.struct("fold", "c"))).alias("own"))
    every = whole.select("gram", "all", "own", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold"))
    return every.select("fold", "gram", (F.col("all") - F.coalesce(
        F.col("own")[F.col("fold")], F.lit(0))).alias("c")).filter("c > 0")


def _discounted(grams: DataFrame) -> DataFrame:
    """(fold, ctx, gamma, kids) of one order: the mass a context leaves and, for every
    byte seen behind it (257 at most), the discounted probability ``alpha``."""
    n = {k: F.sum((F.col("c") == k).cast("long")) for k in (1, 2, 3, 4)}
    stats = grams.groupBy("fold").agg(*[n[k].alias(f"n{k}") for k in n])    # one row a fold
    y = F.when(F.col("n1") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.0)
    d = [F.least(F.greatest(F.when(F.col(f"n{k}") > 0, k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}"))
                            .otherwise(0.5 * k), F.lit(0.05)), F.lit(k - 0.05)).alias(f"d{k}") for k in (1, 2, 3)]
    by = F.broadcast(stats.select("fold", *d))
    less = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = grams.join(by, "fold").select(
        "fold", F.shiftright("gram", 8).alias("ctx"), F.col("gram").bitwiseAND(0xFF).cast("int").alias("b"), "c", less.alias("d"))
    contexts = rows.groupBy("fold", "ctx").agg(
        F.sum("c").alias("total"), F.sum("d").alias("left"), F.collect_list(F.struct("b", "c", "d")).alias("kids"))
    return contexts.select("fold", "ctx", (F.col("left") / F.col("total")).alias("gamma"), F.transform(
        "kids", lambda k: F.struct(k["b"].alias("b"), ((k["c"] - k["d"]) / F.col("total")).alias("alpha"))).alias("kids"))


def train(counts: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(fold, ctx, gamma, b, d): the finished models, one row a context, as a written table.

    ``ctx`` is tagged with its order; ``gamma`` is the log of the mass left; ``b`` lists
    the bytes seen, ``d`` the logs of p_n / p_(n-1).
    """
    order = materialise(_by_model(counts, folds), "grams")
    levels, tables = [order], [order]
    for n in range(ORDER - 1, 0, -1):   # in how many left contexts an n-gram occurs
        order = order.groupBy("fold", F.col("gram").bitwiseAND((1 << 8 * n) - 1).alias("gram")).agg(F.count("*").alias("c"))
        levels.append(order if n > 1 else materialise(order, "grams"))
    tables.append(levels[-1])
    below, out = None, None
    for n, grams in enumerate(reversed(levels), 1):
        flatten = _discounted(grams).select("fold", "ctx", "gamma", F.inline("kids")).withColumn(
            "gram", F.col("ctx") * 256 + F.col("b"))
        if below is None:
            flatten = flatten.withColumn("q", F.lit(1 / 256))
        else:
            flatten = flatten.withColumn("low", F.col("gram").bitwiseAND((1 << 8 * (n - 1)) - 1)).join(
                below.select("fold", F.col("gram").alias("low"), F.col("p").alias("q")), ["fold", "low"])
        level = materialise(flatten.select("fold", "ctx", "gamma", "b", "gram", "q", (
            F.col("alpha") + F.col("gamma") * F.col("q")).alias("p")), "level")
        below = level
        tables.append(level)
        rows = level.groupBy("fold", (F.col("ctx") + F.lit(n << TAG)).alias("ctx"), F.log("gamma").cast("float").alias("gamma")).agg(
            F.collect_list(F.struct("b", F.log(F.col("p") / F.col("q")).cast("float").alias("d"))).alias("k")).select(
            "fold", "ctx", "gamma", F.col("k.b").alias("b"), F.col("k.d").alias("d"))
        out = rows if out is None else out.unionByName(rows)
    model = materialise(out, "model")
    discard(*tables)
    return model


def _packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T)
    return zstandard.ZstdCompressor().compress(planes.tobytes())


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _keys(gram: np.ndarray) -> np.ndarray:
    """Distinct tagged n-grams of all orders in ``gram``, sorted."""
    out, part = [], gram
    for n in range(ORDER, 0, -1):
        part = np.unique(part & ((1 << 8 * n) - 1))
        out.append(part | (n << TAG))
    return np.concatenate(out[::-1])


def _context(key: np.ndarray) -> np.ndarray:
    return (key >> TAG << TAG) | ((key & ((1 << TAG) - 1)) >> 8)


def _blocks(batches):
    """(name, fold, texts) with about BLOCK bytes of one fold each."""
    held, size, number = {}, {}, 0

    def close(fold):
        texts = pa.Table.from_batches(held.pop(fold)).combine_chunks().to_batches()[0]
        size.pop(fold)
        body, ends = flat(texts.column("t"))
        name = hashlib.blake2b(bytes(memoryview(body)) + ends.tobytes(), digest_size=8).hexdigest()
        return f"{texts.column('place')[0]}-{number}-{name}", fold, texts

    for batch in (part for whole in batches for part in slices(whole, "t")):
        folds = batch.column("fold").to_numpy()
        for fold in np.unique(folds):
            mine = batch.filter(pa.array(folds == fold))
            held.setdefault(fold, []).append(mine)
            size[fold] = size.get(fold, 0) + (pc.sum(pc.binary_length(mine.column("t"))).as_py() or 0) + len(mine)
            if size[fold] >= BLOCK:
                yield close(fold)
                number += 1
    for fold in sorted(held):
        yield close(fold)
        number += 1


def _requests(docs: DataFrame, buckets: int) -> DataFrame:
    """(fold, bucket, block, keys): the distinct n-grams of every block by shard."""
    @tidy
    def run(batches):
        for name, fold, texts in _blocks(batches):
            keys = _keys(_distinct(texts.column("t"))[0])
            bucket = _context(keys) % SPREAD % buckets
            order = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
            used = np.flatnonzero(np.diff(ends))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), fold, np.int32)), pa.array(used.astype(np.int32)),
                 pa.array([name] * len(used), pa.string()),
                 pa.array([_packed(keys[order[ends[b]:ends[b + 1]]]) for b in used], pa.binary())],
                ["fold", "bucket", "block", "keys"])

    return docs.select("fold", "place", "t").mapInArrow(run, "fold int, bucket int, block string, keys binary")


def _texts(docs: DataFrame) -> DataFrame:
    """(block, rows, sizes, body): the texts of every block, packed; size -1 is null."""
    @tidy
    def run(batches):
        for name, _, texts in _blocks(batches):
            body, ends = flat(texts.column("t"))
            sizes = np.where(pc.is_null(texts.column("t")).to_numpy(zero_copy_only=False), -1, np.diff(ends))
            whole = pa.array([0, len(texts)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.string()), pa.ListArray.from_arrays(whole, texts.column("row")),
                 pa.ListArray.from_arrays(whole, pa.array(sizes.astype(np.int64))),
                 pa.array([zstandard.ZstdCompressor().compress(bytes(memoryview(body)))], pa.binary())],
                ["block", "rows", "sizes", "body"])

    return docs.mapInArrow(run, T.StructType([
        T.StructField("block", T.StringType()), T.StructField("rows", T.ArrayType(docs.schema["row"].dataType)),
        T.StructField("sizes", T.ArrayType(T.LongType())), T.StructField("body", T.BinaryType())]))


def _answers(requests: DataFrame, model: DataFrame, buckets: int) -> DataFrame:
    """(block, keys, logs): the summand of every requested n-gram.

    Requests and model are shuffled by (fold, shard); in a task the rows of
    a shard come first and are kept, the requests behind them stream by.
    """
    shard = F.pmod(F.pmod(F.col("ctx"), F.lit(SPREAD)), F.lit(buckets)).cast("int")
    both = model.select("fold", shard.alias("bucket"), "ctx", "gamma", "b", "d").unionByName(
        requests, allowMissingColumns=True)

    @tidy
    def run(batches):
        place, seen = None, []
        for batch in batches:
            at = batch.column("fold").to_numpy().astype(np.int64) * buckets + batch.column("bucket").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
            for start, stop in zip(cuts, cuts[1:]):
                if at[start] != place:
                    place, seen, table = at[start], [], None
                part = batch.slice(start, stop - start)
                known = part.filter(pc.is_valid(part.column("ctx")))
                asked = part.filter(pc.is_null(part.column("ctx")))
                if len(known):
                    seen.append(known.select(["ctx", "gamma", "b", "d"]))
                if not len(asked):
                    continue
                table = table or _table(seen)
                keys = [_unpacked(x.as_buffer(), np.int64) for x in asked.column("keys")]
                yield pa.RecordBatch.from_arrays(
                    [asked.column("block"), asked.column("keys"),
                     pa.array([_packed(_lookup(table, k)) for k in keys], pa.binary())], ["block", "keys", "logs"])

    return both.repartition(buckets, "fold", "bucket").sortWithinPartitions(
        "fold", "bucket", F.col("block").asc_nulls_first()).mapInArrow(run, "block string, keys binary, logs binary")


def _table(seen: list[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    """Sorted contexts with their gammas, sorted n-grams with their summands."""
    if not seen:
        return np.zeros(0, np.int64), np.zeros(0, np.float32), np.zeros(0, np.int64), np.zeros(0, np.float32)
    rows = pa.Table.from_batches(seen).combine_chunks().to_batches()[0]
    ctx, gamma = rows.column("ctx").to_numpy(), rows.column("gamma").to_numpy()
    parent = np.repeat(ctx, pc.list_value_length(rows.column("b")).to_numpy())
    tag, low = parent >> TAG << TAG, parent & ((1 << TAG) - 1)
    key = tag | (low << 8) | rows.column("b").flatten().to_numpy()
    by, order = np.argsort(ctx), np.argsort(key)
    return ctx[by], gamma[by], key[order], rows.column("d").flatten().to_numpy()[order]


def _found(where: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(where, keys), max(len(where) - 1, 0))
    return at, (where[at] == keys) if len(where) else np.zeros(len(keys), bool)


def _lookup(table: tuple[np.ndarray, ...], keys: np.ndarray) -> np.ndarray:
    ctx, gamma, grams, d = table
    out = np.zeros(len(keys), np.float32)
    for where, value, wanted in ((ctx, gamma, _context(keys)), (grams, d, keys)):
        at, hit = _found(where, wanted)
        out[hit] = value[at[hit]]
    return out


def score(docs: DataFrame, model: DataFrame, keep_text: bool = False, folds: int = FOLDS) -> DataFrame:
    """``docs`` with ``n_bytes`` and ``perplexity``, without its text unless asked."""
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in docs.columns if c not in ("text", "n_bytes", "perplexity")]
    packed = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in rest]).alias("row"),
                         F.col("text").alias("t"), F.pmod(_fold(F.col("text")), F.lit(folds)).alias("fold"),
                         F.spark_partition_id().alias("place"))     # of the scan, also inside a union
    answers = _answers(_requests(packed, buckets), model, buckets)
    rows = _texts(packed)

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        if len(texts) != 1 or not len(found):
            raise RuntimeError("the input came in another order when it was read again; write it as a table first")
        keys = np.concatenate([_unpacked(x, np.int64) for x in found["keys"].to_pylist()])
        logs = np.concatenate([_unpacked(x, np.float32) for x in found["logs"].to_pylist()])
        order = np.argsort(keys)
        keys, logs = keys[order], logs[order].astype(np.float64)
        top = keys[np.searchsorted(keys, ORDER << TAG):] & ((1 << TAG) - 1)
        total = np.full(len(top), -np.log(256.0))
        for n in range(1, ORDER + 1):
            total += logs[np.searchsorted(keys, (top & ((1 << 8 * n) - 1)) | (n << TAG))]
        sizes = texts["sizes"].combine_chunks().flatten().to_numpy()
        raw = zstandard.ZstdDecompressor().decompress(texts["body"][0].as_py())
        ends = np.concatenate([[0], np.cumsum(np.maximum(sizes, 0))])
        column = pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(raw))
        column = pc.if_else(pa.array(sizes >= 0), column.cast(pa.string()), pa.scalar(None, pa.string()))
        result = []
        for part in slices(pa.RecordBatch.from_arrays([column], ["t"]), "t"):
            gram, first = _grams(*flat(part.column("t")))
            result.append(np.add.reduceat(total[np.searchsorted(top, gram)], first))
        n = np.maximum(sizes, 0)
        out = [texts["rows"].combine_chunks().flatten(), pa.array(n), pa.array(np.exp(-np.concatenate(result) / (n + 1)))]
        return pa.table(out + [column] * keep_text, ["row", "n_bytes", "perplexity"] + ["text"] * keep_text)

    fields = [T.StructField("row", packed.schema["row"].dataType), T.StructField("n_bytes", T.LongType()),
              T.StructField("perplexity", T.DoubleType())] + [T.StructField("text", T.StringType())] * keep_text
    out = rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, T.StructType(fields))
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in rest], *["text"] * keep_text, "n_bytes", "perplexity")


def _length_class(n: Column) -> Column:
    out = F.lit(0)
    for k, edge in enumerate(LENGTHS, 1):
        out = F.when(n >= edge, k).otherwise(out)
    return out


def _shrunk(n: Column, own: Column, general: Column) -> Column:
    """Weighted mean, on the log scale, of an own figure of n documents and a general one."""
    n = F.coalesce(n, F.lit(0))
    return F.exp((n * F.log(F.coalesce(own, general)) + PRIOR * F.log(general)) / (n + PRIOR))


def thresholds(scored: DataFrame, cut: Cut = Cut()) -> DataFrame:
    """(lang, limits): the threshold of every language by length class, from
    (lang, n_bytes, perplexity, trusted) of all documents."""
    top = lambda c: F.percentile_approx(c, cut.quantile, 10_000)
    middle = lambda c: F.percentile_approx(c, 0.5, 10_000)
    mine = F.when(F.col("trusted"), F.col("perplexity"))
    medians = scored.groupBy("lang").agg(F.coalesce(middle(mine), middle("perplexity")).alias("median"))
    held = scored.filter("trusted").select("lang", "perplexity", _length_class(F.col("n_bytes")).alias("size"))
    by = medians.select(F.col("lang").alias("_lang"), "median")
    ratio = held.join(by, held["lang"].eqNullSafe(by["_lang"])).select(
        "size", "lang", (F.col("perplexity") / F.col("median")).alias("r"))
    every = F.explode(F.sequence(F.lit(0), F.lit(len(LENGTHS)))).alias("size")
    sizes = ratio.groupBy("size").agg(F.count("*").alias("n"), top("r").alias("r"))       # one row a class
    whole = ratio.groupBy().agg(top("r").alias("all")).select(every, "all")               # one row a class
    general = whole.join(sizes, "size", "left").select(
        "size", _shrunk(F.col("n"), F.col("r"), F.col("all")).alias("general"))
    own = ratio.groupBy(F.col("lang").alias("_lang"), F.col("size").alias("_size")).agg(
        F.count("*").alias("n"), top("r").alias("r"))
    grid = medians.select("lang", "median", every).join(F.broadcast(general), "size").join(
        own, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("size") == F.col("_size")), "left")
    limit = F.col("median") * _shrunk(F.col("n"), F.col("r"), F.col("general")) * cut.margin
    return grid.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("size", limit.alias("limit")))).alias("limits"))


def _trusted(labels: DataFrame) -> DataFrame:
    return labels.filter("quality = 1 and toxic = 0 and doc_id is not null").select("doc_id").distinct()


def fit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The models of the trusted documents among ``docs``, see ``train``."""
    texts = _filtered(docs.select("doc_id", "text"), _trusted(labels)).select(_fold(F.col("text")).alias("fold"), "text")
    counts = materialise(gram_counts(texts), "counts")
    model = train(counts)
    discard(counts)
    return model


def judge(scored: DataFrame, labels: DataFrame, cut: Cut = Cut()) -> DataFrame:
    """``scored`` (a written table) with ``threshold`` (null: none) and ``kept``."""
    ids = _trusted(labels).select(F.col("doc_id").alias("_id"), F.lit(True).alias("_yes"))
    known = scored.select("doc_id", "lang", "n_bytes", "perplexity").join(ids, F.col("doc_id") == F.col("_id"), "left")
    limits = materialise(thresholds(known.select(
        "lang", "n_bytes", "perplexity", F.coalesce("_yes", F.lit(False)).alias("trusted")), cut), "limits")
    limits = limits.withColumnRenamed("lang", "_lang")
    rows = scored.select(F.struct("*").alias("s")).join(limits, F.col("s.lang").eqNullSafe(F.col("_lang")), "left")
    limit = F.col("limits")[_length_class(F.col("s.n_bytes"))]
    rest = [F.col(f"s.`{c}`").alias(c) for c in scored.columns if c not in ("threshold", "kept")]
    return rows.select(*rest, limit.alias("threshold"),
                       (~F.coalesce(F.col("s.perplexity") > limit, F.lit(False))).alias("kept"))


def op3_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Perplexity and verdict of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    labels = read(spark, sf_dir, "labels")
    model = fit(docs, labels)
    scored = materialise(score(docs, model), "scores")
    discard(model)
    return judge(scored, labels).select("doc_id", "lang", "n_bytes", "perplexity", "threshold", "kept")
