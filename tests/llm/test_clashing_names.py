"""Public functions keep columns named like those that they use inside, and
columns whose names SQL would have to quote."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, kneser_ney, suffix_dedup

INSIDE = ["_row", "_id", "_crc", "crc", "term", "place", "row", "fold", "block", "piece", "a b", "c.d", "_rest"]
TEXTS = ["one two three four five six seven eight nine ten", None, "", "x " * 200, "x " * 200]


@pytest.fixture
def docs(llm):
    rows = [(i, t, "en", *[f"{c}{i}" for c in INSIDE]) for i, t in enumerate(TEXTS)]
    names = ["doc_id", "text", "lang", *INSIDE]
    return llm.createDataFrame(rows, ", ".join(f"`{c}` {'long' if c == 'doc_id' else 'string'}" for c in names))


def kept(out, added):
    assert out.columns == ["doc_id", "lang", *INSIDE, *added]
    rows = {r["doc_id"]: r for r in out.collect()}
    assert len(rows) == len(TEXTS)
    for i, r in rows.items():
        assert [r[c] for c in INSIDE] == [f"{c}{i}" for c in INSIDE]
    return rows


@pytest.mark.parametrize("chunk", [32_768, 64])
def test_encode_and_decode(docs, monkeypatch, chunk):
    monkeypatch.setattr(bpe, "CHUNK", chunk)
    monkeypatch.setattr(bpe, "OVERLAP", min(chunk // 2, 2_048))
    rows = kept(bpe.encode(docs, back=True), ["ids", "decoded"])
    assert all(rows[i].decoded.decode() == (t or "") for i, t in enumerate(TEXTS))
    again = bpe.decode(bpe.encode(docs.withColumn("ids", F.lit(1)).withColumn("decoded", F.lit(2))))
    assert {r.doc_id: r.decoded.decode() for r in again.collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert again.columns.count("ids") == again.columns.count("decoded") == 1


def test_remove_repeats(docs):
    rows = kept(suffix_dedup.remove_repeats(docs, as_text=True), ["spans", "n_bytes", "kept"])
    assert rows[0].kept == TEXTS[0] and len(rows[4].kept) < 200
    twice = suffix_dedup.remove_repeats(docs.withColumn("spans", F.lit(1)).withColumn("kept", F.lit("z")))
    assert twice.columns == ["doc_id", "lang", *INSIDE, "spans", "n_bytes", "kept"]
    assert twice.filter("doc_id = 0").first().kept == TEXTS[0].encode()


@pytest.mark.parametrize("block", [100_000, 1])
def test_find_benchmark(docs, llm, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    items = llm.createDataFrame([(7, TEXTS[0]), (8, "eleven twelve")], "item_id long, text string")
    rows = kept(decontaminate.find_benchmark(docs, items), ["n_words", "hits", "items", "near_items"])
    assert list(rows[0]["items"]) == ["7"] and not rows[3]["items"]


def test_score(docs, llm):
    model = kneser_ney.train(kneser_ney.gram_counts(
        docs.select(F.lit(1).alias("fold"), "text")), folds=1)
    rows = kept(kneser_ney.score(docs, model, folds=1), ["n_bytes", "perplexity"])
    assert rows[0].perplexity < 256 and rows[1].n_bytes == 0
