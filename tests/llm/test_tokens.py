"""Operators 4 (shards), 6 (chat), 7 (BPE) and 8 (counts)."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat_format, token_counts, token_shards
from tidemark.llm.common import shared_path

ENC = bpe.encoding(*bpe.default_vocabulary())


def awkward_texts(n=60):
    rnd = random.Random(1)
    bits = ["a", "bb", "cé", "  ", " ", "\n", "\n\n", "'s", "'ll", "'", "12", "###", "日本", " the", "l", "x" * 30,
            "     ", "don't", "\r\n", "😀"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 400))) for _ in range(n)]
    return texts + [None, "", "a" * 500, " " * 500, "'l" * 300, "a" * 300 + " b" * 200]


def test_bpe_equals_the_library_and_decodes(docs_of, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK", 64)
    monkeypatch.setattr(bpe, "OVERLAP", 16)
    texts = awkward_texts()
    rows = bpe.encode(docs_of(list(enumerate(texts))).select("doc_id", "text"), back=True).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert r.ids == ENC.encode_ordinary(text)
        assert bytes(r.decoded) == text.encode()


def test_bpe_digests_of_repeated_rows(docs_of):
    long = "word " * 20_000
    rows = bpe.digests(docs_of([(1, long), (1, long), (2, None)])).collect()
    ids = ENC.encode_ordinary(long)
    want = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert [(r.n_tokens, r.ids_sha256) for r in rows if r.doc_id == 1] == [(len(ids), want)] * 2
    assert bpe.digests(docs_of([])).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100, 4097])
def test_slots_are_a_keyed_bijection(size):
    a = token_shards.permute(np.arange(size), size, 1)
    assert sorted(a) == list(range(size))
    if size > 50:
        assert (a != token_shards.permute(np.arange(size), size, 2)).any()


def test_shards_hold_every_sequence_at_its_slot(docs_of, llm):
    texts = ["x " * 400, "", None, "short", "y " * 300, "x " * 400]
    target, written = token_shards.write_shards(
        docs_of(list(enumerate(texts))), shared_path(llm, "shards"), slots=3)
    rows = token_shards.read_back(llm, target, written).collect()
    want = set()
    for i, text in enumerate(texts):
        ids = np.append(ENC.encode_to_numpy(text or ""), token_shards.END).astype("<u2")
        for k in range(0, len(ids), token_shards.LENGTH):
            part = ids[k:k + token_shards.LENGTH]
            want.add((i, k // token_shards.LENGTH, len(part), zlib.crc32(part.tobytes())))
    assert {(r.doc_id, r.seq, r.n_tokens, r.ids_crc32) for r in rows} == want
    assert sorted(r.slot for r in rows) == list(range(target.total))
    again = token_shards.read_slots(target, 1, 1)[0]      # resume inside a file
    assert [(r.doc_id, r.seq) for r in rows if r.slot == 1] == [(again["doc_id"], again["seq"])]
    none, files = token_shards.write_shards(docs_of([]), shared_path(llm, "shards"))
    assert none.total == 0 and files.count() == 0


def test_chat_template_is_reversible(llm):
    turns = [(1, 0, "user", "<s><\\s>[INST]<"), (1, 1, "user", "\\<\\\\/s>["), (1, 2, "assistant", "<t><\\t>"),
             (1, 3, "assistant", None), (1, 4, "</s>x", ""), (1, 5, "assistant", "é<t"), (None, None, None, None),
             (2, 1, "user", "tie"), (2, 1, "user", "tie")]
    df = llm.createDataFrame([(*t, "x") for t in turns],
                             "conv_id long, turn long, role string, text string, formatted string")
    out = chat_format.format_conversations(df)
    rows = {r.conv_id: r for r in out.select(
        "conv_id", "formatted", chat_format.parse_turns(F.col("formatted")).alias("turns"),
        chat_format.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()}
    assert [(t.role, t.text) for t in rows[1].turns] == [(t[2], t[3] or "") for t in turns[:6]]
    assert rows[1].loss == "<t><\\t>é<t"
    assert rows[1].formatted.count("[INST]") == 4          # merged: user, assistant, other, assistant
    assert [(t.role, t.text) for t in rows[None].turns] == [("", "")]
    assert [t.text for t in rows[2].turns] == ["tie", "tie"]
    assert chat_format.format_conversations(df.limit(0)).count() == 0


def test_loss_mask_of_a_long_conversation(llm):
    n = 3 * chat_format._RUN + 5
    turns = llm.range(n).selectExpr("1L AS conv_id", "id AS turn",
                                    "if(id % 3 = 0, 'user', 'assistant') AS role", "'t' || id AS text")
    loss = chat_format.format_conversations(turns).select(
        chat_format.masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss")).first().loss
    assert loss == "".join(f"t{i}" for i in range(n) if i % 3)


def event(op, source, tokens, old_source=None, old=None):
    return (op, source, "en", "w", tokens, old_source, "en" if old is not None else None,
            "w" if old is not None else None, old)


EVENT = ("op string, source string, lang string, tokenizer string, tokens long, "
         "old_source string, old_lang string, old_tokenizer string, old_tokens long")


def test_rollup_commits_once_and_compacts(llm):
    rollup = token_counts.Rollup(llm, shared_path(llm, "rollup"))
    assert rollup.totals().count() == 0
    frame = lambda *e: llm.createDataFrame(list(e), EVENT)
    assert rollup.commit("1", frame(event("insert", "a", 10), event("insert", "a", 5), event("insert", None, 2)))
    second = frame(event("revise", "b", 7, "a", 5), event("delete", None, 2))
    assert rollup.commit("2", second)
    assert not rollup.commit("2", second)
    want = [("a", 1, 10), ("b", 1, 7)]
    totals = lambda: sorted((r.source, r.n_docs, r.n_tokens) for r in rollup.totals().collect())
    assert totals() == want
    rollup.compact("base")
    assert totals() == want
    assert not rollup.commit("1", frame(event("insert", "a", 10)))   # folded batches stay known
    assert rollup.commit("3", llm.createDataFrame([], EVENT))
    assert totals() == want


def test_a_half_written_batch_is_redone(llm):
    rollup = token_counts.Rollup(llm, shared_path(llm, "rollup"))
    first = llm.createDataFrame([event("insert", "a", 10)], EVENT)
    lost = token_counts.deltas(first).withColumn("held", F.lit(None).cast("array<string>"))
    lost.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{rollup.path}/batch=1")
    assert rollup.batches() == []
    assert rollup.commit("1", first)
    assert [(r.source, r.n_docs) for r in rollup.totals().collect()] == [("a", 1)]


def test_shards_equal_a_plain_layout_slot_by_slot(docs_of, llm):
    """Awkward texts, several partitions: every record of every file, byte by byte."""
    texts = awkward_texts() + ["many words here " * 300, "\u00a0 a\u2003 b  c \n d é f\x7f g"] * 3
    docs = docs_of(list(enumerate(texts))).repartition(5).checkpoint()
    target, written = token_shards.write_shards(docs, shared_path(llm, "shards"), key=7, slots=16)
    order = [r.doc_id for part in docs.rdd.glom().collect() for r in part]
    rows = []
    for i in order:
        ids = [*ENC.encode_ordinary(texts[i] or ""), token_shards.END]
        rows += [(i, k // token_shards.LENGTH, ids[k:k + token_shards.LENGTH])
                 for k in range(0, len(ids), token_shards.LENGTH)]
    assert target.total == len(rows)
    slots = token_shards.permute(np.arange(len(rows)), len(rows), 7).tolist()
    for slot, (doc, seq, ids) in zip(slots, rows):
        got = token_shards.read_slots(target, slot, 1)[0]
        assert (got["doc_id"], got["seq"], got["count"]) == (doc, seq, len(ids))
        assert got["ids"].tolist() == ids + [token_shards.END] * (token_shards.LENGTH - len(ids))
    files = written.collect()
    assert sorted(r.shard for r in files) == list(range(-(-len(rows) // 16)))
    assert token_shards.read_back(llm, target, written).rdd.getNumPartitions() == len(files)


def test_a_gap_in_a_shard_is_an_error(docs_of, llm, monkeypatch):
    numbered = token_shards._numbered
    monkeypatch.setattr(token_shards, "_numbered", lambda rows: (numbered(rows)[0], 3))
    with pytest.raises(Exception, match="another order"):
        token_shards.write_shards(docs_of([(1, "a"), (2, "b")]), shared_path(llm, "shards"))


def test_counts_delete_copies_whose_id_is_null(llm, tmp_path):
    rows = [(None, "same"), (1, "same"), (2, "same"), (None, "alone"), (None, None), (3, "")]
    llm.createDataFrame([(i, t, "en", "s", 0) for i, t in rows],
                        "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    got = token_counts.op8_token_counts(llm, str(tmp_path)).collect()
    import duckdb
    from tidemark.llm.sql import SQL
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(SQL["op8_token_counts"]).fetchall()
    assert sorted(tuple(r) for r in got) == sorted(want) and {r.n_docs for r in got} == {3}
