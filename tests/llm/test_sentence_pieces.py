"""Operator 13: the ids and texts are the library's."""

import hashlib
import random

import pytest

from tidemark.llm import sentence_pieces as S

SP = S.processor(S.default_model())


def awkward_texts(n=60):
    rnd = random.Random(3)
    bits = ["a", "the", " ", " ", "  ", "     ", "▁", "\n", "\t", "é", "日本", "😀", "\x00", "<s>", "</s>", "<0x41>",
            "x" * 20, "word", "　", " ", "é", "ﬁ"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 200))) for _ in range(n)]
    return texts + [None, "", " ", "  ", "a ", " a", "a  ", "▁", "▁▁a", "a▁", " " * 40, "b" * 3000]


@pytest.mark.parametrize("size", [1, 300, S.BLOCK])
def test_ids_and_texts_equal_the_library(docs_of, size):
    texts = awkward_texts()
    rows = S.encode(docs_of(list(enumerate(texts))), back=True, size=size).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    for r in rows:
        want = SP.encode(texts[r.doc_id] or "")
        assert r.ids == want, texts[r.doc_id]
        assert r.decoded == SP.decode(want)


def test_other_columns_are_kept_and_clashing_names_do_no_harm(llm):
    df = llm.createDataFrame([(1, "a b", "x", [9], "r", "d", 7), (None, None, None, None, None, None, None)],
                             "doc_id long, text string, block string, ids array<int>, row string, "
                             "decoded string, `a.b` int")
    out = S.encode(df)
    assert out.columns == ["doc_id", "block", "row", "decoded", "a.b", "ids"]
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[1].ids == SP.encode("a b") and rows[1].block == "x" and rows[1]["a.b"] == 7
    assert rows[None].ids == []


def test_repeated_rows_empty_table_and_decode(docs_of):
    long = "same words " * 5_000
    rows = S.digests(docs_of([(1, long), (1, long), (2, "")])).collect()
    ids = SP.encode(long)
    want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(SP.decode(ids).encode()).hexdigest())
    assert [tuple(r)[1:] for r in rows if r.doc_id == 1] == [want] * 2
    assert [r.n_tokens for r in rows if r.doc_id == 2] == [0]
    assert S.digests(docs_of([])).count() == 0
    back = S.decode(S.encode(docs_of([(1, "  two  words ▁x"), (2, None)])).drop("kept")).collect()
    assert {r.doc_id: r.decoded for r in back} == {1: "  two  words  x", 2: ""}


def test_a_table_that_starts_anew_gives_the_same_ids():
    table = S.WordTable(S.default_model(), 4)
    for i in range(50):
        words = [f"w{i % 7}", "", f"v{i}", " x"]
        assert table.lookup(words) == [SP.encode(w) or [SP.piece_to_id(S.MARK)] for w in words]
        assert len(table.ids) <= 4


def test_a_model_whose_pieces_cross_markers_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2
    model = sentencepiece_model_pb2.ModelProto()
    with open(S.default_model(), "rb") as f:
        model.ParseFromString(f.read())
    model.pieces[300].piece = "a▁b"
    path = tmp_path / "crossing.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="cross"):
        S.check_model(str(path))
