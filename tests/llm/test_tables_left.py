"""Intermediate tables in the shared folder: deleted once nothing is read from them."""

import os

import pytest

import corpus_pipeline
from conftest import SF_SMALL
from tidemark.llm import jaccard_join
from tidemark.llm.common import discard, last_table_stays, materialise
from tidemark.session import ensure_checkpoint_dir


@pytest.fixture
def left(llm):
    """Names of the tables written since the test began, without their numbers."""
    folder = ensure_checkpoint_dir(llm).removeprefix("file:")
    before = set(os.listdir(folder))
    return lambda: sorted(x.rpartition("-")[0] for x in set(os.listdir(folder)) - before)


def test_the_pipeline_leaves_its_result_only(llm, left):
    out = corpus_pipeline.run(llm, SF_SMALL)
    assert left() == ["byte-level-BPE"] and out.count() > 0


def test_the_join_leaves_small_tables_only(docs_of, left):
    text = " ".join(f"w{i}" for i in range(40))
    out = jaccard_join.jaccard_components(docs_of([(1, text), (2, text + " end"), (3, "other words here now")]))
    assert {r.doc_id: r.component_id for r in out.collect()} == {1: 1, 2: 1, 3: 3}
    assert not {"shingles", "candidates", "common", "keys", "stars", "named"} & set(left())


def test_an_error_leaves_what_was_written(llm, left):
    with pytest.raises(ValueError):
        with last_table_stays():
            first = materialise(llm.range(3), "first")
            materialise(llm.range(4), "second")
            raise ValueError
    assert left() == ["first", "second"]
    discard(first, first)
    assert left() == ["second"]
