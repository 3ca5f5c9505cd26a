import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def llm(spark):
    """The session, with the package importable in Python workers."""
    from tidemark.llm.common import on_workers
    on_workers(spark)
    return spark


@pytest.fixture(scope="session")
def docs_of(llm):
    """documents from (doc_id, text) pairs, with columns that no operator knows
    but whose names operators use inside."""
    def make(pairs):
        rows = [(i, t, "en", "s", 0, "x", 1.0) for i, t in pairs]
        return llm.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, "
                  "kept string, n_bytes double")
    return make
