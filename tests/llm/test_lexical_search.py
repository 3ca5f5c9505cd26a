"""Operator 11 against a score of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lexical_search as L


def terms(text):
    return re.findall(L.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=10):
    vectors = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_words = len(vectors), sum(sum(v.values()) for _, v in vectors)
    df = Counter(t for _, v in vectors for t in v)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, v in vectors:
            m = 25 + 75 * sum(v.values()) * n_docs // n_words
            score = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * v[t] // (1000 * v[t] + 8 * m)) for t, c in wanted.items() if t in v)
            if score > 0:
                scored.append((-score, math.inf if doc is None else doc))
        out += [(item, r + 1, None if d == math.inf else d, -s) for r, (s, d) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    words = ["The", "the", "of", "Été", "日本", "a1", "x-y", "rare", "deep", "tree", "é\x00b", "_", "of."] + [f"w{i}" for i in range(40)]
    text = lambda k: " ".join(rnd.choices(words, [1 / (i + 1) for i in range(len(words))], k=k))
    docs = [(i, text(rnd.randint(1, 40))) for i in range(n)]
    docs += [(n + i, "the of w1 rare") for i in range(30)] + [(-1, None), (-2, ""), (-3, " .,_"), (None, "rare deep"),
                                                              (None, "rare deep"), (5, "w39 w39 w39"), (5, "w39 w39 w39"),
                                                              (-4, "of " * 30_000)]
    items = [(i, text(rnd.randint(1, 12))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "unknownword"), (None, "rare of"), (3, "w2 w2 w2"), (103, "rare rare of w1 the")]
    return docs, items


@pytest.mark.parametrize("leaf, pairs, parts", [(1, 1 << 20, 1), (4, 60, 3), (32, 1 << 20, 4)])
def test_equals_scoring_every_document(llm, leaf, pairs, parts):
    docs, items = corpus(leaf, 400)
    d = llm.createDataFrame([(i, t, "en", 1, 2.0) for i, t in docs], "doc_id long, text string, term string, m int, score double")
    q = llm.createDataFrame([(i, t, 7) for i, t in items], "item_id long, text string, rank int")
    got = L.search(d.repartition(parts), q, leaf=leaf, pairs=pairs).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, items)


def test_empty_tables(llm, docs_of):
    none = llm.createDataFrame([], "item_id long, text string")
    one = llm.createDataFrame([(1, "a b")], "item_id long, text string")
    assert L.search(docs_of([(1, "a b")]), none).count() == 0
    assert L.search(docs_of([]), one).count() == 0
    assert L.search(docs_of([(1, None)]), one).count() == 0


def test_bounds_hold_and_leave_leaves_out():
    rnd = np.random.default_rng(5)
    width, n = 60, 3_000
    docs = sorted(tuple(sorted(set((rnd.zipf(1.4, 12) - 1).clip(0, width - 1).tolist()))) for _ in range(n))
    ends = np.concatenate([[0], np.cumsum([len(x) for x in docs])])
    path = np.array([t for x in docs for t in x])
    tf = rnd.integers(1, 5, len(path))
    m, ids = rnd.integers(25, 400, n), rnd.permutation(n)
    tree = L.Tree(ids, m, ends, path, tf, width)
    leaves = [i for i, c in enumerate(tree.children) if not len(c)]
    assert sorted(x for i in leaves for x in range(tree.lo[i], tree.hi[i])) == list(range(n))
    wanted = np.array([2, 9, 21, 40])
    weights = np.array([300, 2_000, 4_000, 6_000])
    dense = np.zeros(width, np.int64)
    dense[wanted] = weights
    scores = np.add.reduceat(dense[path] * tree.parts, ends[:-1])
    bound = tree.bounds(np.arange(len(tree.lo)), wanted, weights)
    assert all(bound[i] >= scores[tree.lo[i]:tree.hi[i]].max() for i in range(len(tree.lo)))
    seen, best = [], []
    tree.ids = type("Seen", (), {"__getitem__": lambda _, k: (seen.append(k), ids[k])[1]})()
    tree.search(wanted, weights, dense, best)
    assert best == sorted(zip((-scores).tolist(), ids.tolist()))[:10]
    assert len(seen) < 0.75 * len(leaves)
