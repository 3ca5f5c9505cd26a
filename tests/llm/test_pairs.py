"""Operator 1 (Jaccard join) and operator 2 (suffix dedup) against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from conftest import SF_SMALL
from tidemark.llm import jaccard_join, queries, suffix_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def components(pairs):
    """(set size, smallest linked id) by comparing all sets that share a shingle."""
    sets = {}
    for i, text in pairs:
        w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[j:j + 3]) for j in range(max(1, len(w) - 2))) if w else frozenset()
    has, parent = defaultdict(list), {i: i for i in sets}
    for i, s in sets.items():
        for g in s:
            has[g].append(i)

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for j, both in Counter(j for g in s for j in has[g] if j < i).items():
            if 100 * both >= 90 * (len(s) + len(sets[j]) - both):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def near_copies(seed=5):
    """Groups around a base, edited so that many pairs are just above or below
    the threshold; short and long sets, ties, blanks, nulls, repeated texts."""
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    texts = []
    for size, copies in [(30, 30), (60, 60), (150, 80), (260, 40), (300, 30), (12, 30), (11, 20)]:
        base = [rnd.choice(words) for _ in range(size)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, size // 25))):
                k, way = rnd.randrange(len(w)), rnd.random()
                if way < .5:
                    w[k] = rnd.choice(words[:20])
                elif way < .75:
                    del w[k]
                else:
                    w.insert(k, rnd.choice(words[:20]))
            texts.append(" ".join(w))
    texts += ["", "  ", "a", "A", "a b", "a  B", None, None, "x y z", "X y\tz"]
    rnd.shuffle(texts)
    return list(enumerate(texts))


def test_jaccard_components_equal_brute_force(docs_of):
    pairs = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in jaccard_join.jaccard_components(docs_of(pairs)).collect()}
    assert got == components(pairs)


@pytest.mark.parametrize("n,rare,paired", [(9, 0, True), (40, 3, True), (256, 0, True), (400, 10, False)])
def test_prefix_survives_the_misses(n, rare, paired):
    """Whatever misses a link allows are taken away, one indexed key survives."""
    misses = n // 10
    c1, c2 = jaccard_join._prefix(misses, rare, n - rare, paired)
    assert c1 + max(0, c2 - (1 if paired else 0)) > misses


def test_jaccard_empty_table_and_shared_ids(docs_of):
    assert jaccard_join.jaccard_components(docs_of([])).count() == 0
    text = " ".join(f"t{i}" for i in range(30))
    rows = jaccard_join.jaccard_components(docs_of([(7, text), (7, text), (3, text), (None, text), (None, None)]))
    assert sorted((str(r.doc_id), str(r.component_id)) for r in rows.collect()) == [
        ("3", "3"), ("7", "3"), ("7", "3"), ("None", "3"), ("None", "None")]


def cut(pairs, size=100):
    seen, out = set(), {}
    for i, text in sorted(pairs, key=lambda p: p[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - size + 1):
            if raw[k:k + size] in seen:
                gone[k:k + size] = True
            else:
                seen.add(raw[k:k + size])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out[i] = (len(raw), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def digest(rows):
    return {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans), hashlib.sha256(r.kept).hexdigest())
            for r in rows}


def repeated_texts():
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choice("abcdeé \n") for _ in range(n))
    line, passage = text(60), text(400)
    pairs = [(i, text(rnd.randint(0, 300)) + passage[rnd.randint(0, 90):] + text(50)) for i in range(12)]
    pairs += [(100 + i, text(80) + line + text(80)) for i in range(80)]       # shorter than a string
    pairs += [(200, "a" * 1000), (201, "ab" * 300), (202, "a" * 150), (203, "x" * 99), (204, "x" * 100),
              (205, "x" * 100), (206, ""), (207, None), (208, passage), (209, passage + passage)]
    return pairs


def test_suffix_dedup_equals_brute_force(docs_of, monkeypatch):
    pairs = repeated_texts()
    random.Random(1).shuffle(pairs)
    out = suffix_dedup.remove_repeats(docs_of(pairs).select("doc_id", "text"))
    assert digest(out.collect()) == cut(pairs)
    # every trigger hot: all suffixes go by their hashes
    monkeypatch.setattr(suffix_dedup, "CLOSE", 1)
    out = suffix_dedup.remove_repeats(docs_of(pairs).select("doc_id", "text"))
    assert digest(out.collect()) == cut(pairs)


def test_suffix_dedup_repeated_rows_and_empty(docs_of):
    assert suffix_dedup.remove_repeats(docs_of([]).select("doc_id", "text")).count() == 0
    text = "".join(chr(97 + i * 7 % 26) for i in range(300)) + "".join(chr(65 + i * i % 26) for i in range(200))
    rows = suffix_dedup.remove_repeats(docs_of([(1, text), (1, text), (2, text)]).select("doc_id", "text")).collect()
    first = cut([(1, text)])[1]
    assert [digest([r])[1] for r in rows if r.doc_id == 1] == [first, first]
    assert [len(r.kept) for r in rows if r.doc_id == 2] == [0]


def test_registered_queries_cover_every_document(llm):
    n = llm.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    for name in ("op1_jaccard_join", "op2_suffix_dedup"):
        assert queries.QUERIES[name](llm, SF_SMALL).count() == n
