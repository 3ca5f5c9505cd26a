"""Operator 12 against a count of every phrase in plain Python."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import collocations as C


def brute(rows, least, longest, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    out = []
    some = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    for (lang, p), a in some.items():
        if any(x == lang and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q)))
               for (x, q), b in some.items()):
            continue
        score, _, left, right = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k,
                                     f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    ranked = []
    for lang in n:
        best = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        ranked += [(r[0], i + 1, *r[1:]) for i, r in enumerate(best)]
    return sorted(ranked)


def corpus(seed, n=120):
    rnd = random.Random(seed)
    words = ["a", "B", "b", "the", "é", "日本", "\x00x", "of", "q's", "zz", " "]
    gaps = [" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r", "!"]
    make = lambda: "".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.randint(0, 60)))
    rows = [(rnd.choice(["en", "de", None]), make()) for _ in range(n)]
    copy = "the same long passage of words again"
    return rows + [("en", copy)] * 9 + [("en", None), (None, ""), ("de", " \t\n.,"), ("de", "a b " * 400)]


@pytest.mark.parametrize("limit, burst, bits, slots", [
    (1 << 19, 4096, C.BITS, C.SLOTS), (40, 5, 1 << 16, 1 << 16), (7, 2, 64, 64)])
def test_equals_a_plain_count(llm, limit, burst, bits, slots):
    rows = corpus(limit)
    df = llm.createDataFrame([(i, t, g, "x", 1) for i, (g, t) in enumerate(rows)],
                             "doc_id long, text string, lang string, phrase string, f int").repartition(3)
    got = C.mine(df, least=5, longest=5, top=25, limit=limit, burst=burst, bits=bits, slots=slots).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 5, 5, 25)


def test_no_phrases_and_empty_table(docs_of):
    assert C.mine(docs_of([(1, "a b c"), (2, None)])).count() == 0
    assert C.mine(docs_of([])).count() == 0


def test_scores_beyond_64_bits(llm):
    totals = llm.createDataFrame([("en", 10 ** 15)], "lang string, n long")
    counts = llm.createDataFrame([("en", "a", 1, 3 * 10 ** 13), ("en", "b", 1, 7 * 10 ** 12), ("en", "a b", 2, 10 ** 12)],
                                 "lang string, phrase string, size int, f long")
    held = C.frequent
    try:
        C.frequent = lambda *_, **__: (totals, counts)
        row = C.mine(counts).first()
    finally:
        C.frequent = held
    assert row.score == 1000 * 10 ** 12 * 10 ** 15 // (3 * 10 ** 13 * 7 * 10 ** 12)


def test_a_trie_keeps_every_count_through_bursts_and_spills():
    rnd = np.random.default_rng(1)
    trie, want, got = C.HatTrie(4, burst=3), Counter(), Counter()
    for _ in range(200):
        for k in (3, 4):
            rows, counts = np.unique(rnd.integers(0, 4, (30, k)), axis=0, return_counts=True)
            trie.add(rows, counts)
            want.update({r.astype(">u4").tobytes(): int(n) for r, n in zip(rows, counts)})
        run = list(trie.spill(60))
        assert trie.size <= 60
        for key, n in run:
            got[key] += n
    for key, n in trie.spill(-1):
        got[key] += n
    assert got == want and trie.size == 0 and not trie.root
    one = C.HatTrie(3, burst=2)
    one.add(np.array([[5, 1, 1], [5, 1, 2], [5, 2, 0], [9, 0, 0]]), np.ones(4, np.int64))
    assert isinstance(one.root[np.array([5], ">u4").tobytes()], C._Node)
    keys = [k for k, _ in one.spill(-1)]
    assert keys[:3] == sorted(keys[:3]) or keys[1:] == sorted(keys[1:])


def test_rare_phrases_of_frequent_pairs_are_not_counted_in_runs(llm, monkeypatch):
    """only the pairs were sieved, so these phrases grew faster than the texts."""
    texts = [("en", f"a b. b c. c d. x{i} a b c d y{i}" if i < 3 else "a b. b c. c d") for i in range(9)]
    counted, merge = [], C.merge_runs

    def seen(runs, least):
        counted.append(runs.agg({"n": "sum"}).first()[0])
        return merge(runs, least)

    monkeypatch.setattr(C, "merge_runs", seen)
    got = C.mine(llm.createDataFrame(texts, "lang string, text string").coalesce(1), least=5, longest=5, top=25)
    assert sorted(tuple(r) for r in got.collect()) == brute(texts, 5, 5, 25)
    assert counted == [3, None]


def test_slots_are_added_up_once_there_are_many(monkeypatch):
    """everything held was sorted again for every slice of text."""
    rnd, calls, added = np.random.default_rng(2), [], C._added
    monkeypatch.setattr(C, "PENDING", 2000)
    monkeypatch.setattr(C, "_added", lambda *a: calls.append(len(a[0])) or added(*a))
    seen, want, got = C._SlotCounts(1 << 12, 300), Counter(), Counter()

    def take():
        for number, packed in zip(*(x.to_pylist() for x in seen.rows())):
            both = np.frombuffer(C.zstandard.decompress(packed), np.uint16)
            place, n = np.split(both, 2)
            for slot, k in zip(place.tolist(), n.tolist()):
                got[number * seen.span + slot] += k

    for _ in range(100):
        h = rnd.integers(0, 1 << 62, 50).astype(np.uint64)
        want.update((h % np.uint64(1 << 12)).tolist())
        if seen.add(h):
            take()
    take()
    assert got == want and sum(calls) < 20_000
    for _ in range(3):
        seen.add(np.full(200, 7, np.uint64))
    take()
    assert got[7] - want[7] == 300
    assert [len(x) for x in seen.rows()] == [0, 0]


def test_small_batches_make_one_slice_a_language(monkeypatch):
    """a slice of each batch and language went through all steps on its own."""
    batches = [C.pa.RecordBatch.from_pydict({"lang": ["en", "de"], "text": [f"a{i}", "é" * 10]}) for i in range(20)]
    got = list(C._by_language(iter(batches)))
    assert sorted((one, len(texts)) for one, texts in got) == [("de", 20), ("en", 20)]
    monkeypatch.setattr(C, "SLICE", 50)
    got = list(C._by_language(iter(batches)))
    assert max(C.pc.sum(C.pc.binary_length(texts)).as_py() for _, texts in got) <= 50
    assert sorted(t for one, texts in got if one == "en" for t in texts.to_pylist()) == sorted(f"a{i}" for i in range(20))
    assert sum(len(texts) for one, texts in got if one == "de") == 20


@pytest.mark.parametrize("slots", [64, 1 << 16, 1 << 26, 1 << 28])
def test_neighbours_of_a_sieve_of_any_size(slots):
    span = C._span(slots)
    assert slots % span == 0 and span % 64 == 0 and span <= 1 << 16


def test_slots_follow_the_words(llm):
    of = lambda n: C.slots_for(llm.createDataFrame([("en", None, n), ("en", "a", 3)], "lang string, phrase string, f long"))
    assert (of(5), of(10 ** 9), of(10 ** 12)) == (1 << 26, 1 << 27, 1 << 28)
    assert C.slots_for(llm.createDataFrame([], "lang string, phrase string, f long")) == 1 << 26


def test_packed_runs_do_not_grow_with_tasks_times_partitions(llm):
    """each task cut its runs into four parts a shuffle partition and phrase size."""
    text = " ".join(f"{a} {b} x." for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz")
    df = llm.createDataFrame([("en", text)], "lang string, text string").coalesce(1)
    before = llm.conf.get("spark.sql.shuffle.partitions")
    llm.conf.set("spark.sql.shuffle.partitions", "500")
    try:
        runs = C.phrase_runs(df, lambda h: np.ones(len(h), bool), (2, 3))
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", before)
    n, rows, parts = runs.selectExpr("sum(n)", "count(*)", "count(DISTINCT prefix)").first()
    assert n == 26 * 26 * 2 and rows == parts <= C.PREFIXES
