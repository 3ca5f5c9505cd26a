"""Operators 3 (classifier), 5 (shards), 9 (benchmark), 10 (rules), the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from oracle_check import compare, duck
from tidemark.llm import decontaminate, kneser_ney, quality_rules, shard
from tidemark.llm.queries import QUERIES
from tidemark.llm.sql import SQL

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(llm, name):
    got = compare(QUERIES[name](llm, SF_SMALL), duck(SF_SMALL), SQL[name])
    assert got["match"], got


def model_by_hand(texts):
    """Interpolated modified Kneser-Ney over bytes in plain Python."""
    edge, size = bytes([kneser_ney.EDGE]), kneser_ney.ORDER
    padded = lambda t: edge * (size - 1) + t.encode() + edge
    counts = Counter()
    for t in texts:
        counts.update(padded(t)[i:i + size] for i in range(len(t.encode()) + 1))
    levels = [counts]
    for _ in range(size - 1):
        levels.append(Counter(g[1:] for g in levels[-1]))

    def order(counts, below):
        n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
        d = [min(max(k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else .5 * k, .05), k - .05) for k in (1, 2, 3)]
        off = lambda c: d[min(c, 3) - 1]
        total, left = Counter(), Counter()
        for g, c in counts.items():
            total[g[:-1]] += c
            left[g[:-1]] += off(c)

        def p(g):
            if not total[g[:-1]]:
                return below(g[1:])
            seen = (counts[g] - off(counts[g])) / total[g[:-1]] if counts[g] else 0.0
            return seen + left[g[:-1]] / total[g[:-1]] * below(g[1:])
        return p

    p = lambda g: 1 / 256
    for counts in reversed(levels):
        p = order(counts, p)

    def perplexity(t):
        logs = [math.log(p(padded(t)[i:i + size])) for i in range(len(t.encode()) + 1)]
        return math.exp(-sum(logs) / len(logs))
    return p, perplexity


def counted(llm, rows):
    """Counts of (fold, text) rows."""
    return kneser_ney.gram_counts(llm.createDataFrame(rows, "fold int, text string"))


@pytest.mark.parametrize("block", [1 << 24, 8])
def test_kneser_ney_equals_a_plain_computation(docs_of, llm, monkeypatch, block):
    monkeypatch.setattr(kneser_ney, "BLOCK", block)
    trusted = ["the cat sat on the mat", "a cat and a hat", "the mat is flat", "éa où", ""]
    p, perplexity = model_by_hand(trusted)
    for context in (b"the ", b"zzzz", b"\xff\xff\xffa"):
        assert sum(p(context + bytes([b])) for b in range(256)) == pytest.approx(1, rel=1e-9)
    model = kneser_ney.train(counted(llm, [(1, t) for t in trusted]), folds=1)     # model 0 sees every other fold
    texts = ["the hat", "ZZZ###", "", None, "été", "the cat sat on the mat", "the hat", "x" * 3000]
    got = kneser_ney.score(docs_of(list(enumerate(texts))), model, keep_text=True, folds=1).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(texts)))
    for r in got:
        assert r.text == texts[r.doc_id] and (r.lang, r.kept) == ("en", "x")
        assert r.perplexity == pytest.approx(perplexity(texts[r.doc_id] or ""), rel=1e-4)
        assert r.n_bytes == len((texts[r.doc_id] or "").encode())
    assert kneser_ney.score(docs_of([]), model).count() == 0
    empty = kneser_ney.train(counted(llm, []), folds=1)
    uniform = kneser_ney.score(docs_of([(1, "abc")]), empty, folds=1).first()
    assert uniform.perplexity == pytest.approx(256, rel=1e-3)


def test_every_text_is_scored_without_its_own_fold(docs_of, llm):
    texts = [f"text {i} of the {'cat' if i % 3 else 'hat'}" for i in range(40)]
    docs = docs_of(list(enumerate(texts))).withColumn("fold", kneser_ney._fold(F.col("text")))
    fold = {r.doc_id: r.fold for r in docs.collect()}
    got = kneser_ney.score(docs, kneser_ney.train(kneser_ney.gram_counts(docs))).collect()
    by_fold = {k: model_by_hand([t for i, t in enumerate(texts) if fold[i] != k])[1] for k in set(fold.values())}
    assert len(got) == 40 and len(by_fold) > 1
    for r in got:
        assert r.fold == fold[r.doc_id]
        assert r.perplexity == pytest.approx(by_fold[fold[r.doc_id]](texts[r.doc_id]), rel=1e-4)


def test_thresholds_equal_a_plain_computation(llm):
    rnd = random.Random(6)
    rows = [(lang, rnd.choice([0, 30, 70, 2000]), rnd.uniform(2, 9), rnd.random() < share)
            for lang, n, share in (("en", 400, .8), ("de", 20, .7), (None, 9, .5), ("xx", 8, 0)) for _ in range(n)]
    scored = llm.createDataFrame(rows, "lang string, n_bytes long, perplexity double, trusted boolean")
    got = {r.lang: r.limits for r in kneser_ney.thresholds(scored).collect()}
    rank = lambda q, v: sorted(v)[max(math.ceil(q * len(v)), 1) - 1]
    size = lambda n: sum(n >= e for e in kneser_ney.LENGTHS)
    cut, prior = kneser_ney.Cut(), kneser_ney.PRIOR
    median = {}
    for lang in {r[0] for r in rows}:
        mine = [r[2] for r in rows if r[0] == lang and r[3]]
        median[lang] = rank(.5, mine or [r[2] for r in rows if r[0] == lang])
    ratios = [(r[0], size(r[1]), r[2] / median[r[0]]) for r in rows if r[3]]
    blend = lambda own, n, general: math.exp((n * math.log(own) + prior * math.log(general)) / (n + prior))
    every = rank(cut.quantile, [r for _, _, r in ratios])
    assert set(got) == set(median)
    for lang in median:
        for k in range(len(kneser_ney.LENGTHS) + 1):
            of = [r for _, s, r in ratios if s == k]
            general = blend(rank(cut.quantile, of), len(of), every) if of else every
            own = [r for x, s, r in ratios if (x, s) == (lang, k)]
            limit = blend(rank(cut.quantile, own), len(own), general) if own else general
            assert got[lang][k] == pytest.approx(limit * median[lang] * cut.margin, rel=1e-9)


def test_classifier_without_trusted_documents_keeps_all(docs_of, llm):
    labels = llm.createDataFrame([(1, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of([(1, "abc"), (2, None), (None, "x"), (2, "y")]).drop("n_bytes").withColumn("_lang", F.lit("z"))
    scored = kneser_ney.materialise(kneser_ney.score(docs, kneser_ney.fit(docs, labels)), "scored")
    out = kneser_ney.judge(scored, labels)
    assert out.columns == [c for c in docs.columns if c not in ("text", "kept")] + [
        "n_bytes", "perplexity", "threshold", "kept"]
    assert [(r.kept, r.threshold, r._lang) for r in out.collect()] == [(True, None, "z")] * 4


def test_classifier_keeps_clean_and_rejects_low_quality(llm):
    sf = "/root/testdata/sf0.1"
    got = kneser_ney.materialise(QUERIES["op3_quality_classifier"](llm, sf), "op3").join(
        llm.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    share = F.avg(F.col("kept").cast("int")).alias("kept")
    rate = {(r.quality, r.toxic): r.kept for r in got.groupBy("quality", "toxic").agg(share).collect()}
    assert rate[1, 0] > 0.995 and rate[0, 0] < 0.12 and rate[0, 1] < 0.10
    for r in got.groupBy("lang", "quality").agg(share).collect():
        assert r.kept > 0.99 if r.quality else r.kept < 0.2, r


def test_shards_are_even_gapless_and_keep_groups_together(docs_of):
    rnd = random.Random(4)
    texts = [f"doc {i}" for i in range(300)] + [f"group {g}" for g in range(30) for _ in range(rnd.randint(2, 9))]
    texts += ["large"] * 250 + [None, "", None]
    pairs = list(enumerate(texts)) + [(0, "doc 0")]
    out = shard.shard_documents(docs_of(pairs)).toPandas()
    assert len(out) == len(pairs)
    counts = out.groupby("shard").size()
    assert len(counts) == 16 and counts.max() - counts.min() <= 1
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    texts_by = dict(pairs)
    assert all(r.text_crc32 == zlib.crc32((texts_by[r.doc_id] or "").encode()) for r in out.itertuples())
    assert all(r.size == len((texts_by[r.doc_id] or "").encode()) + 1 for r in out.itertuples())
    out["link"] = out.link.map(bytes)
    spread = out.groupby("link").shard.agg(["size", "nunique"])
    small = spread[(spread["size"] > 1) & (spread["size"] < 20)]
    assert (small["nunique"] == 1).mean() > 0.5      # by chance none would be whole
    assert shard.shard_documents(docs_of([])).count() == 0


@pytest.mark.parametrize("pairs", [1_200, 2_400])
def test_pairs_that_fit_come_together(docs_of, pairs):
    """Of 6,000 rows, two in each pair; 15 of 16 pairs are split at first."""
    texts = [f"pair {i // 2}" for i in range(2 * pairs)] + [f"single {i}" for i in range(6_000 - 2 * pairs)]
    out = shard.shard_documents(docs_of(list(enumerate(texts)))).toPandas()
    spread = out.groupby(out.link.map(bytes)).shard.agg(["size", "nunique"])
    cut = int((spread[spread["size"] == 2]["nunique"] == 2).sum())
    print("pairs cut", cut, "of", pairs)
    assert cut < pairs * 0.1


def words_of(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def hits(docs, items):
    windows = {}
    for i, text in items:
        w = words_of(text)
        for k in range(max(1, len(w) - 9)) if w else ():
            windows.setdefault(tuple(w[k:k + 10]), set()).add(str(i))
    out = {}
    for d, text in docs:
        w, covered, found = words_of(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    found |= windows[tuple(w[k:k + size])]
                    covered |= set(range(k, k + size))
        out[d] = (len(w), sorted(covered), sorted(found))
    return out


@pytest.mark.parametrize("block", [100_000, 40])
def test_benchmark_hits_equal_brute_force(docs_of, llm, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK", block)
    rnd = random.Random(3)
    said = lambda n: " ".join(rnd.choice(["a", "b", "Cc", "é1", "x"]) for _ in range(n))
    docs = [(i, said(rnd.randint(0, 50))) for i in range(60)] + [(900, None), (901, ""), (902, "a. B! cc?")]
    items = [(i, said(rnd.randint(0, 14))) for i in range(20)] + [(77, None), (78, "!!"), (5, "a b")]
    found = decontaminate.find_benchmark(
        docs_of(docs).select("doc_id", "text"), llm.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: (r.n_words, list(r.hits), list(r.items)) for r in found} == hits(docs, items)


def test_benchmark_edges_and_proximity(docs_of, llm):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, item), (2, "two one three four five six seven eight nine zero ten"), (3, "one two"), (4, item + " x")]
    frame = docs_of(docs).select("doc_id", "text")
    items = llm.createDataFrame([(9, item)], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.find_benchmark(frame, items).collect()}
    assert [len(rows[i].hits) for i in (1, 2, 3, 4)] == [10, 0, 0, 10]
    assert [list(rows[i].near_items) for i in (1, 2, 3)] == [["9"], ["9"], []]
    assert all(not r["items"] for r in decontaminate.find_benchmark(frame, items.limit(0)).collect())
    assert decontaminate.find_benchmark(frame.limit(0), items).count() == 0


@pytest.mark.parametrize("k,n,p", [(0, 100, .01), (3, 1000, .01), (0, 700, .01), (40, 10_000, .005), (5, 100, .01)])
def test_binomial_tail_is_exact(llm, k, n, p):
    got = llm.range(1).select(quality_rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    exact = 1.0 if k >= n * p else sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
    assert got == pytest.approx(exact, rel=1e-9)


def test_measurements_of_awkward_texts(docs_of):
    eight = "a b c d e f g h"
    texts = [None, "", " \n\t", eight + " " + eight, eight + " x " + eight + " " + eight, "l\nl\n \nm\nl", "é#é",
             " ".join(["w"] * 3000)]
    rows = {r.doc_id: r for r in quality_rules.measure(docs_of(list(enumerate(texts)))).collect()}
    assert [rows[i].n_words for i in range(8)] == [0, 0, 0, 16, 25, 4, 1, 3000]
    assert [rows[i].n_repeat_words for i in range(8)] == [0, 0, 0, 16, 24, 0, 0, 3000]
    assert rows[5].n_dup_lines == 2 and rows[6].n_symbols == 1 and rows[6].word_chars == 3
    assert all(rows[i].base_failed for i in range(8))


def test_pipeline_stages_keep_the_columns(llm):
    docs = llm.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("kept", F.lit("x")).withColumn("s1", F.lit(1))
    n = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, SF_SMALL)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out = corpus_pipeline.materialise(out, "stage")
        assert 0 < out.count() <= n
        docs, n = out, out.count()
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_pipeline_stage_decisions(llm, docs_of):
    text = " ".join(f"t{i}" for i in range(60))
    docs = docs_of([(1, text), (2, text), (3, text + " more"), (4, "other " * 30), (None, text)])
    left = corpus_pipeline.near_duplicates(llm, docs, SF_SMALL)
    assert sorted(r.doc_id for r in left.collect()) == [1, 4]
    cut = corpus_pipeline.repeats(llm, docs_of([(1, text + "é"), (2, "été " * 3 + text + "é.")]), SF_SMALL).collect()
    assert all(r.n_chars == len(r.text) for r in cut)
    assert [r.text for r in cut if r.doc_id == 2] == ["été été été ."]
    first = llm.read.parquet(f"{SF_SMALL}/benchmark.parquet").orderBy("item_id").first()
    kept = corpus_pipeline.benchmark(llm, docs_of([(1, "x " + first.text), (2, "clean text"), (None, "y")]), SF_SMALL)
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "None"]
    assert hashlib.sha256(b"").hexdigest() in {
        r.decoded_sha256 for r in corpus_pipeline.tokens(llm, docs_of([(1, None)]), SF_SMALL).collect()}
    assert pd.DataFrame(corpus_pipeline.STAGES).shape == (5, 2)


def test_pipeline_near_duplicates_keep_columns_of_any_name(llm):
    """Columns named like those that the stage uses inside come back as they were."""
    words = " ".join(f"w{i}" for i in range(40))
    df = llm.createDataFrame([(1, words, 7, 8, "r", "a"), (2, words, 9, 10, "s", "b"), (1, words, 7, 8, "r", "a")],
                             "doc_id long, text string, _hash long, _copy int, _rest string, _id string")
    out = corpus_pipeline.near_duplicates(llm, df, SF_SMALL)
    assert out.columns == df.columns
    assert [tuple(r) for r in out.collect()] == [(1, words, 7, 8, "r", "a")]
