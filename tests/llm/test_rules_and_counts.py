"""Cutoffs that bite (operator 10) against SQL and a plain loop; counts of the byte-level BPE (operator 8)."""

import math
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from oracle_check import compare
from tidemark.llm import quality_rules, token_counts
from tidemark.llm.bpe import default_vocabulary, encoding
from tidemark.llm.sql import SQL


def labelled_corpus(seed=4):
    """(documents, labels): 1,400 clean ones of en, 540 of de, 300 of a null language, the rest unlabelled.

    Few clean documents have symbols, so the large language proves a strict cutoff.
    """
    rng = random.Random(seed)
    docs, labels = [], []
    for lang, clean, other in (("en", 1400, 60), ("de", 540, 40), (None, 300, 20)):
        for k in range(clean + other):
            words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 8))) for _ in range(rng.randint(20, 40))]
            if k >= clean or rng.random() < .0015:
                words = [w + "#" * rng.randint(0, 3) for w in words]
            if rng.random() < .3:
                words[0] = words[0].upper()
            docs.append((len(docs), " ".join(words), lang))
            if k < clean:
                labels.append((len(docs) - 1, 1, 0))
    docs += [(len(docs), None, "en"), (len(docs) + 1, "", "fr"), (None, "short", None)]
    return docs, labels + [(0, 1, 0), (None, 1, 0), (700, 0, 1)]


@pytest.fixture(scope="module")
def fixture_dir(llm, tmp_path_factory):
    path = tmp_path_factory.mktemp("rules")
    docs, labels = labelled_corpus()
    llm.createDataFrame(docs, "doc_id long, text string, lang string") \
        .write.parquet(str(path / "documents.parquet"))
    llm.createDataFrame(labels, "doc_id long, quality long, toxic long").write.parquet(str(path / "labels.parquet"))
    return path


def test_cutoffs_that_bite_equal_sql(llm, fixture_dir):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{fixture_dir}/{table}.parquet/*.parquet')")
    out = quality_rules.op10_quality_rules(llm, str(fixture_dir))
    got = compare(out, con, SQL["op10_quality_rules"])
    assert got["match"], got
    assert out.filter("NOT kept AND NOT base_failed").count() > 50       # beyond the base rules


def test_cutoffs_equal_a_plain_sequence(llm, fixture_dir):
    docs = llm.read.parquet(f"{fixture_dir}/documents.parquet")
    measured = quality_rules.measure(docs)
    cuts = quality_rules.calibrate(measured, llm.read.parquet(f"{fixture_dir}/labels.parquet"))
    got = {(r.stratum, r.rule): r.cutoff for r in cuts.collect()}

    clean = {i for i, quality, _ in labelled_corpus()[1] if quality == 1 and i is not None}
    scores = defaultdict(list)
    for r in measured.filter("NOT base_failed").collect():
        for rule, top, bottom in quality_rules.RULES:
            if r.doc_id in clean:
                scores[r.lang, rule].append(r[top] * 1000 // r[bottom] if r[bottom] else 0)
    want, level = {}, 0.05 / len(scores)
    for key, held in scores.items():
        for cutoff in sorted(quality_rules.GRID[key[1]], reverse=True):
            k, n = sum(s > cutoff for s in held), len(held)
            if k >= n * .01 or sum(math.comb(n, i) * .01 ** i * .99 ** (n - i) for i in range(k + 1)) > level:
                break
            want[key] = cutoff
    assert got == want
    assert {lang for lang, _ in got} == {"en"}      # 540 and 300 are too few for three strata
    assert quality_rules.minimum_holdout(3) == 568


@pytest.mark.parametrize("missing", [0, 1])
def test_a_stratum_needs_the_stated_minimum(llm, missing):
    n = quality_rules.minimum_holdout(1) - missing
    text = " ".join(f"w{i}" for i in range(20))
    docs = llm.range(n).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"), F.lit("en").alias("lang"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    found = quality_rules.calibrate(quality_rules.measure(docs), labels)
    assert found.count() == (0 if missing else len(quality_rules.RULES))


def test_no_labels_and_no_documents(llm, fixture_dir):
    docs = llm.read.parquet(f"{fixture_dir}/documents.parquet")
    labels = llm.read.parquet(f"{fixture_dir}/labels.parquet")
    measured = quality_rules.measure(docs)
    out = quality_rules.apply_rules(measured, quality_rules.calibrate(measured, labels.limit(0)))
    assert out.count() == docs.count() and out.filter("kept = base_failed").isEmpty()
    none = quality_rules.measure(docs.limit(0))
    assert quality_rules.apply_rules(none, quality_rules.calibrate(none, labels)).isEmpty()


def test_bpe_totals_equal_a_plain_count(llm):
    enc, first = encoding(*default_vocabulary()), {}
    for r in sorted(llm.read.parquet(f"{SF_SMALL}/documents.parquet").collect(), key=lambda r: r.doc_id):
        first.setdefault(r.text or "", r)
    want = defaultdict(lambda: [0, 0])
    for text, r in first.items():
        for version, n in (("bytes-v1", len(text.encode())), ("byte_bpe_50k", len(enc.encode_ordinary(text)))):
            total = want[r.source, r.lang, version]
            total[0] += 1
            total[1] += n
    got = token_counts.token_counts_bpe(llm, SF_SMALL).collect()
    assert {(r.source, r.lang, r.tokenizer): [r.n_docs, r.n_tokens] for r in got} == dict(want)
    assert len(got) == len(want)


def test_a_revision_moves_a_document_to_its_new_key(llm):
    event = "op string, source string, lang string, tokenizer string, tokens long, old_source string, " \
            "old_lang string, old_tokenizer string, old_tokens long"
    rows = [("insert", "a", "en", "v0", 10, None, None, None, None),
            ("revise", "b", None, "v1", 12, "a", "en", "v0", 10),
            ("revise", "b", None, "v1", 13, "b", None, "v1", 12)]
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens)
           for r in token_counts.deltas(llm.createDataFrame(rows, event)).collect()}
    assert got == {("a", "en", "v0"): (0, 0), ("b", None, "v1"): (1, 13)}
