"""Operators against plain re-statements on the small tables."""

import hashlib
import re
from html import unescape

import pytest

import __spark_entry__ as entry
from tests.llm import brute
from tidemark.llm import line_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").collect()


def rows_of(spark, name):
    return entry.queries()[name](spark, SF).collect()


def test_pii(spark, documents):
    found = {r.doc_id: r for r in rows_of(spark, "op1_pii")}
    assert len(found) == len(documents)
    for doc in documents:
        spans, got = brute.pii(doc.text), found[doc.doc_id]
        assert (got.n_email, got.n_ip, got.n_card, got.n_phone) == tuple(len(spans[k]) for k in ("email", "ip", "card", "phone"))
        listed = ",".join(f"{k}:{a}:{b}" for k, v in spans.items() for a, b in v)
        assert got.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert got.spans.startswith(listed)


def test_language_of_held_out_documents(spark, documents):
    truth = {r.doc_id: r.lang for r in documents}
    held = [r for r in rows_of(spark, "op2_langid") if r.held_out]
    assert len(held) > 30
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)


def test_main_text(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for got in rows_of(spark, "op3_html"):
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[got.page_id].html, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1)>", re.sub(r"<[^>]*\Z", "", article))
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", lambda m: " " if "br" in m.group() else "", b)).split()) for b in blocks]
        assert got.text == "\n\n".join(b for b in blocks if b)
        assert got.n_chars == len(got.text) and got.url == pages[got.page_id].url


def test_quality_counts(spark, documents):
    found = {r.doc_id: r for r in rows_of(spark, "op4_fertility")}
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for doc in documents:
        got, want = found[doc.doc_id], brute.quality(doc.text)
        assert (got.n_words, got.word_chars, got.n_symbols, got.n_dup_lines, got.n_repeat_words) == want
        assert got.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (got.base_failed and got.kept)
    judged = [(quality[i], r.kept) for i, r in found.items() if i in quality and not r.base_failed]
    assert all(kept for good, kept in judged if good)
    assert sum(not kept for good, kept in judged if not good) >= 0.8 * sum(not good for good, _ in judged)


def test_similarity_join(spark, documents):
    want = brute.jaccard([(r.doc_id, r.text) for r in documents])
    found = rows_of(spark, "op5_jaccard")
    assert {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in found} == want
    assert any(links for _, links, _ in want.values())


def test_backoff_scores(spark, documents):
    want = dict(zip([r.doc_id for r in documents], brute.backoff([r.text for r in documents]), strict=True))
    for r in rows_of(spark, "op6_backoff"):
        assert r.n_words == want[r.doc_id][0]
        assert r.log_score == pytest.approx(want[r.doc_id][1], abs=2e-4)


def test_mix(spark, documents):
    sizes = {r.doc_id: len(brute.ASCII_WORD.findall(r.text or "")) for r in documents}
    want = brute.mix([(r.doc_id, r.source, sizes[r.doc_id]) for r in documents])
    assert {r.doc_id: r.taken for r in rows_of(spark, "op7_mixing")} == want


def test_toxicity_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = entry.queries()["op8_toxicity"](spark, sf).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.85 * len(held)


def test_line_dedup(spark, documents):
    want = brute.line_dedup(sorted((r.doc_id, r.text) for r in documents))
    found = {r.doc_id: r.kept_text for r in rows_of(spark, "op9_line_dedup")}
    assert any(t == "" for t in want.values())
    assert found == want


def test_shared_passages_are_found(spark, documents):
    """Three neighbouring pieces that an earlier text has are marked, at least two of them."""
    rows = sorted((r.doc_id, r.text) for r in documents)
    found = {r.doc_id: set(r.places) for r in line_dedup.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    known, repeats = set(), 0
    for i, text in rows:
        bare = [p.strip() for p in brute.pieces(text)]
        triples = [(tuple(bare[j : j + 3]), j) for j in range(len(bare) - 2)]
        for triple, j in triples:
            if triple in known:
                repeats += 1
                assert len({j, j + 1, j + 2} & found.get(i, set())) >= 2
        known.update(t for t, _ in triples)
    assert repeats > 20


def test_decontamination(spark, documents):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = {r.doc_id: r for r in rows_of(spark, "op10_decontamination")}
    for doc in documents:
        n, hit, ids = brute.contamination(doc.text, items)
        got = found[doc.doc_id]
        assert (got.n_words, got.n_hit, got.n_items) == (n, hit, len(ids))
        assert got.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()
        assert got.contaminated == (hit > 0 and 20 * hit >= n)
    assert any(r.contaminated for r in found.values())
