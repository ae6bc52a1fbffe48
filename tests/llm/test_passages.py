"""Passages that occurred before, wherever they begin, against a plain window check."""

import random

import pytest

import __spark_entry__ as entry
from tests.llm import brute
from tidemark.llm import line_dedup, passage_dedup

SF = "/root/testdata/sf0.001"
N = line_dedup.MIN_WORDS


def plain(rows):
    """(id, text) rows in order of id: the words that stay."""
    seen, out = set(), {}
    for i, text in rows:
        words = brute.ASCII_WORD.findall(text or "")
        gone = set()
        for j in range(len(words) - N + 1):
            window = tuple(words[j : j + N])
            if window in seen:
                gone.update(range(j, j + N))
            seen.add(window)
        out[i] = [w for j, w in enumerate(words) if j not in gone]
    return out


def left_over(rows, kept, n=50):
    """Number of windows of `n` words that an earlier text has and that are still there."""
    seen, left = set(), 0
    for i, text in rows:

        def windows(t):
            words = brute.ASCII_WORD.findall(t or "")
            return {tuple(words[j : j + n]) for j in range(len(words) - n + 1)}

        left += len(windows(kept[i]) & windows(text) & seen)
        seen |= windows(text)
    return left


def torn_rows():
    """A passage glued into the middle of sentences, with one whole sentence of 21 words in it."""
    deal = random.Random(7)

    def words(n):
        return [f"w{deal.randrange(10**9)}" for _ in range(n)]

    passage = words(60)
    for j in (24, 45):
        passage[j] += "."
    rows = []
    for i in range(40):
        begin = deal.randrange(0, 9)
        rows.append((i, ("  " if i % 3 == 0 else "") + " ".join(words(5 + i) + passage[begin : begin + 51] + words(7)) + "\n" * (i % 2)))
    rows.append((90, "la " * 100))
    rows.append((91, "x y " * 13))
    return rows


def test_torn_passages(spark):
    rows = torn_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in passage_dedup.dedup_passages(docs).collect()}
    kept = {i: r.kept_text for i, r in found.items()}
    want = plain(rows)
    assert {i: brute.ASCII_WORD.findall(t) for i, t in kept.items()} == want
    assert all(found[i].removed_words == len(brute.ASCII_WORD.findall(t)) - len(want[i]) for i, t in rows)
    assert left_over(rows, kept) == 0
    # Lines alone do not find them.
    assert left_over(rows, brute.line_dedup(rows)) > 0


def test_documents(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    found = {r.doc_id: r.kept_text for r in entry.queries()["op9_passages"](spark, SF).collect()}
    assert {i: brute.ASCII_WORD.findall(t or "") for i, t in found.items()} == plain(rows)
    assert left_over(rows, found) == 0


@pytest.mark.parametrize("n", [1, 8, 9, 25, 50])
def test_edges(spark, n):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text), (1, text), (1, text), (1, "a b"), (2, None), (3, ""), (4, " \n "), (5, "tail " + text)]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, k int")
    found = passage_dedup.dedup_passages(docs, min_words=n)
    assert found.columns == [*docs.columns, "kept_text", "removed_words"]
    got = sorted(((r.doc_id or 0, r.text or "", str(r.kept_text)) for r in found.collect()))
    assert got == sorted([(0, text, text), (1, text, ""), (1, text, ""), (1, "a b", "a b"), (2, "", "None"), (3, "", ""), (4, " \n ", " \n "), (5, "tail " + text, "tail ")])
    assert passage_dedup.dedup_passages(docs.limit(0), min_words=n).collect() == []
