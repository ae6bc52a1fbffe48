"""Repeated word runs against a plain check of windows."""

import random

import pytest

import __spark_entry__ as entry
from tests.llm import brute
from tests.llm.test_passages import N, left_over, plain, torn_rows
from tidemark.llm import run_dedup

SF = "/root/testdata/sf0.001"


def words_of(text):
    return brute.ASCII_WORD.findall(text or "")


def is_within(some, words):
    """Whether `some` are found in `words` in their order."""
    rest = iter(words)
    return all(word in rest for word in some)


def assert_right(rows, kept, n=N):
    """Nothing goes but words of `n` or more that occurred before; no 2n - 1 such words stay."""
    seen = set()
    for i, text in rows:
        words, left = words_of(text), words_of(kept[i])
        windows = [tuple(words[j : j + n]) for j in range(len(words) - n + 1)]
        may_go, mine = set(), set()
        for j, window in enumerate(windows):
            if window in seen or window in mine:
                may_go.update(range(j, j + n))
            mine.add(window)
        assert is_within([w for j, w in enumerate(words) if j not in may_go], left), i
        assert is_within(left, words), i
        seen |= mine
    assert left_over(rows, kept, 2 * n - 1) == 0


def test_torn_passages(spark):
    rows = torn_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in run_dedup.dedup_runs(docs).collect()}
    kept = {i: r.kept_text for i, r in found.items()}
    assert_right([r for r in rows if r[0] < 40], kept)
    for i, text in rows:
        assert found[i].removed_words == len(words_of(text)) - len(words_of(kept[i]))
    assert found[0].removed_words == 0


def test_one_passage_in_many_texts(spark):
    passage = " ".join(f"p{i}" + "." * (i % 20 == 9) for i in range(68))
    rows = [(i, f"begin{i} " + " ".join(f"a{i}x{j}" for j in range(i % 7)) + f" {passage} " + " ".join(f"b{i}x{j}" for j in range(i % 40))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in run_dedup.dedup_runs(docs).collect()}
    assert found[0].kept_text == rows[0][1]
    # At most eight words are left at each end, and no other word goes.
    assert all(68 - 16 <= found[i].removed_words <= 68 for i in range(1, 300))
    assert_right(rows, {i: r.kept_text for i, r in found.items()})


def test_documents(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    found = {r.doc_id: r.kept_text for r in entry.queries()["op9_word_runs"](spark, SF).collect()}
    assert left_over(rows, found, 2 * N - 1) == 0
    seen, texts = set(), set()
    for i, text in rows:
        windows = {tuple(w[j : j + N]) for w in [words_of(text)] for j in range(len(w) - N + 1)}
        if not windows & seen and len(windows) == max(0, len(words_of(text)) - N + 1):
            assert found[i] == text  # nothing occurred before
        if text in texts and len(words_of(text)) >= N:
            assert found[i] == ""
        seen |= windows
        texts.add(text)


@pytest.mark.parametrize("n", [1, 8, 9, 25, 50])
def test_edges(spark, n):
    text = " ".join(f"w{i}" for i in range(60))
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [(None, text), (1, text), (1, text), (1, "A"), (2, None), (3, ""), (4, " \n "), (5, "\n" + text), (6, long), (7, long)]
    docs = spark.createDataFrame([(*r, 9, 8) for r in rows], "doc_id long, text string, k int, n int")
    found = run_dedup.dedup_runs(docs, min_words=n)
    assert found.columns == [*docs.columns, "kept_text", "removed_words"]
    got = sorted(((r.doc_id or 0, r.text or "", str(r.kept_text)) for r in found.collect()))
    want = [(0, text, text), (1, text, ""), (1, text, ""), (1, "A", "A"), (2, "", "None"), (3, "", ""), (4, " \n ", " \n "), (5, "\n" + text, ""), (6, long, long), (7, long, "")]
    assert got == sorted(want)
    assert run_dedup.dedup_runs(docs.limit(0), min_words=n).collect() == []


def exact(spark, rows, n=N):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in run_dedup.dedup_runs(docs, min_words=n).collect()}
    want = plain(rows)
    assert {i: words_of(r.kept_text) for i, r in found.items()} == want
    assert {i: r.removed_words for i, r in found.items()} == {i: len(words_of(t)) - len(want[i]) for i, t in rows}


def test_every_run_of_any_place(spark):
    """Runs of exactly 25 words, which have a sparser fingerprint in a third of the cases only."""
    source = [f"s{i}" for i in range(400)]
    rows = [(0, " ".join(source))]
    for i in range(1, 120):
        own = [f"o{i}x{j}" for j in range(2 * (i % 30) + 40)]
        run = source[3 * i : 3 * i + N - (i % 10 == 9)]  # every tenth is a word too short
        rows.append((i, " ".join(own[: i % 30] + run + own[i % 30 :])))
    exact(spark, rows)


def test_run_of_a_later_occurrence(spark):
    """The first text with a fingerprint is not the one that has the run."""
    core = [f"c{i}" for i in range(N - 1)]
    begin = [(10 + i, " ".join([f"a{i}x{j}" for j in range(9)] + core[i : i + 14] + [f"b{i}x{j}" for j in range(9)])) for i in range(11)]
    whole = [(30 + i, " ".join([f"d{i}x{j}" for j in range(9)] + ["left"] * (i % 2) + core + ["right"] * (i % 3) + [f"e{i}x{j}" for j in range(9)])) for i in range(12)]
    exact(spark, [*begin, *whole])


def test_runs_inside_one_text_and_small_words(spark):
    deal = random.Random(3)
    rows = [(i, " ".join(deal.choice("abc") for _ in range(deal.randrange(0, 300)))) for i in range(60)]
    part = [f"p{j}" for j in range(70)]
    rows += [(70, " ".join([*part, "x", *part[20:60], "y", *part[:25]])), (71, "la " * 100), (72, " ".join([*part[30:], *part[:30]]))]
    exact(spark, rows)


def test_all_documents_exactly(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    found = {r.doc_id: r.kept_text for r in entry.queries()["op9_word_runs"](spark, SF).collect()}
    assert {i: words_of(t) for i, t in found.items()} == plain(rows)
