"""Spelling variants against a plain neighbourhood of every word."""

import random

import pytest

from tests.llm import brute
from tidemark.llm import queries, spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def got(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def lists(letters, least, most, n, seed):
    """Words of random letters, and how often they occur."""
    rnd = random.Random(seed)
    return {"".join(rnd.choice(letters) for _ in range(rnd.randint(least, most))): 5 ** rnd.randint(1, 6) for _ in range(n)}


@pytest.mark.parametrize(
    ("words", "index"),
    [
        (lists("ab", 6, 9, 900, 1), {"longest_list": 4, "often": 20}),
        (lists("ab", 6, 9, 900, 2), {}),
        (lists("abcé", 6, 7, 3000, 3), {"longest_list": 16, "often": 50, "longest": 5}),
        (lists("aeinrst", 1, 6, 3000, 4), {"often": 5, "shortest": 1, "longest": 3}),
        (lists("aeinrst", 2, 7, 3000, 5), {"often": 10**9}),
        (lists("aeinrst", 2, 12, 3000, 6), {"often": 0, "most": 10**9}),
        ({w[:70] + x + w[70:]: 5 for w in ("ab" * 60, "abc" * 50, "q" * 130) for x in ("", "a", "b", "bb", "xa")} | lists("ab", 99, 101, 300, 9), {"longest_list": 8}),
    ],
)
def test_all_neighbours_are_found_once(spark, words, index):
    df = spark.createDataFrame([(w, n, "x") for w, n in words.items()], "word string, n long, key string")
    assert got(spelling.spelling_variants(df, **index)) == brute.variants(words)


def test_grams_outside_an_edit_stay():
    rnd = random.Random(7)
    words = list(lists("abcd", 6, 12, 400, 8))
    for often in (0, 5, 40, 10**9):
        whole = [f"<<<{w}>>>" for w in words]
        counts = {}
        for w in whole:
            for q in (2, 3):
                for i in range(len(w) - q + 1):
                    counts[w[i : i + q]] = counts.get(w[i : i + q], 0) + 1
        prolonged = {g for g, n in counts.items() if n > often}
        for w in words:
            place = rnd.randrange(len(w))
            changed = w[:place] + rnd.choice(["", "a", "da", "b" + w[place]]) + w[place + 1 :]
            if changed == w:
                continue
            heads = [{(v[:h], v[t:], len(v) - gone) for h, t, gone, _, _ in spelling.merged_lists(v, prolonged)} for v in (w, changed)]
            if changed in brute.near([w, changed])[w]:
                assert heads[0] & heads[1]


def test_edges(spark):
    schema = "doc_id long, text string, word string, n int, key string"
    text = "Station station STATION station station; stationn Ätation ätation été×÷ straße123straße a" + " l" + "o" * 100_000 + "ng " + "o" * 30 + " p" + "o" * 200
    docs = [(1, text), (1, text), (2, None), (None, text), (3, ""), (4, text), (None, text), (5, text + "x" * 50)] * 2
    df = spark.createDataFrame([(*d, "w", 1, "k") for d in docs], schema)
    assert got(spelling.spelling_variants(spelling.count_words(df, misprint=3))) == brute.spelling(docs, 3)
    assert spelling.spelling_variants(spelling.count_words(df.limit(0))).collect() == []
    nothing = spark.createDataFrame([(None, 7), ("abcdef", 1)], "word string, n long")
    assert {tuple(r) for r in spelling.spelling_variants(nothing).collect()} == {(None, None, None, 7, 0, None), ("abcdef", None, "abcdef", 1, 0, None)}


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op12_spelling(spark, sf)) == brute.spelling(docs)
