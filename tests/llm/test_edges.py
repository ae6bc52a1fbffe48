"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import math

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tidemark.llm import decontaminate, fertility, html_main, jaccard, langid, line_dedup, mixing, pii, stupid_backoff, toxicity
from tidemark.llm.html_main import main_blocks, rules, wrapper_of
from tidemark.llm.html_tree import parse

LONG = " ".join(f"word{i % 97} thing{i % 89}." for i in range(60_000))
PROSE = "The cat sat on the mat while a dog ran past the old house. It was raining hard all day long, and nobody went out to play."
SCHEMA = "doc_id long, text string, lang string, source string, pii int, k int, words string, h int, `group` string, key string, part int, size int"
ROWS = [
    (1, PROSE, "en", "a"),
    (1, PROSE, "en", "a"),
    (1, "another text under the same id", "en", "a"),
    (2, None, None, None),
    (3, "", "en", "b"),
    (4, " \n\t ", "fr", "b"),
    (None, PROSE + " More words follow here.", "en", None),
    (None, None, None, "c"),
    (5, LONG, "en", "c"),
    (6, "12345 !!! 678", None, "c"),
    (7, "日本語のテキスト", "ja", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, 9, 8, "x", 7, "g", "y", 6, 5) for r in ROWS], SCHEMA).cache()


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "the cat sat on the mat while a dog ran past the old house"), (2, None), (3, ""), (4, "dog ran"), (None, "It was raining"), (4, "dog ran")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_pii(docs):
    found = pii.find_pii(docs)
    assert found.columns == docs.columns and found.count() == len(ROWS)
    assert all(r.pii == [] for r in found.collect())
    assert pii.find_pii(docs.limit(0)).collect() == []


@pytest.mark.parametrize(
    "text",
    [
        "a@b.c@d.e x@y z@w.co.uk, ..@a-b.c a@@b.cc @x.yz q@r.s.",
        "1.2.3.4.5.6.7.8.9 256.1.1.1 01.002.0.255 1.2.3 1..2.3.4 9" + ".9" * 40,
        "4111 1111 1111 1111 4111-1111-1111-1112 0000000000000 1 2 3  4 " + "7" * 50,
        "+1 (555) 010-9999 +49 30 123456 +1 +12 +123456789012345678 +1--- x +1.2.3.4.5.6.7.8.9",
        "".join(chr(c) for c in range(33, 127)) * 3,
        "é@x.com ü+49 89 1234567 日本1.2.3.4語 ０１@ｘ.ｙ İ a@b.cd",
        "9" * 30_000 + "@" + "a" * 30_000,
    ],
)
def test_pii_base_spans(text):
    spans = pii.Scanner().spans(text)
    for kind, want in brute.pii(text).items():
        assert [(a, b) for k, a, b in spans if k == kind] == want


def test_pii_cues():
    text = 'name (at) host (dot) com, IBAN: DE89 3704 0044 0532 0130 00 AND Konto Nr. 1234567890; password=hunter2xyz https://u:pw@h.org/x token = "abcdef123456"'
    found = {kind: text[a:b] for kind, a, b in pii.Scanner().spans(text)}
    assert found["masked_email"] == "name (at) host (dot) com"
    assert found["iban"] == "DE89 3704 0044 0532 0130 00"
    assert found["account"] == "1234567890"
    assert found["login_url"] == "https://u:pw@h.org"
    assert found["secret"] == "abcdef123456"


def test_redaction(spark):
    df = pii.find_pii(spark.createDataFrame([("mail a@b.cc now",), ("none",), (None,)], "text string"))
    assert [r[0] for r in df.select(pii.redact(F.col("text"), F.col("pii"))).collect()] == ["mail <email> now", "none", None]


def test_language(spark, docs):
    model = langid.learn(docs)
    assert model.languages == ["en", "fr", "ja"]
    found = langid.identify(docs, model, out="words").select("text", "words.*").collect()
    by_text = {r.text: (r.lang, r.score) for r in found}
    assert by_text[None] == by_text[""] == by_text["12345 !!! 678"] == ("und", 0.0)
    assert by_text[PROSE][0] == "en" and by_text["日本語のテキスト"][0] == "ja"
    nothing = langid.learn(docs.limit(0))
    assert nothing.languages == [] and nothing.predict(PROSE, {}) == ("und", 0.0)
    assert langid.identify(docs.limit(0), model).collect() == []


def test_unseen_words_back_off():
    model = langid.LanguageModel(["x", "y"])
    model.words, model.grams = {"abc": 0}, {"_ab": 0, "b": 1}
    model.word_logs, model.gram_logs = [[-1.0, -2.0]], None
    import numpy as np

    model.word_logs, model.gram_logs = np.array([[-1.0, -2.0]]), np.array([[-3.0, -1.0], [-5.0, -9.0]])
    assert list(model.unseen("abx")) == [-3.0, -1.0]  # the longer n-gram decides
    assert list(model.unseen("xb")) == [-5.0, -9.0]
    assert list(model.unseen("zzz")) == [0.0, 0.0]


def test_quality(docs):
    found = fertility.judge(docs).collect()
    assert len(found) == len(ROWS)
    by_words = {r.n_words: r for r in found}
    assert by_words[0].base_failed and not by_words[0].kept
    assert by_words[120_000].n_repeat_words == 120_000 and by_words[120_000].base_failed
    assert fertility.judge(docs.limit(0)).collect() == []


def test_similarity_join(docs):
    found = jaccard.near_duplicates(docs).collect()
    assert len(found) == len(ROWS)
    by_size = {}
    for r in found:
        by_size.setdefault(r.n_shingles, []).append(r)
    assert all(r.n_links == 0 and r.n_copies == 1 for r in by_size[0])
    twins = [r for r in found if r.doc_id == 1 and r.n_copies == 2]
    assert len(twins) == 2 and {r.class_id for r in twins} == {1} and {r.n_links for r in twins} == {1}
    assert [r.class_id for r in found if r.doc_id is None and r.n_shingles] == [1]
    assert jaccard.near_duplicates(docs.limit(0)).collect() == []
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count(PROSE) == 1 and PROSE + " More words follow here." not in texts and texts.count(None) == 2
    assert jaccard.one_of_each(docs.limit(0)).collect() == []


def test_large_group_of_near_copies(spark):
    """More members than a block holds, so blocks meet each other; a chain that is linked only in steps."""
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(words[: i % 7] + ["odd" + str(i)] + words[i % 7 :])) for i in range(900)]
    chain = [f"c{i}" for i in range(400)]
    rows += [(10_000 + s, " ".join(chain[12 * s : 12 * s + 220])) for s in range(8)]
    found = {r.doc_id: r for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute.jaccard([(i, t) for i, t in rows if i % 9 == 0 or i >= 10_000])
    assert {found[i].class_id for i in range(900)} == {0}
    assert {found[i].n_links for i in range(900)} == {899}
    for i in range(10_000, 10_008):
        assert (found[i].class_id, found[i].n_links) == want[i][:2]


def test_backoff(docs):
    found = stupid_backoff.score(docs, batch_chars=200).collect()
    want = brute.backoff([r[1] for r in ROWS])
    assert len(found) == len(ROWS)
    got = sorted((r.n_words, round(r.log_score, 5)) for r in found)
    assert got == sorted((n, round(s, 5)) for n, s in want)
    assert all((r.mean_log is None) == (r.n_words == 0) for r in found)
    assert stupid_backoff.score(docs.limit(0)).collect() == []


def test_longer_ngrams():
    import numpy as np

    grams, sizes = stupid_backoff.grams_of(["a b c", None, "b c"], 3)
    assert list(sizes) == [3, 0, 2]
    assert grams[1][0] == grams[1][3] == 0 and grams[1][2] == grams[1][4] != 0
    assert list(np.flatnonzero(grams[2])) == [2]


def test_mix(spark, docs):
    found = mixing.mix(docs.withColumn("target", F.lit(1))).collect()
    assert len(found) == len(ROWS)
    taken = {}
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    assert all(taken[r.source] == math.floor(r.target) for r in found)
    assert mixing.mix(docs.limit(0)).collect() == []
    nothing = mixing.mix(spark.createDataFrame([(1, "a", 0), (2, None, None)], "doc_id long, source string, size long")).collect()
    assert [(r.source_size, r.target, r.taken) for r in nothing] == [(0, 0.0, 0)] * 2


def test_targets_share_again_what_exceeds_a_limit(spark):
    sizes = {"a": 10, "b": 1000, "c": 3, None: 500, "d": 2000}
    rows = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes.items())], "doc_id long, source string, size long")
    got = {r.source: r.target for r in mixing.mix(rows).collect()}
    for source, want in brute.targets(sizes).items():
        assert got[source] == pytest.approx(float(want))


def test_toxicity(spark, docs):
    rows = [(i, f"{PROSE} {('you idiot', 'such a moron')[i % 2] if i % 3 == 0 else 'kind people'} number{i}.") for i in range(60)] + [(99, None), (None, "idiot")]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(99, 1), (None, 1), (5, None), (7, 0), (7, 0)], "doc_id long, toxic int")
    model = toxicity.learn(texts, labels)
    found = {r.doc_id: r for r in toxicity.score(texts.where("doc_id < 60"), model, out="score").collect()}
    assert all((r.score >= 0.5) == (i % 3 == 0) for i, r in found.items())
    spelt = spark.createDataFrame([(s,) for s in ("you id-iot. Such an idxiot, mor0n", "an i d i o t and a m o r o n", "a kind person", "", None)], "text string")
    scores = [r.toxicity for r in toxicity.score(spelt, model).collect()]
    assert min(scores[:2]) > max(scores[2:]) and scores[0] > 5 * scores[2]
    clashing = toxicity.score(docs, model, out="words")
    assert clashing.columns == docs.columns and clashing.count() == len(ROWS)
    assert toxicity.learn(texts, labels.limit(0)) is None
    assert toxicity.learn(texts, labels.where("toxic = 0")) is None
    assert {r.toxicity for r in toxicity.score(docs, None).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_line_dedup(docs, spark):
    found = line_dedup.dedup_lines(docs)
    assert found.columns == [*docs.columns, "kept_text", "removed_words"]
    rows = found.collect()
    assert len(rows) == len(ROWS)
    assert sorted(str(r.kept_text) for r in rows if r.text in (None, "", " \n\t ")) == sorted(["None", "None", "", " \n\t "])
    # The row without an id comes first, so both twins lose what it has.
    assert [r.kept_text for r in rows if r.doc_id is None and r.text] == [PROSE + " More words follow here."]
    assert [r.kept_text for r in rows if r.text == PROSE] == ["", ""]
    assert line_dedup.dedup_lines(docs.limit(0)).collect() == []
    for text in ("", " ", "a\n\n b.  c! d\n\n", "\n x.\ty. z", "a. b. c."):
        assert "".join(r[0] for r in spark.createDataFrame([(text,)], "t string").select(F.explode(line_dedup.pieces_of(F.col("t")))).collect()) == text


def test_decontamination(docs, items):
    found = decontaminate.decontaminate(docs, items).collect()
    assert len(found) == len(ROWS)
    want = {}
    for r in ROWS:
        n, hit, ids = brute.contamination(r[1], [(1, "the cat sat on the mat while a dog ran past the old house"), (4, "dog ran"), ("None", "It was raining")])
        want[(n, hit)] = [i for i in ids if i != "None"]
    assert {(r.n_words, r.n_hit): r.item_ids for r in found} == want
    kept = decontaminate.without_contaminated(docs, items)
    assert kept.columns == docs.columns and {r.text for r in kept.collect()} == {r[1] for r in ROWS if not (r[1] or "").startswith(PROSE)}
    assert decontaminate.decontaminate(docs.limit(0), items).collect() == []
    assert {r.n_hit for r in decontaminate.decontaminate(docs, items.limit(0)).collect()} == {0}


def extracted(*pages):
    whole = None
    for page in pages:
        one = wrapper_of(parse(page))
        whole = html_main.merge(whole, one) if whole else one
    rule = rules(whole)
    return ["\n\n".join(main_blocks(parse(p), rule, [])) for p in pages]


def test_pages(spark):
    rows = [(1, "http://h/1", "<article><p>a&nbsp;b &amp; c<br>d<p>e</article>"), (2, None, None), (3, "", ""), (4, "HTTP://H/2", "no tags < at all > 1"), (1, "http://h/1", "<article><p>x</p></article>")]
    pages = spark.createDataFrame([(*r, "t", "r") for r in rows], "page_id long, url string, html string, host string, rule string")
    found = html_main.extract_main(pages)
    assert found.columns == [*pages.columns, "text"]
    got = {(r.page_id, r.html): r.text for r in found.collect()}
    assert got[1, rows[0][2]] == "a b & c d\n\ne" and got[2, None] == "" and got[3, ""] == "" and got[1, rows[4][2]] == "x"
    assert html_main.extract_main(pages.limit(0)).collect() == []


def test_page_furniture_is_left_out():
    def page(title, body, extra=""):
        return (
            f"<html><head><title>{title}</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><ul class='main-menu'><li><a href=/>Home</a></li></ul>"
            f"<div id='cookie-notice'><p>We use cookies</p></div><main><h1>{title}</h1>{body}<p>Sign up for our letter today</p>{extra}"
            "<form><p>Name</p><input><button>Go</button></form><script>var a='<p>no</p>'</script></main>"
            "<aside><p>About us</p></aside><div class='comments'><p>Great post!</p></div><footer>(c)</footer></body></html>"
        )

    pages = [page(f"Title {i}", "".join(f"<p>Paragraph {i}.{j} of the <b>text</b></p>" for j in range(2 + i % 3)), "<div class='AdBanner'>Buy</div>" if i % 2 else "") for i in range(12)]
    for i, text in enumerate(extracted(*pages)):
        assert text == "\n\n".join([f"Title {i}"] + [f"Paragraph {i}.{j} of the text" for j in range(2 + i % 3)])


def test_page_without_an_article_element():
    def page(i):
        return f"<body><div class=nav><a href=/>Home</a></div><div class=wrap><div class=x><h2>Head {i}</h2><p>First {i} text of some length here</p><p>Second {i}</p></div><ul><li><a href=/{i}>rel {i}</a><li><a href=/b{i}>rel b {i}</a></ul></div></body>"

    assert extracted(*[page(i) for i in range(3)])[1] == "Head 1\n\nFirst 1 text of some length here\n\nSecond 1"


@pytest.mark.parametrize("page", ["<", "<p", "<p>a<!-- b", "<p>a</", "<script>x", "<article>a<p title='>b", "<a " * 5_000, "<div>" * 900 + "x", "<p>a &am", "a<b>c</p></i>d"])
def test_broken_markup(page):
    assert isinstance(extracted(page)[0], str)
