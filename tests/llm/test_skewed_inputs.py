"""Copies, clashing names, long runs, wide hosts, executors without this folder."""

import os
import random
import subprocess
import sys
import textwrap
import time

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tests.llm.test_html_whole import extracted
from tidemark.llm import fertility, html_main, jaccard, langid, mixing, pii, toxicity
from tidemark.llm.html_main import main_blocks, merge, rules, wrapper_of
from tidemark.llm.html_tree import parse

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_a_text_repeated_often_teaches_its_language(spark):
    copies = [(i, "zorp blik kwam zunda", "xx") for i in range(6000)]
    others = [(10_000 + i, f"the quick brown fox number {'abcdefghij'[i % 10]} jumps over the lazy dog", "en") for i in range(200)]
    model = langid.learn(spark.createDataFrame(copies + others, "doc_id long, text string, lang string"))
    assert {"zorp", "fox"} <= set(model.words)
    assert model.predict("zorp blik kwam zunda", {})[0] == "xx" and model.predict("the lazy dog", {})[0] == "en"


def test_the_sample_of_texts_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "_logs", lambda rows, languages: seen.append(rows) or ({}, None))
    rows = [(f"{'abcdefgh'[i % 8]}{'abcdefgh'[i // 8 % 8]}{'abcdefgh'[i // 64 % 8]}", "xx") for i in range(512)] * 40
    langid.learn(spark.createDataFrame(rows, "text string, lang string"), rows_per_language=100)
    # Every text is one word; drawn texts count once however often they occur.
    assert 60 <= len(seen[0]) <= 150 and all(r["n"] == 1 for r in seen[0])


def test_numerals_are_no_letters(spark):
    model = langid.LanguageModel(["de"], {"abc": 0}, {}, __import__("numpy").zeros((1, 1)), None)
    for text in ("½ ² Ⅷ", "٣٤", "一 1", "12_3", "①"):
        assert (model.predict(text, {})[0] == "und") == (text != "一 1")


def test_mixing_leaves_columns_of_any_name(spark):
    rows = [(i, 10, "a", i, "s", i * 2, "t", 1.5, "n", "p") for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, size long, source string, _key long, _size string, _start long, Taken string, target double, given string, `of.place` string")
    got = mixing.mix(df)
    assert got.columns == ["doc_id", "size", "source", "_key", "_size", "_start", "given", "of.place", "source_size", "target", "taken"]
    assert sorted((r["_key"], r["_size"], r["_start"], r["given"], r["of.place"]) for r in got.collect()) == sorted((i, "s", i * 2, "n", "p") for i in range(20))
    assert {r.doc_id: r.taken for r in got.collect()} == brute.mix([(i, "a", 10) for i in range(20)])


def test_a_label_of_many_documents_is_sampled_once(spark, monkeypatch):
    docs = [(i % 260 if i < 260 else 7, f"text {i} with {'awful slimeball' if i % 2 else 'some kindness'} in it.") for i in range(2760)]
    labels = [(i, i % 2) for i in range(260)]
    counted = []
    monkeypatch.setattr(toxicity, "_landmark_words", lambda sample, n: counted.append(sample.count()) or [])
    toxicity.learn(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic long"))
    assert counted == [260]


def test_long_runs_are_cut_like_the_whole_text():
    known = fertility.Vocabularies(fertility.TOKENIZERS)
    prose = "An ordinary sentence, extraordinarily uncut. " * 300
    long = random.Random(3).choices("abcdefghij", k=30_000)
    for text in ("x" * 10_001 + " " + prose, prose + "".join(long) + prose, "a" + " " * 12_000 + "b c", "a" + "\n" * 30_000, " " * 11_000 + "　x", prose + "\t" * 20_000 + " " + prose):
        assert known.tokens(text).tolist() == known.encoding.encode_ordinary(text)
    assert len(known.tokens("a " + " " * 3_000_000 + "b")) > 100


def test_redacting_many_spans_is_linear(spark):
    n = 20_000
    df = pii.find_pii(spark.createDataFrame([("ab@c.de " * n,)], "text string"))
    start = time.time()
    assert df.select(pii.redact(F.col("text"), F.col("pii")).alias("t")).first().t == "<email> " * n
    assert time.time() - start < 20


def whole(pages):
    wrapper = None
    for page in pages:
        one = wrapper_of(parse(page))
        wrapper = merge(wrapper, one) if wrapper else one
    return rules(wrapper)


@pytest.mark.parametrize("n", [1, 2, 5, 9, 2000])
def test_the_number_of_pages_decides_nothing(n):
    pages = [f"<body><nav><a href=/>Home</a></nav><article><h1>One title</h1><p>One paragraph</p><p>Line {i}</p></article></body>" for i in range(n)]
    rule = whole(pages)
    for i in {0, n - 1}:
        assert "\n\n".join(main_blocks(parse(pages[i]), rule, [])) == f"One title\n\nOne paragraph\n\nLine {i}"


@pytest.mark.parametrize(
    ("inside", "text"),
    [
        ('<h2 id="related-work">Related work</h2><p>x</p>', "Related work\n\nx"),
        ('<h2 id="search-methods" class="banner">Search</h2><p>x</p>', "Search\n\nx"),
        ('<section id="menu-planning"><p>Menus</p></section>', "Menus"),
        ('<section id="discussion"><h2>Discussion</h2><p>x</p></section>', "Discussion\n\nx"),
        ('<p>x</p><div class="related-posts"><p>more</p></div><div class="ad">buy</div><div id="comments"><p>Great!</p></div>', "x"),
        ('<p>x</p><div id="sidebar"><p>More</p></div><p id="footer">y</p><h3 id="comments">Comments</h3><section id="sidebar-and-main"><p>z</p></section>', "x\n\ny\n\nComments\n\nz"),
        ('<div class="search-results-explained"><p>x</p></div><div class="AdBanner">buy</div>', "x"),
    ],
)
def test_names_inside_articles(inside, text):
    assert extracted(f"<body><article><h1>T</h1>{inside}</article></body>") == f"T\n\n{text}"


def test_a_page_with_a_sidebar_in_its_name_is_read():
    assert extracted('<body class="with-sidebar"><div id="page-with-sidebar"><p>Text</p></div><div id="sidebar"><p>no</p></div></body>') == "Text"


def test_wrappers_of_wide_hosts_stay_small():
    rnd = random.Random(5)
    tags = ["p", "div", "section", "blockquote", "table", "pre", "ul", "h2"]
    pages = []
    for i in range(1200):
        body = "".join(f"<{(t := rnd.choice(tags))} class='{'abcdefgh'[rnd.randrange(8)]}x'>text {i}.{j}</{t}>" for j in range(40))
        pages.append(f"<body><article>{body}</article></body>")
    times, wrapper = [], None
    for part in (pages[:600], pages[600:]):
        start = time.time()
        for page in part:
            one = wrapper_of(parse(page))
            wrapper = merge(wrapper, one) if wrapper else one
        times.append(time.time() - start)
    assert times[1] < 2.5 * times[0]
    rule = rules(wrapper)
    assert len(rule["k"][0]["k"][0]["k"]) <= html_main.PLACES
    for i in (0, 700, 1199):
        assert "\n\n".join(main_blocks(parse(pages[i]), rule, [])) == "\n\n".join(f"text {i}.{j}" for j in range(40))


def test_pages_without_a_host_do_not_meet(spark):
    rows = [(i, None if i % 2 else "no url", f"<body><article><p>Same</p><p>{i}</p></article></body>") for i in range(30)]
    found = html_main.extract_main(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in found.collect()} == {i: f"Same\n\n{i}" for i in range(30)}
    assert html_main.wrappers(spark.createDataFrame(rows, "page_id long, url string, html string")).count() == 0


def test_blocks_of_a_large_component_meet_where_sizes_allow(spark, monkeypatch):
    """One chain of texts that grow from 20 to some 300 words, with copies, in blocks of at most five documents."""
    rnd = random.Random(12)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(320)]
    docs = [(i, " ".join(words[: 20 + 5 * i])) for i in range(60)] + [(100 + i, " ".join([*words[: 40 + 9 * i], "tail"])) for i in range(25)]
    docs += [(200 + i, docs[i][1]) for i in range(0, 60, 7)]
    monkeypatch.setattr(jaccard, "BLOCK_DOCS", 5)
    found = jaccard.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in found} == brute.jaccard(docs)


def test_executors_need_not_have_this_folder(tmp_path):
    """Run from another folder: workers get what they need with the job."""
    code = f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        import __spark_entry__ as entry
        spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate()
        for name in ("op2_langid", "op8_toxicity", "op12_spelling", "op13_prefix_trie"):
            assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0, name
        print("all ran")
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in done.stdout, done.stderr[-3000:]
