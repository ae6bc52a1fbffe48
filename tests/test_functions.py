import re
from pathlib import PurePosixPath
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from tidemark.functions import html as H
from tidemark.functions.names import folder_of_archive, stem, stored_name, suffix, versioned_name, year_in_name
from tidemark.functions.text import WHITESPACE, strip, to_long
from tidemark.functions.url import resolve_url, url_path

HREFS = [
    "/s/a.pdf", "s/a.pdf", "../a.pdf", "../../../a.pdf", "./b/../c.zip", "//h/a.pdf", "https://h/a.pdf?x=1#f", "?q=1",
    "#f", "", "/x y/ü.pdf", "/d/", "mailto:a@b", "d/..", "d/.", "/a/../b//c", "a//b", "https:foo", "HTTPS://H/x/../y",
    "//h", "//h?x", "/a.pdf;v=1", "a;x/b.pdf;y;z", "/..", ".", "http://x.y", "/a/./b/.", "1:b", "a?x/../y", "/a?b?c#d#e",
    "/a#", "/a?", " /a\n.pdf", "/a'b\\c.pdf",
]
BASES = ["https://ex.org", "https://ex.org/t/i/yearbook", "https://ex.org/t/i/y/?a=b#z", "http://ex.org/a//b/c"]


@pytest.mark.parametrize("literal", [True, False])
def test_urls_resolve_like_the_standard_library(spark, literal):
    for base in BASES:
        frame = spark.createDataFrame([(base, h) for h in HREFS], "base STRING, href STRING")
        url = resolve_url(base, "href", True) if literal else resolve_url("base", "href")
        got = [tuple(r) for r in frame.select("href", F.expr(url)).collect()]
        assert got == [(h, urljoin(base, h)) for h in HREFS]


def test_url_path(spark):
    frame = spark.createDataFrame([(h,) for h in HREFS], "href STRING")
    assert [r[0] for r in frame.select(F.expr(url_path("href"))).collect()] == [urlparse(h).path for h in HREFS]


def test_strip_and_numbers(spark):
    texts = [f"{WHITESPACE}a b{WHITESPACE}", "", " ", "x", " y ", "​z"]
    frame = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert [r[0] for r in frame.select(strip(F.col("t"))).collect()] == [t.strip() for t in texts]
    numbers = spark.createDataFrame([(" 12 ",), ("",), ("1.5",), ("n/a",), (None,)], "t STRING")
    assert [r[0] for r in numbers.select(to_long(F.col("t"))).collect()] == [12, None, None, None, None]


def test_file_names(spark):
    names = ["a.pdf", "a.tar.gz", ".hidden", "noext", "a.b.c", "x."]
    frame = spark.createDataFrame([(n,) for n in names], "n STRING")
    got = frame.select(stem(F.col("n")), suffix(F.col("n"))).collect()
    assert [tuple(r) for r in got] == [(PurePosixPath(n).stem, PurePosixPath(n).suffix) for n in names]


def test_stored_and_versioned_names(spark):
    urls = ["https://h/a.pdf", "https://h/d/a.b.zip?x=1", "https://h/noext", "https://h/x/", "?q"]
    frame = spark.createDataFrame([(u,) for u in urls], "u STRING").select(
        stored_name(F.col("u"), F.lit("2020")).alias("n")
    )
    got = [tuple(r) for r in frame.select("n", versioned_name(F.col("n"), F.lit(3))).collect()]
    assert got == [
        ("a.pdf", "a.v3.pdf"), ("a.b.zip", "a.v3.b.zip"), ("noext", "noext.v3"), ("x", "x.v3"), ("2020.bin", "2020.v3.bin"),
    ]


def test_folder_of_archive(spark):
    frame = spark.createDataFrame([("/d/a.zip",), ("/d/a.ZIP",), ("/d/.zip",), ("/d/a.pdf",)], "p STRING")
    assert [r[0] for r in frame.select(folder_of_archive(F.col("p"))).collect()] == ["/d/a", "/d/a", None, None]


def test_year_in_name(spark):
    names = [
        "statyearbk96_0.pdf", "1997_table.xls", "table-97.xls", "yb1998.pdf", "31996.pdf", "table_98_1996.pdf", "a1997b", "2096", "x",
    ]
    frame = spark.createDataFrame([(n,) for n in names], "n STRING")
    loose, strict = (frame.select(F.expr(year_in_name("n", strict=s))).collect() for s in (False, True))
    assert [r[0] for r in loose] == [1996, 1997, 1997, 1998, None, 1996, 1997, None, None]

    def expected(name):
        hit = re.search(r"19(96|97|98|99)\b", name) or re.search(r"\b(96|97|98|99)\b", name)
        return 1900 + int(hit.group(1)) if hit else None

    assert [r[0] for r in strict] == [expected(n) for n in names]


PAGES = [
    ('<table><tr><td headers="x">Cat</td><td><a href="/a.pdf">T <b>b</b> c</a></td></tr>'
     "<TR><TD HEADERS='y x'> Other&amp;x </TD><td><A HREF=/b.xls>u&nbsp;</A><a name=q>no</a></td></TR></table><a href=z>out</a>",
     False, [("/a.pdf", "Tbc", "Cat"), ("/b.xls", "u", "Other&x"), ("z", "out", "")]),
    ('<tr><td><table><tr><td><a href="/in.pdf">in</a></td></tr></table></td><td headers="x">Outer</td>'
     '<td><a href="/o.pdf">o</a></td></tr>', True, [("/in.pdf", "in", ""), ("/o.pdf", "o", "Outer")]),
    ('<tr><td headers=x>Caf&eacute;</td><td><a href="/a?x=1&amp;y=2">A&#233;B</a></td></tr>', True,
     [("/a?x=1&y=2", "AéB", "Café")]),
    ('<!-- <a href="no">n</a> --><script>"<a href=no>x</a>"</script><a href=" ok ">ok<br>fine</a>', False, [("ok", "okfine", "")]),
    ("<a href=u>un<p>closed", True, [("u", "unclosed", "")]),
    ('<a href="a" title="href=b">t</a><a data-href="d" href="r">k</a>', True, [("a", "t", ""), ("r", "k", "")]),
    ('<a href="x>text</a> and "more</a>', True, [("x>text</a> and", "", "")]),
    ("<a href=a></a>", False, [("a", "", "")]),
    ("no links", False, []),
    ("", False, []),
]


def test_anchors_of_odd_and_plain_pages(spark):
    frame = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PAGES)], "id INT, html STRING")
    cut = frame.withColumn("s", F.expr(H.page_segments("html", "x")))
    read = cut.select(
        "id", F.expr(H.needs_parser("html", "s")), F.expr(H.plain_anchors("s")), H.parsed_anchors(F.col("html"), "x")
    ).orderBy("id")
    for (_, odd, expected), row in zip(PAGES, read.collect()):
        assert row[1] == odd
        assert [tuple(a) for a in row[3]] == expected
        if not odd:
            assert [tuple(a) for a in row[2]] == expected


def test_both_ways_agree_on_real_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    cut = pages.withColumn("s", F.expr(H.page_segments("html", "x")))
    both = cut.select(
        F.expr(H.needs_parser("html", "s")).alias("odd"), F.expr(H.plain_anchors("s")).alias("a"), H.parsed_anchors(F.col("html"), "x").alias("b")
    )
    assert both.where("NOT odd AND a <> b").count() == 0
    assert both.where("NOT odd").count() > 0
