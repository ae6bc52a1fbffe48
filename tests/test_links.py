from tidemark import discover_releases, extract_links

SITE = "https://s.org"


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id INT, html STRING")


def test_excluded_first_mention_does_not_hide_a_later_one(spark):
    page = pages(
        spark,
        '<a href="/x.PDF?a=1">Refugee list</a><a href="/x.PDF?a=1">Totals</a><a href="/x.PDF?a=1">Again</a>'
        '<a href="/y.html">no file</a><a href="d/z.zip">Z</a>',
    )
    got = extract_links(page, SITE).select("url", "filename", "title").collect()
    assert sorted(map(tuple, got)) == [(f"{SITE}/d/z.zip", "z.zip", "Z"), (f"{SITE}/x.PDF?a=1", "x.pdf", "Totals")]


def test_same_url_on_two_pages_counts_twice(spark):
    page = '<a href="/x.pdf">x</a>'
    assert extract_links(pages(spark, page, page), SITE).count() == 2


def test_precedence_of_release_links(spark):
    page = pages(
        spark,
        '<a href="/t/1">Yearbook 2004 to 2005</a><a href="/yearbook/2004">a</a><a href="/b/yearbook/2004-2005/">b</a>'
        '<a href="/t/2">Yearbook&nbsp;2006</a><a href="/t/3">the yearbook  2006</a>'
        '<a href="/yearbook/2021?x">no year</a><a href="/yearbook/2021">y</a><a href="/other">Yearbook2022</a>',
    )
    got = discover_releases(page, f"{SITE}/index").orderBy("year").select("year", "url").collect()
    assert list(map(tuple, got)) == [
        (2004, f"{SITE}/b/yearbook/2004-2005/"), (2006, f"{SITE}/t/2"), (2021, f"{SITE}/yearbook/2021"),
    ]


def test_a_long_list_of_releases_is_joined_to_the_links(spark, monkeypatch):
    from tidemark.plans import ledger_run

    index = spark.createDataFrame(
        [(0, f"{SITE}/i", '<a href="/r/yearbook/2001">a</a><a href="/t">Yearbook 2002</a>')], "page_id INT, url STRING, html STRING"
    )
    body = '<a href="/x.pdf">x</a><a href="/x.pdf">later</a>'
    crawled = spark.createDataFrame(
        [(1, f"{SITE}/r/yearbook/2001", body), (2, f"{SITE}/t", body + '<a href="/y.zip">y</a>'), (3, f"{SITE}/no", body)],
        "page_id INT, url STRING, html STRING",
    )
    short = ledger_run.links_of_crawl(index, crawled, f"{SITE}/i", SITE).select("period", "url", "title").collect()
    monkeypatch.setattr(ledger_run, "fits", lambda df: False)
    long = ledger_run.links_of_crawl(index, crawled, f"{SITE}/i", SITE).select("period", "url", "title").collect()
    assert sorted(map(tuple, short)) == sorted(map(tuple, long)) == [
        ("2001", f"{SITE}/x.pdf", "x"), ("2002", f"{SITE}/x.pdf", "x"), ("2002", f"{SITE}/y.zip", "y"),
    ]


def test_every_page_is_read_by_one_meaning(spark):
    """The expressions and the parser agree; what they could not agree on goes to the parser."""
    from tidemark.functions.html import _AnchorReader
    from tidemark.operators.links import CATEGORY_HEADER, page_anchors

    rare = "&copy;"
    kinds = [
        '<template><a href="x.pdf">T</a></template>', "<a href>Yearbook 2003</a>", '<a href="">e</a>', '<a class="c" href>b</a>', "<A HREF=x.pdf>up</A>",
        '<textarea><a href="t.pdf">t</a></textarea><a href="u.pdf">u</a>', '<a href="v.pdf">v<template>hidden</template></a>',
        '<table><tr><td headers="view-field-data-categories-table-column">Cat</td><td><a href="r.pdf">r</a></td></tr></table>',
        "<table><tr><td><table><tr><td><a href='n.pdf'>n</a></td></tr></table></td></tr></table>", '<a href="q.pdf" title="href">q</a>',
    ]
    rows = [k + extra for k in kinds for extra in ("", rare)]
    found = {}
    for r in page_anchors(pages(spark, *rows), ["page_id"]).collect():
        found.setdefault(r["page_id"], []).append((r["pos"], r["href"], r["title"], r["category"]))
    for i, row in enumerate(rows):
        want = [(n, a["href"], a["title"], a["category"]) for n, a in enumerate(_AnchorReader(CATEGORY_HEADER).anchors(row))]
        assert sorted(found.get(i, [])) == want, row


def test_missing_pages_have_no_anchors(spark):
    from tidemark.operators.links import page_anchors

    assert page_anchors(spark.createDataFrame([(1, None), (2, "")], "page_id INT, html STRING"), ["page_id"]).count() == 0
