"""Nothing of a page is lost by broken markup, depth, width or what else its host has."""

import random

import pytest

from tidemark.llm import html_main
from tidemark.llm.html_main import main_blocks, rules, wrapper_of
from tidemark.llm.html_tree import parse


def extracted(page):
    tree = parse(page)
    return "\n\n".join(main_blocks(tree, rules(wrapper_of(tree)), []))


@pytest.mark.parametrize(
    "page, text",
    [
        ('<p class="x"">Hello</p><p>rest of article</p>', "Hello\n\nrest of article"),
        ("<p><img alt='it's here'>text that follows</p><p>don't lose me</p>", "text that follows\n\ndon't lose me"),
        ('<p title="a > b">one</p><p>two', "one\n\ntwo"),
        ("<p>one <svg/>two</p><math /><p>three</p>", "one two\n\nthree"),
        ("<p>one</p><select><p>two</p><p>three</p>", "one\n\ntwo\n\nthree"),
        ('<p>a</p><x y=">" <p z=">">c</p><p>b</p>', "a\n\nc\n\nb"),
        ('<p>a</p><i y=">" <p>c', "a\n\nc"),
        ("<p>one</p><p>two <a href=", "one\n\ntwo"),
        ("<p>one</p><script>var a = 1;", "one"),
        ("<p>1 <2</p>", "1 <2"),
    ],
)
def test_broken_tags(page, text):
    assert extracted(page) == text


def test_endless_tags_are_read_in_linear_time():
    assert "end" in extracted('<p>a</p><i x=">" ' * 1 + '<i x=">" ' * 100_000 + "<p>end")
    assert extracted("<template>" * 100_000 + "<p>end") == "end"


def test_deep_blocks_close_themselves():
    page = "<div>" * 94 + "<article><p>first</p>" + "<div>" * 10 + "deep" + "</div>" * 10 + "<p>rest of the article</p></article>" + "</div>" * 94 + "<p>outside</p>"
    assert extracted(page) == "first\n\ndeep\n\nrest of the article"


def plain_alignment(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out


@pytest.mark.parametrize("size", [0, 1, 5, 60, 450])
def test_rows_are_aligned_alike_at_every_width(size):
    deal = random.Random(size)
    a, b = (["pdas"[deal.randrange(4)] for _ in range(size + extra)] for extra in (0, 7))
    assert html_main._aligned(a, b) == plain_alignment(a, b)
    assert html_main._aligned(b, a) == plain_alignment(b, a)


def test_each_page_of_a_host_is_read_by_its_own_kind(spark):
    bodies = [("article", "<article>", "</article>", 1), ("div", "<div class=content>", "</div>", 20), ("main", "<main>", "</main>", 3), ("plain", "<div class=a><div class=b>", "</div></div>", 9), ("other", "<section><div>", "</div></section>", 2)]
    rows = []
    for kind, begin, close, n in bodies:
        for i in range(n):
            text = f"<p>First {kind} {i} with some words</p><p>Second {kind} {i}</p>"
            rows.append((f"{kind} {i}", None if i % 2 else "http://h/x", f"<body><nav><p>Menu</p></nav>{begin}{text}{close}<footer>(c)</footer></body>"))
    rows.append(("empty", "http://h/x", "<body></body>"))
    found = html_main.extract_main(spark.createDataFrame(rows, "name string, url string, html string").repartition(3)).collect()
    assert len(found) == len(rows)
    assert {r.name: r.text for r in found} == {name: "" if name == "empty" else f"First {name} with some words\n\nSecond {name}" for name, _, _ in rows}
