"""Main text of pages by union-free wrappers of their hosts.

A page is a nested stream of block tags and texts. Neighbouring groups of equal tags in it become
repeated groups. The streams of one host are aligned one after the other: tags that only some
pages have become optional groups, texts that differ become slots, texts that never differ stay
part of the template. Pages of a host that keep their text in different kinds of places have a
wrapper each, which says which of its places hold the article: the template
says where menus, adverts and footers are, the slots where the pages differ. Every page of a
host takes part: partial wrappers are made where the pages lie, and only these are shuffled
and merged, in two steps. Then the pages are read again and matched to their wrapper.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free_name
from tidemark.llm.html_tree import Block, parse
from tidemark.session import materialise

# Elements that are no article, elements that take a caption, words of what is one (fixed values).
_NO_ARTICLE_TAGS = frozenset("nav footer aside form head menu dialog button search fieldset".split())
_ARTICLE_MARKS = frozenset(
    """ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner
    nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer topbar masthead toolbar
    cookie cookies consent gdpr notice notices alert popup modal overlay
    share sharing social related recommended recommendations newsletter subscribe subscription signup login search
    comment comments commentlist respond replies reply disqus discussion
    pagination pager widget copyright contentinfo complementary banneritem""".split()
)
_FORMS = frozenset("form fieldset search button".split())
_ARTICLE_MARKS = frozenset("articlebody article story post entry content main".split())

SALT = 32  # partial wrappers of a host are merged in so many groups first
TEMPLATE_CHARS = 300  # a longer text is never the template's
# Places of one row in a wrapper; beyond that those of the fewest pages are left out. A block
# without a place is judged by its own page.
PLACES = 200


def _node(sign: str) -> dict:
    """A place in a wrapper: sign, pages, repeated, text (`h`: hash if all pages agree, 0 if they
    differ, absent if there is none), texts that every page has there (`q`), characters,
    characters in links, places inside."""
    return {"s": sign, "n": 0, "r": 0, "c": 0, "l": 0, "k": []}


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=6).digest(), "big") or 1


def _groups(signs: list[str]) -> list[tuple[str, list[list[int]]]]:
    """Repeated groups in a row of signs: (sign, occurrences), where an occurrence lists places.

    First runs of one sign are joined, then runs of two or three signs that repeat.
    """
    runs: list[tuple[str, list[list[int]]]] = []
    for i, sign in enumerate(signs):
        if runs and runs[-1][0] == sign:
            runs[-1][1].append([i])
        else:
            runs.append((sign, [[i]]))
    for width in (2, 3):
        out, i = [], 0
        while i < len(runs):
            unit = [r[0] for r in runs[i : i + width]]
            end = i + width
            while len(unit) == width and [r[0] for r in runs[end : end + width]] == unit:
                end += width
            if end > i + width:
                rounds = [[p for r in runs[j : j + width] for o in r[1] for p in o] for j in range(i, end, width)]
                out.append((f"({' '.join(unit)})", rounds))
                i = end
            else:
                out.append(runs[i])
                i += 1
        runs = out
    return runs


def _inside(block: Block, places: list[int], blocks: list[Block]) -> Block:
    """A repeated group of several blocks, as a block of its own."""
    group = Block("()")
    group.parts = [blocks[p] for p in places]
    return group


def _occurrences(block: Block) -> list[tuple[str, list[Block]]]:
    """The groups of blocks inside a block, in order."""
    blocks = block.blocks()
    out = []
    for sign, rounds in _groups([b.sign for b in blocks]):
        if sign.startswith("("):
            out.append((sign, [_inside(block, places, blocks) for places in rounds]))
        else:
            out.append((sign, [blocks[p] for places in rounds for p in places]))
    return out


def wrapper_of(block: Block, sign: str = "") -> dict:
    """The wrapper of a single page."""
    node = _node(sign)
    node["n"] = 1
    own = block.own_text()
    if own:
        node["h"] = _hash(own)
        node["q"] = [node["h"]] if len(own) <= TEMPLATE_CHARS else []
        node["c"] = len(own)
        node["l"] = min(len(own), sum(len(p[0]) for p in block.parts if not isinstance(p, Block) and p[1]))
    for inner, blocks in _occurrences(block):
        place = wrapper_of(blocks[0], inner)
        for again in blocks[1:]:
            merge(place, wrapper_of(again, inner), same_page=True)
        place["n"], place["r"] = 1, int(len(blocks) > 1)
        node["k"].append(place)
    return node


def _aligned(a: list[str], b: list[str]) -> list[tuple[int | None, int | None]]:
    """Both rows of signs as one row of places in either, along a longest common subsequence."""
    if a == b:
        return [(i, i) for i in range(len(a))]
    # Row by row from the end, a bit for each place of `b`, counted from its end: a bit that is not
    # set says that the subsequence grows by one there.
    where: dict[str, int] = {}
    for j, sign in enumerate(reversed(b)):
        where[sign] = where.get(sign, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows = [full] * (len(a) + 1)
    for i in range(len(a) - 1, -1, -1):
        row = rows[i + 1]
        met = row & where.get(a[i], 0)
        rows[i] = ((row + met) | (row - met)) & full

    def best(i: int, j: int) -> int:
        """Length of the longest common subsequence of what follows in both."""
        rest = len(b) - j
        return rest - (rows[i] & ((1 << rest) - 1)).bit_count()

    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best(i + 1, j) >= best(i, j + 1):
            out.append((i, None))
            i += 1
        else:
            out.append((None, j))
            j += 1
    return out


def merge(wrapper: dict, other: dict, same_page: bool = False) -> dict:
    """Aligns `other` into `wrapper`, in place."""
    if "q" in wrapper and "q" in other:
        mine, theirs = set(wrapper["q"]), set(other["q"])
        wrapper["q"] = sorted(mine | theirs if same_page else mine & theirs)
    elif "q" in other or "q" in wrapper:
        wrapper["q"] = wrapper.get("q", other.get("q")) if same_page else []
    for key in ("n", "c", "l"):
        wrapper[key] += other[key]
    wrapper["r"] |= other["r"]
    if "h" in other:
        wrapper["h"] = other["h"] if wrapper.get("h", other["h"]) == other["h"] else 0
    mine, theirs = wrapper["k"], other["k"]
    if not mine:
        wrapper["k"] = theirs
    elif theirs:
        row = _aligned([k["s"] for k in mine], [k["s"] for k in theirs])
        places = [theirs[j] if i is None else mine[i] if j is None else merge(mine[i], theirs[j], same_page) for i, j in row]
        if len(places) > PLACES:
            most = sorted(range(len(places)), key=lambda i: (-places[i]["n"], i))[:PLACES]
            places = [places[i] for i in sorted(most)]
        wrapper["k"] = places
    return wrapper


def _name_and_marks(sign: str) -> tuple[str, set[str]]:
    name, *marks = sign.rstrip("!~^").split(".")
    return name, set(marks)


def _no_article(sign: str, in_article: bool) -> bool:
    name, marks = _name_and_marks(sign)
    flags = sign[len(sign.rstrip("!~^")) :]
    if "!" in flags or name in _NO_ARTICLE_TAGS:
        return True
    return "^" in flags if in_article else "~" in flags or name == "header" or "header" in marks


def _weight(node: dict) -> int:
    """Characters outside links in the places that may be the article's."""
    return node["c"] - node["l"] + sum(_weight(k) for k in node["k"] if not _no_article(k["s"], False))


def _tops(node: dict, wanted) -> list[dict]:
    """Outermost places that are `wanted` and hold text."""
    found = []
    for k in node["k"]:
        if _no_article(k["s"], False):
            continue
        found += [k] if wanted(*_name_and_marks(k["s"])) and _weight(k) else _tops(k, wanted)
    return found


_REGIONS = (
    lambda name, marks: name == "article" or "articlebody" in marks or {"article", "body"} <= marks,
    lambda name, marks: name == "main" or "main" in marks,
    lambda name, marks: bool(marks & _ARTICLE_MARKS),
)


def _bulk(root: dict) -> list[dict]:
    """The places from the root down to the one that has most of the text."""
    path = [root]
    while True:
        whole = _weight(path[-1])
        inner = [k for k in path[-1]["k"] if not _no_article(k["s"], False) and k["k"] and _weight(k) >= 0.85 * whole]
        if not inner or not whole:
            return path
        path.append(inner[0])


def _region(root: dict) -> list[dict]:
    """The places that hold the article: by element, else by name, else by where the text is."""
    for wanted in _REGIONS:
        if found := _tops(root, wanted):
            return found
    return _bulk(root)[-1:]


def template_of(page: dict) -> str:
    """Which template of its host a page has, from its own wrapper: the first kind of region that
    it has itself, else the way down to its text. Pages of one template have the same region, so
    that none is left without by what another one has."""
    for i, wanted in enumerate(_REGIONS):
        if _tops(page, wanted):
            return str(i)
    signs = " ".join(k["s"] for k in _bulk(page))
    return f"{len(_REGIONS)}.{_hash(signs):x}"


def _linked(node: dict) -> tuple[int, int]:
    """Characters inside, and those of them in links."""
    inner = [_linked(k) for k in node["k"]]
    return node["c"] + sum(c for c, _ in inner), node["l"] + sum(n for _, n in inner)


def _reduced(node: dict, inside: bool, kept: set[int], pages: int) -> dict:
    """What matching needs of a place. `pages` is the number of pages the wrapper stands for if
    their texts differ at all, else 0."""
    top = id(node) in kept
    inside = inside or top
    nothing = {"s": node["s"], "x": 0, "k": []}
    if inside and not top:
        chars, links = _linked(node)
        if _no_article(node["s"], True) or chars and links > 0.8 * chars and (node["r"] or any(k["r"] for k in node["k"])):
            return nothing
    out = [_reduced(k, inside, kept, pages) for k in node["k"]]
    if not inside and not any(k["x"] or k["k"] for k in out):
        return nothing
    rule = {"s": node["s"], "x": int(inside), "k": out}
    if inside and pages > 1 and node["n"] >= pages:
        # Texts that all pages have here: the template's, if they introduce a form.
        same = node.get("q", []) if node["r"] else [node["h"]] if node.get("h") and not node["k"] and node["c"] <= TEMPLATE_CHARS * node["n"] else []
        if same:
            rule["q"] = same
    return rule


def rules(root: dict) -> dict:
    """The wrapper reduced to what matching needs: sign, kept or not (`x`), places inside, and
    texts that every page has there (`q`)."""
    region = _region(root)

    def varies(node: dict) -> bool:
        return node.get("h") == 0 or any(varies(k) for k in node["k"])

    return _reduced(root, False, {id(node) for node in region}, root["n"] if any(varies(n) for n in region) else 0)


def _own_rule(block: Block, kept: int) -> dict:
    """The rule for a block of which the wrapper knows nothing, from the block itself."""
    if not kept:
        return {"s": "", "x": 0, "k": []}
    return _reduced(wrapper_of(block, block.sign), True, set(), 0)


def _placed(block: Block, rule: dict, places: dict[int, dict]) -> None:
    """The rules of the blocks inside a block or inside one round of a repeated group."""
    row = _occurrences(block)
    for i, j in _aligned([sign for sign, _ in row], [k["s"] for k in rule["k"]]):
        if i is None:
            continue
        for occurrence in row[i][1]:
            if occurrence.name == "()":
                _placed(occurrence, rule["k"][j] if j is not None else {"x": rule["x"], "k": []}, places)
            else:
                places[id(occurrence)] = rule["k"][j] if j is not None else _own_rule(occurrence, rule["x"])


def _captions(blocks: list[Block]) -> set[int]:
    """Blocks that stand directly before a form, adverts and the like left aside."""
    found, before = set(), None
    for block in blocks:
        if block.name in _FORMS:
            if before is not None:
                found.add(id(before))
            before = None
        elif not _no_article(block.sign, True):
            before = block
    return found


def main_blocks(block: Block, rule: dict, out: list[str]) -> list[str]:
    """Texts of a page's blocks that its host's wrapper keeps, in page order."""
    if not rule["x"] and not rule["k"]:
        return out
    places: dict[int, dict] = {}
    _placed(block, rule, places)
    captions = _captions(block.blocks())
    run: list[str] = []

    def flush() -> None:
        if run:
            if joined := " ".join("".join(run).split()):
                out.append(joined)
            run.clear()

    for part in block.parts:
        if isinstance(part, Block):
            flush()
            inner = places[id(part)]
            if not (id(part) in captions and inner.get("q") and _hash(part.own_text()) in inner["q"]):
                main_blocks(part, inner, out)
        elif rule["x"]:
            run.append(part[0])
    flush()
    return out


def host_of(url: Column) -> Column:
    """Lower-cased host and port of a URL; empty for null and for anything else."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*)", 1), F.lit("")))


def _key(host: str, page: dict) -> str:
    """Template and host; a template has no space in its name."""
    return f"{template_of(page)} {host}"


@F.pandas_udf(T.StringType())
def page_key(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Host and template of each page."""
    for hosts, pages in batches:
        yield pd.Series([_key(host, wrapper_of(parse(html or ""))) for host, html in zip(hosts, pages, strict=True)], dtype=object)


_PARTIAL = "host string, salt int, part int, wrapper string"


def _partial_wrappers(salt: int):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        found: dict[str, dict] = {}

        def rows() -> pd.DataFrame:
            return pd.DataFrame([(host, part % salt, part, json.dumps(w)) for host, w in found.items()], columns=["host", "salt", "part", "wrapper"])

        for batch in batches:
            for host, html in zip(batch["host"], batch["html"], strict=True):
                if not host:
                    continue
                page = wrapper_of(parse(html or ""))
                host = _key(host, page)
                found[host] = merge(found[host], page) if host in found else page
            if len(found) > 5_000:  # many hosts in one file: what is there may go
                yield rows()
                found = {}
        yield rows()

    return read


def _merged(group: pd.DataFrame) -> dict:
    whole = None
    for text in group.sort_values(["part", "wrapper"])["wrapper"]:
        one = json.loads(text)
        whole = merge(whole, one) if whole else one
    return whole


def _merge_salted(group: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"host": group["host"].iloc[:1], "salt": group["salt"].iloc[:1], "part": [0], "wrapper": [json.dumps(_merged(group))]})


def _host_rules(group: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"host": group["host"].iloc[:1], "rule": [json.dumps(rules(_merged(group)))]})


def wrappers(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`host`, a host's template as in `page_key`, and `rule`, its wrapper reduced to what it keeps."""
    rows = pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
    partial = rows.mapInPandas(_partial_wrappers(SALT), _PARTIAL)
    salted = partial.groupBy("host", "salt").applyInPandas(_merge_salted, _PARTIAL)
    return salted.groupBy("host").applyInPandas(_host_rules, "host string, rule string")


@F.pandas_udf(T.StringType())
def main_text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    known: dict[str, dict] = {}
    for pages, rule_texts in batches:
        out = []
        for html, rule in zip(pages, rule_texts, strict=True):
            if rule is None:
                tree = parse(html or "")
                out.append("\n\n".join(main_blocks(tree, rules(wrapper_of(tree)), [])))
                continue
            if rule not in known:
                if len(known) >= 1_000:
                    known.clear()
                known[rule] = json.loads(rule)
            out.append("\n\n".join(main_blocks(parse(html), known[rule], [])) if html else "")
        yield pd.Series(out, dtype=object)


def extract_main(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """`pages` with `out`: the main text of each page, its blocks joined by an empty line.

    Character references are decoded; white space inside a block becomes one space. Null and
    empty pages, and pages without an article, give an empty text. Pages of any length are read
    whole. A page with a null or unreadable URL is wrapped by itself alone. The pages of a host are
    told apart by the kind of place that holds their own text, and each kind has a wrapper. Inside
    the article only hidden blocks, elements and whole classes that say so, lists of links, and a
    text before a form that all pages have there, are left out, however many pages there are. Repeated rows get equal texts; an empty table stays empty; a column
    already called `out` is replaced, all others are kept. The wrappers are written to the
    shared folder, so Spark knows their size when it joins them by host.
    """
    found = materialise(wrappers(pages, url, html))
    host, rule = free_name(pages, "host"), free_name(pages, "rule")
    keyed = pages.withColumn(host, page_key(host_of(F.col(url)), F.col(html)))
    found = found.select(F.col("host").alias(f"other_{host}"), F.col("rule").alias(rule))
    rows = keyed.join(found, keyed[host] == found[f"other_{host}"], "left")
    names = [c for c in pages.columns if c.lower() != out.lower()]
    return rows.select(*[keyed[c] for c in names], main_text(keyed[html], F.col(rule)).alias(out))
