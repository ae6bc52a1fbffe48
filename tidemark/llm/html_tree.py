"""A page's markup as a tree of blocks, tolerant of unclosed and cut-off markup."""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is no text of the page.
RAW = frozenset("script style title textarea iframe noscript noframes noembed xmp template svg math object select".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
# An open element of the first kind ends where one of the second starts.
_P_ENDS = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split())
_ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])),
    "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "tbody": (frozenset(["thead", "tbody", "tr", "td", "th"]), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["datalist"])),
}

# Blocks nested deeper are read as siblings, each still a block of its own.
DEEPEST = 100

# A quote counts only where a value begins; any other is a character of the tag, which ends at its own ">".
_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>""")
_VALUE_OR_TAG = re.compile(r"""=\s*+(?:"[^"]*+"|'[^']*+')|<""")
# Of these the rest of the page is code if they have no end.
_CODE = frozenset(["script", "style"])
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_LETTERS = re.compile(r"[a-z]+")
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Words in a name of what is no article, and words that only say what kind of box it is (fixed values).
NO_ARTICLE_MARKS = frozenset(
    """ad ads advert adverts advertisement advertising adsbygoogle sponsor sponsored promo promotion banner
    nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer topbar masthead toolbar
    cookie cookies consent gdpr notice notices alert popup modal overlay
    share sharing social related recommended recommendations newsletter subscribe subscription signup login search
    comment comments commentlist respond replies reply disqus discussion
    pagination pager widget copyright contentinfo complementary banneritem""".split()
)
_BOX_WORDS = frozenset(
    """area bar block box btn button buttons container content element form group holder icons inline inner item items
    links list main nav outer panel post posts region row section site slot thread title top unit wrap wrapper""".split()
)
# Whole ids of boxes that are page furniture even inside what holds the article (fixed values).
_FURNITURE_IDS = frozenset("comments respond disqus disqus_thread sidebar footer navbar topbar masthead breadcrumb breadcrumbs".split())
_BOXES = frozenset("div section ul ol".split())
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)", re.I)
_NO_DISPLAY = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _is_furniture(name: str) -> bool:
    """Whether a whole class or id names what is no article: each of its words does, or says what
    kind of box it is. So `related-posts` does, `related-work` and `with-sidebar` do not."""
    words = _words(name)
    return bool(words & NO_ARTICLE_MARKS) and words <= NO_ARTICLE_MARKS | _BOX_WORDS


def _words(value: str) -> set[str]:
    return set(_LETTERS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", value).lower()))


class Block:
    """A block element: what it is called, its attributes' words, and texts and blocks in order.

    `flags` has "!" if it is hidden, "~" if its names say that it is no article, "^" if they say
    so even of a block inside the article: there ids name what a section is about, so that classes
    count and only a few ids of boxes do, and nothing speaks against a heading.
    """

    __slots__ = ("name", "marks", "flags", "parts")

    def __init__(self, name: str, marks: tuple[str, ...] = (), flags: str = ""):
        self.name, self.marks, self.flags = name, marks, flags
        self.parts: list = []  # Block, or (text, inside a link)

    @property
    def sign(self) -> str:
        return ".".join((self.name, *self.marks)) + self.flags

    def blocks(self) -> list[Block]:
        return [p for p in self.parts if isinstance(p, Block)]

    def own_text(self) -> str:
        return " ".join("".join(p[0] for p in self.parts if not isinstance(p, Block)).split())


def _block(name: str, attributes: str) -> Block:
    if not attributes.strip():
        return Block(name)
    marks, hidden = set(), bool(_HIDDEN.search(re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)))
    outside = inside = False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), next((v for v in values if v), "")
        if key in ("class", "id", "role", "itemprop"):
            marks |= _words(value)
            furniture = any(_is_furniture(n) for n in value.split())
            outside = outside or furniture
            inside = inside or furniture and key != "id" or key == "id" and name in _BOXES and value.strip().lower() in _FURNITURE_IDS
        elif key == "aria-hidden" and value.lower() == "true" or key == "style" and _NO_DISPLAY.search(value):
            hidden = True
    return Block(name, tuple(sorted(marks)), "!" * hidden + "~" * outside + "^" * (inside and name not in _HEADINGS))


def parse(html: str) -> Block:
    """The tree below a nameless root. Linear in the page.

    A tag cut off at the page's end is dropped, and so are a comment, a script and a style sheet
    without an end; any other "<" that begins no tag is text.
    """
    root = Block("")
    stack, linked, at = [root], False, 0
    endless: set[str] = set()  # elements of which no end tag follows
    no_tags: set[int] = set()  # where a tag begins that never ends
    deep: list[str] = []  # open blocks below the deepest, inside the last one of the stack
    in_deep: Counter[str] = Counter()

    def text(piece: str) -> None:
        if piece:
            stack[-1].parts.append((unescape(piece) if "&" in piece else piece, linked))

    def end(own, within) -> None:
        """Ends the innermost open block called like one of `own`, unless one of `within` is met first."""
        if any(in_deep[n] for n in own):
            for i in range(len(deep) - 1, -1, -1):
                if deep[i] in own:
                    in_deep.subtract(deep[i:])
                    del deep[i:]
                    text("\n")
                    return
                if deep[i] in within:
                    return
        if any(in_deep[n] for n in within):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].name in own:
                del stack[i:]
                deep.clear()
                in_deep.clear()
                return
            if stack[i].name in within:
                return

    while (tag_at := html.find("<", at)) >= 0:
        follower = html[tag_at + 1 : tag_at + 2]
        if follower == "!" or follower == "?":
            text(html[at:tag_at])
            last = html.find("-->", tag_at + 2) + 2 if html.startswith("<!--", tag_at) else html.find(">", tag_at)
            if last < tag_at + 1:
                return root
            at = last + 1
            continue
        if not (follower == "/" or follower.isascii() and follower.isalpha()):
            text(html[at : tag_at + 1])  # a plain less-than sign
            at = tag_at + 1
            continue
        text(html[at:tag_at])
        match = None if tag_at in no_tags else _TAG.match(html, tag_at)
        if not match:
            last = html.find(">", tag_at)
            if last < 0 or html.find("<", tag_at + 1) < 0:
                return root
            if follower == "/":
                at = last + 1
                continue
            if tag_at not in no_tags:  # what stands in it outside of values does not end either
                no_tags.update(m.start() for m in _VALUE_OR_TAG.finditer(html, tag_at) if m.group() == "<")
            text("<")
            at = tag_at + 1
            continue
        at, closing, name = match.end(), match.group(1), match.group(2).lower()
        if name in RAW and not closing:
            if name in ("svg", "math") and match.group(3).endswith("/"):
                continue
            own_end = None if name in endless else re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(html, at)
            if own_end:
                at = html.find(">", own_end.start()) + 1 or len(html)
            elif name in _CODE and not match.group(3).endswith("/"):
                return root
            else:
                endless.add(name)
        elif name in INLINE:
            if name == "a":
                linked = not closing
            elif name in ("br", "img"):
                text(" ")
        elif closing:
            linked = False
            end((name,), ())
        elif name in VOID:
            text("\n")
        else:
            linked = False
            if name in _P_ENDS:
                end(("p",), ("td", "th", "button", "table"))
            if name in _ENDS:
                end(*_ENDS[name])
            block = _block(name, match.group(3))
            stack[-1].parts.append(block)
            if len(stack) < DEEPEST:
                stack.append(block)
            else:
                deep.append(name)
                in_deep[name] += 1
    text(html[at:])
    return root
