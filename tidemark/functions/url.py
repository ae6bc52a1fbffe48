"""URL expressions after RFC 3986, as SQL text over built-in functions.

``parse_url`` is not used: it fails on hrefs with a space, which real pages hold.
"""

from __future__ import annotations

import re

from tidemark.functions.text import let, quoted

_NAMES = ("scheme", "authority", "path", "query", "fragment")
# scheme, //authority, path, ?query, #fragment
PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?"
_PARTS = quoted(PARTS + r"\z")
_PLAIN_PATH = quoted(r"(?s)\A/(?!/|\.)(?:[^/?#]|/(?!\.))*+\z")
_MARK = "\uffff"
_DOT_SEGMENT = quoted(r"(^|/)\.\.?(/|\z)")
_CONTROLS = quoted("".join(map(chr, range(33))))
_BREAKS = quoted("\t\r\n")
_PARAMETERS = quoted(r"(?s);[^/]*\z")
_LAST_SEGMENT = quoted(r"[^/]*\z")


def _tidy(url: str) -> str:
    """Leading control characters and any tab or line break are not part of a URL."""
    return f"translate(ltrim({_CONTROLS}, {url}), {_BREAKS}, '')"


def url_path(url: str) -> str:
    """Path without query, fragment and the ``;parameters`` of the last segment."""
    return f"regexp_replace(regexp_extract({_tidy(url)}, {_PARTS}, 3), {_PARAMETERS}, '')"


def last_segment(path: str) -> str:
    return f"element_at(split(rtrim('/', {path}), '/'), -1)"


def _without_dots(path: str) -> str:
    """Apply ``.`` and ``..``; a ``..`` above the root is dropped."""
    kept = (
        "aggregate(parts, cast(array() AS array<string>), (done, s) -> "
        "CASE s WHEN '..' THEN slice(done, 1, greatest(size(done) - 1, 0)) WHEN '.' THEN done "
        "ELSE concat(done, array(s)) END)"
    )
    ends_in_dots = "element_at(parts, -1) IN ('.', '..')"
    return let("parts", f"split({path}, '/', -1)", f"array_join(concat({kept}, if({ends_in_dots}, array(''), array())), '/')")


def _split(url: str) -> str:
    # One pass of the pattern: the parts, set apart by a character no URL holds.
    marked = f"regexp_replace(u, {_PARTS}, {quoted(_MARK.join(f'${i}' for i in range(1, 6)))})"
    parts = ", ".join(f"'{name}', s[{i}]" for i, name in enumerate(_NAMES))
    return let("u", _tidy(url), let("s", f"split({marked}, {quoted(_MARK)})", f"named_struct('whole', u, {parts})"))


def _split_literal(url: str) -> str:
    """The same of a known address, taken apart here rather than per row."""
    parts = re.match(PARTS, url).groups("")
    cells = ", ".join(f"'{name}', {quoted(part)}" for name, part in zip(_NAMES, parts))
    return f"named_struct('whole', {quoted(url)}, {cells})"


def _rooted(path: str) -> str:
    return f"if(startswith({path}, '/'), {path}, concat('/', {path}))"


def _merged_path(base_path: str, path: str) -> str:
    """A reference's path seen from the page at `base_path`."""
    folder = f"regexp_replace({base_path}, {_LAST_SEGMENT}, '')"
    # A relative path is joined to the base folder, and runs of slashes inside it close up.
    below = f"concat(substring(f, 1, 1), regexp_replace(concat(ltrim('/', f), {path}), '(?<=.)/{{2,}}', '/'))"
    joined = f"if(startswith({path}, '/'), {path}, {let('f', folder, below)})"
    resolved = let("p", joined, f"if(rlike(p, {_DOT_SEGMENT}), {_without_dots('p')}, p)")
    return let("q", resolved, _rooted("q"))


def _suffix(mark: str, value: str) -> str:
    return f"if({value} = '', '', concat('{mark}', {value}))"


def resolve_url(base: str, href: str, base_is_literal: bool = False) -> str:
    """Absolute URL of `href` found on a page whose address is `base`.

    Both are SQL, unless `base` is said to be the literal address.
    """
    tail = _suffix("#", "ref.fragment")
    scheme = "lower(page.scheme)"
    elsewhere = (
        f"concat({scheme}, '://', ref.authority, if(ref.path = '', '', {_rooted('ref.path')}), "
        f"{_suffix('?', 'ref.query')}, {tail})"
    )
    inherited = "if(ref.path = '' AND ref.query = '', page.query, ref.query)"
    here = (
        f"concat({scheme}, '://', page.authority, "
        f"if(ref.path = '', page.path, {_merged_path('page.path', 'ref.path')}), {_suffix('?', inherited)}, {tail})"
    )
    general = let(
        "ref",
        _split("h"),
        f"CASE WHEN ref.whole = '' THEN page.whole "
        f"WHEN ref.scheme <> '' AND lower(ref.scheme) <> {scheme} THEN ref.whole "
        f"WHEN ref.authority <> '' THEN {elsewhere} ELSE {here} END",
    )
    # Most references are plain paths from the root, which need no taking apart.
    joined = f"if(rlike(h, {_PLAIN_PATH}), concat({scheme}, '://', page.authority, h), {general})"
    address = _split_literal(base) if base_is_literal else _split(base)
    return let("page", address, let("h", _tidy(href), joined))
