"""Plain re-statements of what the corpus operators must give, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from fractions import Fraction

import xxhash

ASCII_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def pii(text):
    """Base spans by kind, leftmost and without overlap."""
    text = text or ""

    def spans(pattern, ok=lambda s: True):
        return [m.span() for m in re.finditer(pattern, text) if ok(m.group())]

    def luhn(s):
        digits = [int(c) for c in s if c in "0123456789"]
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0

    return {
        "email": spans(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": spans(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": spans(r"[0-9]([\x20-]?[0-9])+", luhn),
        "phone": spans(r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= sum(c.isdigit() for c in s) <= 15),
    }


def quality(text):
    text = text or ""
    words = ASCII_WORD.findall(text)
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    repeated = {i + j for places in windows.values() if len(places) > 1 for i in places for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if ASCII_WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def shingles(text):
    words = ASCII_WORD.findall((text or "").lower())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def jaccard(rows, threshold=Fraction(4, 5)):
    """For each (id, text) row: class, links to other sets, copies. Ids must differ."""
    sets = {i: shingles(t) for i, t in rows}
    near = defaultdict(set)
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and Fraction(len(sets[a] & sets[b]), len(sets[a] | sets[b])) >= threshold:
                near[a].add(b)
                near[b].add(a)
    of = {}
    for i in ids:
        if i not in of:
            todo = [i]
            while todo:
                j = todo.pop()
                if j not in of:
                    of[j] = i
                    todo += near[j]
    return {i: (of[i], len({sets[j] for j in near[i]} - {sets[i]}), 1 + sum(sets[j] == sets[i] for j in near[i])) for i in ids}


def backoff(texts, alpha=0.4, least=2):
    docs = [ASCII_WORD.findall(t or "") for t in texts]
    one = Counter(w for d in docs for w in d)
    two = Counter(p for d in docs for p in zip(d, d[1:], strict=False))
    n = sum(one.values())
    out = []
    for d in docs:
        s = 0.0
        for i, w in enumerate(d):
            if i and two[d[i - 1], w] >= least:
                s += math.log(two[d[i - 1], w] / one[d[i - 1]])
            else:
                s += math.log(one[w] / n) + (math.log(alpha) if i else 0)
        out.append((len(d), s))
    return out


def pieces(text):
    return re.split(r"(?<=\n)(?=[ \t]*\S)|(?<=[.!?] )(?=\S)", text or "")


def _hash(value, seed=42):
    raw = value.encode() if isinstance(value, str) else value.to_bytes(8, "little", signed=True)
    return int.from_bytes(xxhash.xxh64(raw, seed=seed % 2**64).intdigest().to_bytes(8, "big"), "big", signed=True)


def marked_pieces(rows, min_words=25):
    """(id, text) rows in order of id, all different: which pieces are marked as repeated."""
    prints, out = [], {}
    for i, text in rows:
        h = [_hash(p.strip(" \t\n\x0b\x0c\r")) for p in pieces(text)]
        at = dict(enumerate(h))
        pair = [_hash(b, _hash(a)) for a, b in zip(h, h[1:], strict=False)]
        for j, p in enumerate(pair):
            # of two neighbouring pairs the lesser, of equal ones the first
            if len(pair) == 1 or j + 1 < len(pair) and p <= pair[j + 1] or j and p < pair[j - 1]:
                prints.append(((p, 2), i, j, at.get(j - 1), at.get(j + 2)))
        for j, p in enumerate(pieces(text)):
            if p.strip(" \t\n\x0b\x0c\r").count(" ") >= min_words - 1:
                prints.append(((h[j], 1), i, j, at.get(j - 1), at.get(j + 1)))
        out[i] = [False] * len(h)
    first = {}
    for key, i, j, left, right in sorted(prints, key=lambda x: x[1:3]):
        if key not in first:
            first[key] = (left, right)
            continue
        before, behind = first[key]
        begin = j - (left is not None and left == before)
        end = j + key[1] + (right is not None and right == behind)
        out[i][begin:end] = [True] * (end - begin)
    return out


def line_dedup(rows, min_words=25):
    """(id, text) rows in order of id, all different: texts without their marked runs."""
    marked, out = marked_pieces(rows, min_words), {}
    for i, text in rows:
        cut, kept, j = pieces(text), [], 0
        while j < len(cut):
            end = j
            while end < len(cut) and marked[i][end]:
                end += 1
            if end == j or len(ASCII_WORD.findall("".join(cut[j:end]))) < min_words:
                end = max(end, j + 1)
                kept += cut[j:end]
            j = end
        left = "".join(kept)
        out[i] = text if text is None or left == text else left if ASCII_WORD.search(left) else ""
    return out


def contamination(text, items):
    """n_words, n_hit, sorted ids of (id, text) `items`."""
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(t):
        return pattern.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))

    doc, hit, ids = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(13, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(doc) - n + 1):
            if tuple(doc[i : i + n]) in windows:
                hit.update(range(i, i + n))
                ids.add(str(item))
    return len(doc), len(hit), sorted(ids)


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Exact targets by sharing again what goes beyond a limit, until nothing does."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = Fraction(share) * sum(sizes.values()), set()
    while True:
        rest = budget - sum(most * sizes[s] for s in full)
        open_weight = sum(weight[s] for s in names if s not in full)
        found = {s: Fraction(most * sizes[s]) if s in full else rest * weight[s] / open_weight for s in names}
        above = {s for s in names if found[s] > most * sizes[s]}
        if not above:
            return found
        full |= above


def mix(rows, **options):
    """(id, source, size) rows, ids all different: words taken of each."""
    by_source = defaultdict(list)
    for i, source, size in rows:
        by_source[source].append((hashlib.md5(str(i).encode()).hexdigest(), size, i))
    wanted = targets({s: sum(x[1] for x in v) for s, v in by_source.items()}, **options)
    taken = {}
    for source, docs in by_source.items():
        whole, left = sum(x[1] for x in docs), math.floor(wanted[source])
        for _, size, i in docs:
            taken[i] = 0
        while left > 0 and whole:
            for _, size, i in sorted(docs):
                taken[i] += min(size, left)
                left -= min(size, left)
    return taken


def trie(rows):
    """Nodes of the trie of rebuilt conversations; rows are (conv_id, turn, role, text) with distinct turns."""
    import hashlib
    import zlib

    turns = {}
    for c, _, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        turns.setdefault(c, []).append((role or "", text or ""))
    nodes, ends = {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = turns.get(c - c % 100, [])[:h] + own[h:]
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    children = {}
    for n in nodes:
        if n:
            children.setdefault(n[:-1], []).append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        below = children.get(n, [])
        leaves[n] = sum(leaves[m] for m in below) or 1
        saved[n] = sum(saved[m] for m in below) + ((len(nodes[n]) - 1) * len(n[-1][1]) if n else 0)
    return sorted(
        (
            min(who), len(n), min(nodes[n[:-1]]) if n else None, len(who), len(children.get(n, [])), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest(),
        )
        for n, who in nodes.items()
    )


def edits(word):
    """The word without one of its characters, and with a gap in the place of one."""
    for i in range(len(word)):
        yield word[:i] + word[i + 1 :]
        yield word[:i] + "\0" + word[i + 1 :]


def near(words):
    """All words one edit away from each word."""
    words = set(words)
    by_gap, out = {}, {w: set() for w in words}
    for w in words:
        for e in set(edits(w)):
            by_gap.setdefault(e, set()).add(w)
    for gap, there in by_gap.items():
        if "\0" not in gap:
            for w in there & words:
                out[w].discard(w)
            if gap in words:
                for w in there:
                    out[w].add(gap)
                    out[gap].add(w)
        else:
            for w in there:
                out[w] |= there - {w}
    return out


def spelling(docs, misprint=199):
    import zlib
    from collections import Counter

    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % misprint == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return variants({w: n for w, n in counts.items() if len(w) >= 6 and n >= 5})


def variants(counts):
    around, form, out = near(counts), {}, []
    for w, n in counts.items():
        best = min(around[w], key=lambda o: (-counts[o], o), default=None)
        if best is not None and counts[best] >= 5 * n:
            form[w] = best
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(around[w]), counts[form[w]] if w in form else None))
    return sorted(out, key=lambda r: r[0])
