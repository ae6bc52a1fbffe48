"""Personal data by anchor expansion.

An Aho-Corasick automaton runs over the whole text once and stops at anchors: at-signs, URL
schemes, plus signs, digits and identifier cues in several languages. At each anchor a local
parser reads left and right, settles the boundary and validates what it found. Every parser
remembers where its last span ended, so a text is read in time linear in its length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The kinds found by shape alone, in the order in which spans are listed.
BASE_KINDS = ("email", "ip", "card", "phone")
# The kinds that a cue adds.
CUED_KINDS = ("masked_email", "login_url", "iban", "account", "secret")
KINDS = BASE_KINDS + CUED_KINDS

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))

AT_CUES = ("(at)", "[at]", "{at}", " at ")
SECRET_CUES = ("password", "passwort", "passwd", "contraseña", "mot de passe", "token", "secret", "api_key", "api-key", "apikey", "api key")
ACCOUNT_CUES = ("account", "acct", "konto", "kontonummer", "compte", "cuenta", "ssn", "social security", "passport", "reisepass", "passeport", "pasaporte", "tax id", "steuernummer")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MASKED_DOMAIN = re.compile(r"\s?([A-Za-z0-9-]+(?:\s?(?:\.|\(dot\)|\[dot\]|\{dot\}| dot )\s?[A-Za-z0-9-]+)*(?:\s?(?:\(dot\)|\[dot\]|\{dot\}| dot )\s?|\.)[A-Za-z]{2,})")
_LOGIN = re.compile(r"://[^\s/@:<>\"']+:[^\s/@<>\"']+@[A-Za-z0-9.-]+")
_IBAN = re.compile(r"[\s:.#=-]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})")
_SECRET = re.compile(r"\s{0,2}[=:]\s{0,2}[\"']?([^\s\"',;]{6,})")
_ACCOUNT = re.compile(r"(?i:\x20?(?:number|nummer|numero|número|numéro|nr|no|n°|is|ist|est|es))?\.?\s{0,2}[:=#]?\s{0,2}([A-Z]{0,3}[0-9](?:[\x20/-]?[0-9]){5,23})(?![A-Za-z0-9])")


def luhn(digits: str) -> bool:
    """Whether the check digit of a card number fits."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def iban_valid(code: str) -> bool:
    """ISO 7064 mod 97-10 over the rotated code."""
    bare = code.replace(" ", "")
    if not 15 <= len(bare) <= 34:
        return False
    number = "".join(str(int(c, 36)) for c in bare[4:] + bare[:4])
    return int(number) % 97 == 1


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for cue in "0123456789":
        found.add_word(cue, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("+", ("plus", 1))
    found.add_word("://", ("scheme", 3))
    found.add_word("iban", ("iban", 4))
    for cues, kind in ((AT_CUES, "masked"), (SECRET_CUES, "secret"), (ACCOUNT_CUES, "account")):
        for cue in cues:
            found.add_word(cue, (kind, len(cue)))
    found.make_automaton()
    return found


class Scanner:
    """Finds the spans of one text after another."""

    def __init__(self):
        self.automaton = automaton()

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """Spans as (kind, start, end) in code points, by kind as in `KINDS`, then by start."""
        if not text:
            return []
        low = text.lower()
        if len(low) != len(text):  # a letter whose lower case is longer: fold letter by letter
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
        after = dict.fromkeys(KINDS, 0)
        digits_after = 0
        for last, (cue, length) in self.automaton.iter(low):
            start, end = last - length + 1, last + 1
            if cue == "digit":
                if start < digits_after:
                    continue
                ip_to, card_to = after["ip"], after["card"]
                if start >= ip_to:
                    after["ip"] = self._ip(text, start, found["ip"])
                if start >= card_to:
                    after["card"] = self._card(text, start, found["card"])
                digits_after = min(after["ip"], after["card"])
            elif cue == "at":
                after["email"] = self._email(text, start, after["email"], found["email"])
            elif cue == "plus":
                if start >= after["phone"] and (match := _PHONE.match(text, start)):
                    after["phone"] = match.end()
                    if 9 <= sum("0" <= c <= "9" for c in match.group()) <= 15:
                        found["phone"].append(match.span())
            elif cue == "scheme":
                if start >= after["login_url"] and (match := _LOGIN.match(text, start)):
                    after["login_url"] = match.end()
                    found["login_url"].append(self._with_scheme(text, match))
            elif cue == "masked":
                self._masked(text, start, end, after, found["masked_email"])
            else:
                self._cued(text, cue, start, end, after, found)
        return [(kind, a, b) for kind in KINDS for a, b in found[kind]]

    @staticmethod
    def _email(text: str, at: int, after: int, out: list) -> int:
        start = at
        while start > after and text[start - 1] in _LOCAL:
            start -= 1
        if start == at or not (match := _DOMAIN.match(text, at + 1)):
            return after
        out.append((start, match.end()))
        return match.end()

    @staticmethod
    def _ip(text: str, start: int, out: list) -> int:
        """Dotted numbers from `start`, four at a time; returns where the chain ends."""
        chain = _DIGIT_CHAIN.match(text, start)
        if "." in chain.group():
            parts = [m.span() for m in re.finditer("[0-9]+", chain.group())]
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                values = [chain.group()[a:b].lstrip("0") for a, b in four]
                if all(len(v) <= 3 and (not v or int(v) <= 255) for v in values):
                    out.append((start + four[0][0], start + four[3][1]))
        return chain.end()

    @staticmethod
    def _card(text: str, start: int, out: list) -> int:
        match = _CARD.match(text, start)
        if not match:
            return start + 1
        digits = match.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(match.span())
        return match.end()

    @staticmethod
    def _with_scheme(text: str, match: re.Match) -> tuple[int, int]:
        start = match.start()
        while start > 0 and start > match.start() - 12 and text[start - 1].isascii() and text[start - 1].isalpha():
            start -= 1
        return start, match.end()

    @staticmethod
    def _masked(text: str, start: int, end: int, after: dict, out: list) -> None:
        """``name (at) host (dot) com``: a local part before the cue, a spelt-out domain after it."""
        right = start
        while right > 0 and text[right - 1] == " ":
            right -= 1
        left = right
        while left > after["masked_email"] and text[left - 1] in _LOCAL:
            left -= 1
        match = _MASKED_DOMAIN.match(text, end)
        if left < right and match and (text[start] != " " or "dot" in match.group().lower()):
            out.append((left, match.end()))
            after["masked_email"] = match.end()

    @staticmethod
    def _cued(text: str, cue: str, start: int, end: int, after: dict, found: dict) -> None:
        """A value after a cue that stands as a word of its own."""
        if start > 0 and text[start - 1].isalnum() or start < after[cue]:
            return
        match = {"iban": _IBAN, "secret": _SECRET, "account": _ACCOUNT}[cue].match(text, end)
        if not match:
            return
        a, b = match.span(1)
        if cue == "iban":
            while b > a and (text[b - 1] == " " or not iban_valid(text[a:b])):  # a following word in capitals is no part of it
                b -= 1
            if b == a:
                return
        found[cue].append((a, b))
        after[cue] = b


@F.pandas_udf(SPANS)
def pii_spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    scanner = Scanner()
    for texts in batches:
        yield pd.Series([[{"kind": k, "start": a, "end": b} for k, a, b in scanner.spans(t)] for t in texts], dtype=object)


def find_pii(df: DataFrame, text: str = "text", out: str = "pii") -> DataFrame:
    """`df` with a column `out`: the personal data in `text`, by kind and start.

    Offsets are code points, the end exclusive. Null and empty texts give an empty list; texts
    of any length are read whole; repeated rows are treated alike; an empty table stays empty.
    A column already called `out` is replaced, all others are kept.
    """
    return df.withColumn(out, pii_spans(F.col(text)))


def redact(text: Column, spans: Column) -> Column:
    """`text` with every span replaced by its kind in angle brackets; of overlapping spans the first counts."""
    parts = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return _redacted(text, F.array_sort(parts))


@F.pandas_udf(T.StringType())
def _redacted(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, found in zip(texts, spans, strict=True):
        if text is None or found is None:
            out.append(None)
            continue
        done, at = [], 0
        for span in found:
            if span["start"] >= at:
                done += [text[at : span["start"]], "<", span["kind"], ">"]
                at = span["end"]
        out.append("".join([*done, text[at:]]))
    return pd.Series(out, dtype=object)


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
