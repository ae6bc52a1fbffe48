"""Quality rules by tokeniser fertility.

Public vocabularies measure each text: characters per token and the entropy of tokens over
windows of equal length (byte-level vocabulary), and the share of bytes that a piece vocabulary
can only spell as bytes. A text whose measures leave the band that its language's texts keep to
is rejected, besides a few plain counts over words and lines.
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CHARS
from tidemark.session import materialise, small_side

TOKENIZERS = "/opt/tokenizers"
BYTE_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PIECE_VOCABULARY = "piece_bpe_32k.model"
# How the byte-level vocabulary's public tokenizer cuts a text before merging (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SYMBOLS = "#*$%&|<>"
WINDOW = 100  # tokens
# White space that the pattern cannot go through in one go: `\s` of the tokenizer's expressions.
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{10000,}")

MEASURES = ("chars_per_token", "byte_share", "token_entropy")
# Least half width of a band: a share of the median, or (bytes) an absolute share.
LEAST_WIDTH = {"chars_per_token": 0.12, "byte_share": 0.02, "token_entropy": 0.06}
_STEP = 1000  # measures are compared in thousandths
_SCHEMA = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, chars_per_token double, byte_share double, token_entropy double"

_TIMES_LOG = np.zeros(WINDOW + 1)
_TIMES_LOG[1:] = np.arange(1, WINDOW + 1) * np.log2(np.arange(1, WINDOW + 1))


class Vocabularies:
    """The two vocabularies, read from `folder`."""

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken

        with open(os.path.join(folder, BYTE_VOCABULARY), "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        pieces = sentencepiece.SentencePieceProcessor(model_file=os.path.join(folder, PIECE_VOCABULARY))
        self.characters = {piece for i in range(pieces.get_piece_size()) if len(piece := pieces.id_to_piece(i)) == 1} | set(SPACE_CHARS)

    def tokens(self, text: str) -> np.ndarray:
        """Tokens of the whole text. A very long run of white space is one piece of the pattern, all
        but its last character if something follows, and is handed over as such."""
        found, at = [], 0
        for run in _BLANKS.finditer(text):
            end = run.end() - (run.end() < len(text))
            found += self.encoding.encode_ordinary(text[at : run.start()])
            found += self.encoding._encode_single_piece(text[run.start() : end])
            at = end
        return np.asarray(found + self.encoding.encode_ordinary(text[at:]), dtype=np.int64)

    def byte_share(self, text: str, n_bytes: int) -> float:
        """Share of the bytes that belong to characters outside the piece vocabulary."""
        odd = set(text) - self.characters
        return sum(text.count(c) * len(c.encode("utf-8", "surrogatepass")) for c in odd) / n_bytes if odd else 0.0


def window_entropy(tokens: np.ndarray) -> float:
    """Bits of entropy of the tokens in a window of `WINDOW`, the mean over all windows.

    The windows follow each other; the last one ends with the text. A shorter text is one window.
    """
    n = len(tokens)
    if n == 0:
        return 0.0
    if n < WINDOW:
        counts = np.unique(tokens, return_counts=True)[1]
        return float(np.log2(n) - _TIMES_LOG[counts].sum() / n)
    rows = tokens[: n - n % WINDOW].reshape(-1, WINDOW)
    if n % WINDOW:
        rows = np.vstack([rows, tokens[-WINDOW:]])
    rows = np.sort(rows, axis=1)
    starts = np.ones(rows.shape, dtype=bool)
    starts[:, 1:] = rows[:, 1:] != rows[:, :-1]
    runs = np.diff(np.append(np.flatnonzero(starts), rows.size))
    return float(np.log2(WINDOW) - _TIMES_LOG[runs].sum() / rows.size)


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that occurs at least twice."""
    if len(words) < 4:
        return 0
    codes: dict[bytes, int] = {}
    ids = np.fromiter((codes.setdefault(w, len(codes)) for w in words), dtype=np.int64, count=len(words))
    pairs, n = ids[:-1] * len(codes) + ids[1:], len(codes)
    if n > 1 << 20:  # three ids would not fit 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
        key = pairs[:-1] * (n + 1) + ids[2:]
    else:
        key = pairs[:-1] * n + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        inside[shift : shift + len(key)] |= twice
    return int(inside.sum())


def counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines and words in repeated windows."""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [line for line in text.split("\n") if line.strip(SPACE_CHARS)]
    chars = len(text) - sum(text.count(c) for c in SPACE_CHARS)
    return len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words)


def measure(df: DataFrame, text: str = "text", out: str = "measures", folder: str = TOKENIZERS) -> DataFrame:
    """`df` with a struct column `out`: the counts and the three measures of the whole text.

    Null counts as empty; an empty text has zeros throughout.
    """

    @F.pandas_udf(_SCHEMA)
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabularies = Vocabularies(folder)

        def row(text: str | None) -> tuple:
            if not text:
                return (0, 0, 0, 0, 0, 0, 0.0, 0.0, 0.0)
            tokens = vocabularies.tokens(text)
            n_bytes = len(text.encode("utf-8", "surrogatepass"))
            return (*counts(text), len(tokens), len(text) / max(len(tokens), 1), vocabularies.byte_share(text, n_bytes), window_entropy(tokens))

        names = [field.split()[0] for field in _SCHEMA.split(", ")]
        for texts in batches:
            yield pd.DataFrame([row(t) for t in texts], columns=names)

    return df.withColumn(out, measured(F.col(text)))


def base_failed(measures: str) -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    m = F.col(measures)
    return (m["n_words"] < 50) | (m["n_repeat_words"] * 100 > m["n_words"] * 50)


def _quantised(measure: str) -> Column:
    return F.round(F.col(measure) * _STEP).cast("long")


def _median(values: DataFrame, out: str) -> DataFrame:
    """Lower median per `group` of the weighted `value`s (`n`); one small row per distinct value."""
    of_group = Window.partitionBy("group")
    below = F.sum("n").over(of_group.orderBy("value"))
    ranked = values.withColumn("below", below).withColumn("all", F.sum("n").over(of_group))
    return ranked.where(F.col("below") * 2 >= F.col("all")).groupBy("group").agg(F.min("value").alias(out), F.max("all").alias("texts"))


def _group(lang: Column) -> Column:
    """A language's name for its texts; those without a language are a group as well."""
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit("?"))


def bands(measured: DataFrame, width: float = 8.0, least_texts: int = 30) -> DataFrame:
    """Lowest and highest accepted thousandths of each measure, per `group` (language).

    A band is the median of all texts that pass the plain counts, and `width` times their median
    deviation (scaled to a standard deviation) to either side, or `LEAST_WIDTH` if that is more.
    Copies count once. Medians are exact in thousandths: they come from the histogram, which has
    no more rows than the measure has steps. The group `*` holds all languages together, for
    those with fewer than `least_texts`.
    """
    distinct = measured.where(~F.col("base_failed")).select(_group(F.col("lang")).alias("own"), "n_tokens", *[_quantised(m).alias(m) for m in MEASURES]).distinct()
    result = None
    for name in MEASURES:
        histogram = distinct.groupBy("own", F.col(name).alias("value")).agg(F.count("*").alias("n"))
        histogram = histogram.select(F.explode(F.array(F.col("own"), F.lit("*"))).alias("group"), "value", "n").groupBy("group", "value").agg(F.sum("n").alias("n"))
        middle = _median(histogram, "median")
        off = histogram.join(middle.drop("texts"), "group").select("group", F.abs(F.col("value") - F.col("median")).alias("value"), "n")
        spread = _median(off.groupBy("group", "value").agg(F.sum("n").alias("n")), "off").drop("texts")
        least = F.lit(LEAST_WIDTH[name]) * (F.lit(_STEP) if name == "byte_share" else F.col("median"))
        half = F.greatest(F.lit(width * 1.4826) * F.col("off"), least)
        band = middle.join(spread, "group").where(F.col("texts") >= least_texts)
        band = band.select("group", (F.col("median") - half).alias(f"{name}_low"), (F.col("median") + half).alias(f"{name}_high"))
        result = band if result is None else result.join(band, "group")
    return result


def judge(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", folder: str = TOKENIZERS) -> DataFrame:
    """`key`, the counts and measures, `base_failed` and `kept` of each row of `df`.

    A row is kept unless the plain counts fail it, or a measure leaves the band of its language,
    or of all languages if its own has too few texts. Rows without a language form a group of
    their own; a table with too few texts has no bands. Texts are tokenised once, whole; the
    measures, a few numbers per row, are written to the shared folder, as both the bands and the
    verdicts read them. Null and empty texts fail; repeated rows are judged alike; an empty
    table stays empty; other columns are ignored.
    """
    rows = measure(df.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text")), "text", "m", folder)
    rows = materialise(rows.select("key", "lang", "m.*", base_failed("m").alias("base_failed")))
    limits = materialise(bands(rows))
    # As many rows as there are languages, and counted before it is broadcast.
    own = small_side(limits.where("group <> '*'"))
    # The band of all languages is one row.
    common = F.broadcast(limits.where("group = '*'").select(*[F.col(c).alias(f"common_{c}") for c in limits.columns]))
    rows = rows.withColumns({"group": _group(F.col("lang")), "common_group": F.lit("*")})
    rows = rows.join(own, "group", "left").join(common, "common_group", "left")
    inside = F.lit(True)
    for name in MEASURES:
        low, high = (F.coalesce(f"{name}_{end}", f"common_{name}_{end}") for end in ("low", "high"))
        inside = inside & F.coalesce(_quantised(name).between(low, high), F.lit(True))
    names = [field.split()[0] for field in _SCHEMA.split(", ")]
    return rows.select(F.col("key").alias(key), *names, "base_failed", (~F.col("base_failed") & inside).alias("kept"))
