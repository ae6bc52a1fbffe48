"""Language identification, word first, backing off to shorter and shorter character n-grams.

A word that some language's word list knows is scored by its log frequency in every language.
A word that none knows is scored by its character n-grams of the largest length of which at
least one is known. A text's score in a language is the mean over its words.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
LONGEST = 5  # characters of the longest n-gram, the mark at a word's ends included
MARK = "_"

_WORD = re.compile(r"[^\W\d_]+")
_MEMO = 100_000  # unseen words whose scores a worker remembers


@dataclass
class LanguageModel:
    """Log frequencies, a row per word or n-gram and a column per language; bounded by `learn`."""

    languages: list[str]
    words: dict[str, int] = field(default_factory=dict)
    grams: dict[str, int] = field(default_factory=dict)
    word_logs: np.ndarray = None
    gram_logs: np.ndarray = None

    def unseen(self, word: str) -> np.ndarray:
        """Score of a word outside all word lists: the longest n-grams that are known at all."""
        marked = MARK + word + MARK
        for n in range(min(LONGEST, len(marked)), 0, -1):
            ids = [g for i in range(len(marked) - n + 1) if (g := self.grams.get(marked[i : i + n])) is not None]
            if ids:
                return self.gram_logs[ids].mean(axis=0)
        return np.zeros(len(self.languages), dtype=np.float64)

    def predict(self, text: str | None, memo: dict) -> tuple[str, float]:
        """Language and confidence; `und` and 0 without a letter or without a model."""
        counts = word_counts(text) if text else None
        if not counts or not self.languages:
            return UNKNOWN, 0.0
        known, times, total = [], [], np.zeros(len(self.languages))
        get = self.words.get
        for word, n in counts.items():
            if (k := get(word)) is not None:
                known.append(k)
                times.append(n)
            else:
                if (score := memo.get(word)) is None:
                    if len(memo) >= _MEMO:
                        memo.clear()
                    score = memo[word] = self.unseen(word)
                total = total + n * score
        if known:
            total = total + np.asarray(times, dtype=np.float64) @ self.word_logs[known]
        n = sum(counts.values())
        # Confidence: as sure as the text's mean word, seen at most 20 times over, allows.
        logs = total / n * min(n, 20)
        best = int(np.argmax(logs))
        return self.languages[best], float(1.0 / np.exp(logs - logs[best]).sum())


def word_counts(text: str) -> Counter[str]:
    """Words of a text in lower case: runs of letters, as \\p{L} has them."""
    counts = Counter(_WORD.findall(text.lower()))
    # The pattern takes numerals like ½, ² and Ⅷ for letters; few texts have one.
    for word in [w for w in counts if not w.isalpha()]:
        n = counts.pop(word)
        for part in "".join(c if c.isalpha() else " " for c in word).split():
            counts[part] += n
    return counts


def _logs(rows, languages: list[str]) -> tuple[dict[str, int], np.ndarray]:
    """(entry, language, count, total) rows as natural log frequencies. What a language lacks
    counts, for all languages alike, as a tenth of an occurrence in the one with most text."""
    column = {lang: i for i, lang in enumerate(languages)}
    ids: dict[str, int] = {}
    most: dict[int, int] = {}
    for row in rows:
        ids.setdefault(row["entry"], len(ids))
        most[row["kind"]] = max(most.get(row["kind"], 1), row["total"])
    kinds = {row["entry"]: row["kind"] for row in rows}
    logs = np.empty((len(ids), len(languages)))
    for entry, i in ids.items():
        logs[i] = math.log(0.1 / most[kinds[entry]])
    for row in rows:
        logs[ids[row["entry"]], column[row["lang"]]] = math.log(row["n"] / row["total"])
    return ids, logs


def learn(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    rows_per_language: int = 1500,
    words_per_language: int = 40_000,
    grams_per_language: int = 8_000,
) -> LanguageModel:
    """Word and n-gram frequencies of each language in `df`.

    The classifier is fitted on a bounded sample: about `rows_per_language` different texts of each
    language, drawn by a hash of the text, and of those the most frequent `words_per_language`
    words and `grams_per_language` n-grams of each length. So the model is bounded, however often
    a text is repeated, and a rerun draws the same. Rows with a null text or language are not
    learned from. An empty table gives a model without languages.
    """
    rows = df.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.xxhash64(F.col(text)).alias("hash")).where("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in rows.select("lang", "hash").distinct().groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([])
    share = F.create_map(*[x for k in languages for x in (F.lit(k), F.lit(math.ceil((1 << 20) * min(1.0, rows_per_language / sizes[k]))))])
    sample = rows.where(F.pmod("hash", F.lit(1 << 20)) < share[F.col("lang")]).dropDuplicates(["lang", "hash"])
    words = (
        sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1))).alias("entry"))
        .groupBy("lang", "entry")
        .agg(F.count("*").alias("n"))
        .cache()
    )
    marked = F.concat(F.lit(MARK), "entry", F.lit(MARK))
    pieces = F.flatten(
        F.array(
            *[
                F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - (n - 1), F.lit(1))), lambda i, n=n: F.struct(F.lit(n).alias("kind"), F.substring(marked, i, F.lit(n)).alias("entry")))
                for n in range(1, LONGEST + 1)
            ]
        )
    )
    grams = (
        words.select("lang", "n", F.explode(pieces).alias("piece"))
        .where(F.length("piece.entry") == F.col("piece.kind"))
        .groupBy("lang", F.col("piece.kind").alias("kind"), F.col("piece.entry").alias("entry"))
        .agg(F.sum("n").alias("n"))
    )

    def most_frequent(counts: DataFrame, keep: int):
        own = Window.partitionBy("lang", "kind")
        ranked = counts.withColumn("rank", F.row_number().over(own.orderBy(F.desc("n"), "entry"))).where(F.col("rank") <= keep)
        totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("total"))
        return ranked.join(totals, ["lang", "kind"]).orderBy("lang", "kind", "rank").collect()

    word_ids, word_logs = _logs(most_frequent(words.withColumn("kind", F.lit(0)), words_per_language), languages)
    gram_ids, gram_logs = _logs(most_frequent(grams, grams_per_language), languages)
    words.unpersist()
    return LanguageModel(languages, word_ids, gram_ids, word_logs, gram_logs)


def identify(df: DataFrame, model: LanguageModel, text: str = "text", out: str = "language") -> DataFrame:
    """`df` with a struct column `out` of `lang` and `score` (0 to 1).

    Only the text is looked at, whole. A null text and one without a letter give `und` and 0; so
    does a model without languages. Ties go to the language first in code point order. Repeated
    rows get equal results; a column already called `out` is replaced, all others are kept.
    """
    # Plain data, which executors can read without this package.
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.words, model.grams, model.word_logs, model.gram_logs))

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, memo = LanguageModel(*shared.value), {}
        for texts in batches:
            yield pd.DataFrame([model.predict(t, memo) for t in texts], columns=["lang", "score"])

    return df.withColumn(out, predict(F.col(text)))
