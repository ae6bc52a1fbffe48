"""Language-model scores by stupid backoff, computed relationally.

Documents are dealt into batches by a hash. Each batch lists its distinct n-grams with their
counts, dealt by n-gram hash: one row per batch and hash range, so an n-gram is counted once per
batch before anything travels, however common it is. Per hash range the counts of all batches
are added up, which is the corpus's count table, partitioned by hash; the table is joined back to
the batches that asked, and each batch sums the scores of its documents.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import row_key, word_count

ORDER = 2
BACKOFF = 0.4
LEAST_COUNT = 2  # n-grams of two words or more count as unseen below this
BATCH_CHARS = 16_000_000  # what a task holds of the corpus at a time, unless a text is longer

_MEMO = 500_000  # words whose hashes a worker remembers
_LISTED = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("batch", T.IntegerType()), T.StructField("grams", T.ArrayType(T.LongType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])
_COUNTED = T.StructType([T.StructField("batch", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("totals", T.ArrayType(T.LongType()))])


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _extended(grams: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of n-grams with one word more."""
    x = grams * np.uint64(0x9E3779B97F4A7C15) + words
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def grams_of(texts, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each length 1..order the hashes of the n-grams of all texts in a row, and the texts' word counts.

    The n-th list holds, at each word, the n-gram that ends there. Where a text has fewer words
    before that word it holds 0.
    """
    hashes = _Hashes()
    words, sizes = [], []
    for text in texts:
        own = text.encode("utf-8", "surrogatepass").split() if text else ()
        sizes.append(len(own))
        if own:
            words.append(np.fromiter(map(hashes.__getitem__, own), dtype=np.uint64, count=len(own)))
    sizes = np.array(sizes, dtype=np.int64)
    first = np.concatenate(words) if words else np.empty(0, dtype=np.uint64)
    place = np.arange(len(first)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = [first]
    for n in range(2, order + 1):
        longer = np.zeros(len(first), dtype=np.uint64)
        longer[1:] = _extended(out[-1][:-1], first[1:])
        longer[place < n - 1] = 0
        out.append(longer)
    return out, sizes


def _distinct(grams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all lengths in order of hash, and how often each occurs."""
    everything = np.concatenate([g if n == 0 else g[g != 0] for n, g in enumerate(grams)])
    return np.unique(everything, return_counts=True)


def _cuts(grams: np.ndarray, parts: int) -> np.ndarray:
    """Where the sorted hashes pass from one of `parts` equal ranges to the next."""
    edges = [i * (1 << 64) // parts for i in range(1, parts)]
    return np.concatenate([[0], np.searchsorted(grams, np.array(edges, dtype=np.uint64)), [len(grams)]]).astype(np.int64)


def _list_grams(order: int, parts: int):
    def listed(docs: pd.DataFrame) -> pd.DataFrame:
        grams, counts = _distinct(grams_of(docs["text"], order)[0])
        cuts = _cuts(grams, parts)
        batch = int(docs["batch"].iloc[0])
        rows = [(p, batch, grams[a:b].view(np.int64), counts[a:b].astype(np.int32)) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        return pd.DataFrame(rows, columns=["part", "batch", "grams", "counts"])

    return listed


def _count(group: pd.DataFrame) -> pd.DataFrame:
    """Totals of one hash range, handed back to each batch in the order in which it listed them."""
    group = group.sort_values("batch")
    lengths = group["grams"].map(len).to_numpy()
    place = np.unique(np.concatenate(group["grams"].to_list()), return_inverse=True)[1]
    totals = np.bincount(place, weights=np.concatenate(group["counts"].to_list())).astype(np.int64)[place]
    ends = np.cumsum(lengths)
    return pd.DataFrame({"batch": group["batch"].to_numpy(), "part": group["part"].to_numpy(), "totals": [totals[e - n : e] for e, n in zip(ends, lengths, strict=True)]})


def _score(order: int, backoff: float, least: int, words: int):
    def scored(docs: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        grams, sizes = grams_of(docs["text"], order)
        known = _distinct(grams)[0]
        parts = counted.sort_values("part")["totals"].to_list()
        totals = np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)

        def count(hashes: np.ndarray) -> np.ndarray:
            return totals[np.searchsorted(known, hashes)]

        counts = [count(g) if n == 0 else np.where(g == 0, 0, count(np.where(g == 0, grams[0], g))) for n, g in enumerate(grams)]
        # From the shortest n-gram up: a longer one that is known replaces the backed-off score.
        logs = np.log(counts[0] / max(words, 1))
        for n in range(1, order):
            context = np.zeros(len(logs), dtype=np.int64)
            context[1:] = counts[n - 1][:-1]
            seen = (grams[n] != 0) & (counts[n] >= least)
            longer = np.log(np.where(seen, counts[n], 1) / np.where(seen, context, 1))
            logs = np.where(seen, longer, np.where(grams[n] != 0, logs + math.log(backoff), logs))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        sums = np.bincount(owner, weights=logs, minlength=len(sizes))
        return pd.DataFrame({"key": docs["key"], "n_words": sizes, "log_score": sums})

    return scored


def score(docs: DataFrame, text: str = "text", key: str = "doc_id", order: int = ORDER, backoff: float = BACKOFF, least: int = LEAST_COUNT, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """`key`, `n_words`, `log_score` and `mean_log` of every row of `docs`, counted over all of them.

    The score of a word is its n-gram's count over its context's, natural logarithm; an n-gram
    that occurs fewer than `least` times backs off to the next shorter one, times `backoff`; a
    single word scores its share of all words. `log_score` sums a document's words, `mean_log` is
    their mean. A document's own words count like all others. Null, empty and wordless texts have
    no words, score 0 and a null mean. Repeated rows count as often as they occur; null and
    repeated keys are rows like any other; an empty table stays empty; other columns are ignored.
    """
    size = docs.agg(F.sum(F.length(text)).alias("chars"), F.sum(word_count(F.col(text))).alias("words")).first()
    batches = max(1, math.ceil((size["chars"] or 0) / batch_chars))
    dealt = F.pmod(F.xxhash64(row_key(key, text), F.lit(1)), F.lit(batches)).cast("int")
    rows = docs.select(F.col(key).cast("string").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), dealt.alias("batch"))
    listed = rows.groupBy("batch").applyInPandas(_list_grams(order, batches), _LISTED)
    counted = listed.groupBy("part").applyInPandas(_count, _COUNTED)
    result = T.StructType([T.StructField("key", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("log_score", T.DoubleType())])
    scored = rows.groupBy("batch").cogroup(counted.groupBy("batch")).applyInPandas(_score(order, backoff, least, size["words"] or 0), result)
    return scored.select(F.col("key").cast(docs.schema[key].dataType).alias(key), "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log"))
