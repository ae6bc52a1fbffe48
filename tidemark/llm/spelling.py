"""Spelling variants of a corpus' words, found by an index over grams of variable length.

Grams that occur often in the word list are prolonged, up to a longest length; so the gram at any
place of a word depends on its own characters alone, and one inside an earlier gram is left out.
One edit at a given place can affect only grams that hold the place, or that end less than a
longest gram's length behind it. The lists of all other grams have to agree, so for every place of
an edit they are merged into one key: everything up to the last unaffected gram before the place,
everything from the first one behind it, and the length. Words that share a key are compared.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import fits, materialise

# Shortest and longest gram.
SHORTEST, LONGEST = 2, 4
# A gram is prolonged if it occurs more often than this in the word list, ...
OFTEN = 200
# ... and more often than one in so many grams: no more grams than that are broadcast.
DICTIONARY = 20_000
# Words of a key that are compared with each other; in longer lists only those that agree outside the place.
LIST = 64
# Steps in which the places of a word are gone through.
PLACES = 40

_LETTERS = "A-Za-zÀ-ÿ"
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# Outside of all words.
_BEFORE, _BEHIND = "<", ">"
# Entries that a task counts before it hands them on.
_ENTRIES = 200_000


def count_words(
    df: DataFrame, text: str = "text", doc_id: str = "doc_id", least_chars: int = 6, least_count: int = 5, misprint: int | None = None
) -> DataFrame:
    """`word` and `n`, its occurrences, for words of `least_chars` characters found `least_count` times.

    A word is a whole run of ASCII and Latin-1 letters, A to Z in lower case. With `misprint`,
    misprints are planted: an occurrence for which the crc32 of `doc_id:word` is a multiple of it
    loses the character at that crc32 modulo its length. A null text has no words, a null id is
    empty. Counting begins in the tasks, with at most `_ENTRIES` entries and one text's at a time.
    """
    # A shorter run cannot become a word.
    runs = re.compile(f"[{_LETTERS}]{{{least_chars},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

        for part in batches:
            for doc, words in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                start = zlib.crc32(f"{doc or ''}:".encode())
                for run, n in Counter(runs.findall(words)).items():
                    word = run.lower() if run.isascii() else run.translate(_LOWER)
                    if misprint and (crc := zlib.crc32(word.encode(), start)) % misprint == 0:
                        at = crc % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least_chars:
                            continue
                    found[word] += n
                if len(found) >= _ENTRIES:
                    yield batch()
                    found = Counter()
        yield batch()

    rows = df.select(F.col(doc_id).cast("string").alias("doc"), F.col(text).cast("string").alias("text")).where("text IS NOT NULL")
    counts = rows.mapInArrow(counted, "word STRING, n BIGINT")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def gram_dictionary(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, often: int = OFTEN, most: int = DICTIONARY) -> set[str]:
    """Grams that are prolonged: those that occur more than `often` times among `words`, and more
    than once in `most` grams, so that there are at most `most` of them."""
    pad = longest - 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["gram", "n"])

        for part in batches:
            for word in part.column(0).to_pylist():
                whole = _BEFORE * pad + word + _BEHIND * pad
                for q in range(shortest, longest):
                    found.update(whole[i : i + q] for i in range(len(whole) - q + 1))
                if len(found) >= _ENTRIES:
                    yield batch()
                    found = Counter()
        yield batch()

    counts = materialise(words.select("word").mapInArrow(counted, "gram STRING, n BIGINT").groupBy("gram").agg(F.sum("n").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {r["gram"] for r in counts.where(F.col("n") > max(often, -(-total // most))).select("gram").collect()}


def decompose(word: str, prolonged: set[str], shortest: int = SHORTEST, longest: int = LONGEST) -> list[tuple[int, int]]:
    """Begin and end of each gram of a padded word; none lies inside another one."""
    grams, last = [], 0
    for begin in range(len(word) - shortest + 1):
        end = begin + shortest
        while end - begin < longest and end < len(word) and word[begin:end] in prolonged:
            end += 1
        if end > last:
            grams.append((begin, end))
            last = end
    return grams


def merged_lists(word: str, prolonged: set[str], shortest: int = SHORTEST, longest: int = LONGEST) -> list[tuple[int, int, int, int, int]]:
    """Keys of `word`: (head, tail, gone, first, last).

    For an edit at any of the places `first` to `last` that takes `gone` characters of this word
    (1 if one is replaced or deleted, 0 if one is inserted), the grams that cannot be affected
    make up `word[:head]` and `word[tail:]`. Neighbouring places of a long word are taken
    together, so that no word has more than about `2 * PLACES` keys.
    """
    pad, size = longest - 1, len(word)
    grams = decompose(_BEFORE * pad + word + _BEHIND * pad, prolonged, shortest, longest)
    begins, ends = [g[0] for g in grams], [g[1] for g in grams]
    keys: list[tuple[int, int, int, int, int]] = []
    for gone in (1, 0):
        # Words that are an edit apart have equal `rest`, and so the same steps.
        rest = size - gone
        step = -(-(rest + 1) // PLACES)
        for first in range(0, rest + 1, step):
            last = min(first + step - 1, rest)
            before = bisect_right(ends, first + pad)
            head = max(0, ends[before - 1] - pad) if before else 0
            behind = bisect_left(ends, last + pad + gone + longest)
            tail = min(size, begins[behind] - pad) if behind < len(ends) else size
            if keys and keys[-1][:3] == (head, tail, gone):
                keys[-1] = (head, tail, gone, keys[-1][3], last)
            else:
                keys.append((head, tail, gone, first, last))
    return keys


def near_words(words: DataFrame, shortest: int = SHORTEST, longest: int = LONGEST, often: int = OFTEN, most: int = DICTIONARY, longest_list: int = LIST) -> DataFrame:
    """Pairs of `words` (`word`, `n`) that are one inserted, deleted or replaced character apart:
    `word`, `n`, `other`, `other_n`, each pair once.

    Each word gives about two keys a character, a long one no more than about `2 * PLACES`. A list of more than `longest_list` words is cut by
    what its words have beside each place of an edit: whatever the list's length, such a part holds
    no more words than there are letters, and one more.
    """
    prolonged = gram_dictionary(words, shortest, longest, often, most)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["word", "n", "head", "tail", "gone", "first", "last"]
        kinds = [pa.string(), pa.int64(), *[pa.int32()] * 5]
        for batch in batches:
            rows = [(word, n, *key) for word, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for key in merged_lists(word, prolonged, shortest, longest)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 7, kinds)], names)

    cut = words.select("word", "n").mapInArrow(keyed, "word STRING, n BIGINT, head INT, tail INT, gone INT, first INT, last INT")
    key = F.xxhash64(F.expr("left(word, head)"), F.expr("substring(word, tail + 1)"), F.length("word") - F.col("gone"))
    keys = materialise(cut.select(key.alias("key"), "word", "n", "gone", "first", "last"))
    long = materialise(keys.groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > longest_list).select("key"))
    if fits(long):
        long = F.broadcast(long)
    # One row per place, told apart by what is beside the place.
    places = keys.join(long, "key", "left_semi").withColumn("first", F.explode(F.sequence("first", "last"))).withColumn("last", F.col("first"))
    places = places.withColumn("key", F.xxhash64("key", F.expr("left(word, first)"), F.expr("substring(word, first + gone + 1)")))
    return _compared(keys.join(long, "key", "left_anti")).unionByName(_compared(places))


def _compared(keys: DataFrame) -> DataFrame:
    """Pairs of words with a common key, at the place where they begin to differ and nowhere else."""
    a, b = keys.alias("a"), keys.alias("b")
    meet = F.expr(
        "a.key = b.key AND a.word < b.word AND a.gone + b.gone > 0 "
        "AND left(a.word, a.first) = left(b.word, a.first) AND left(a.word, a.last + 1) <> left(b.word, a.last + 1) "
        "AND levenshtein(a.word, b.word, 1) = 1"
    )
    return a.join(b, meet).select("a.word", "a.n", F.col("b.word").alias("other"), F.col("b.n").alias("other_n"))


def last_forms(forms: DataFrame) -> DataFrame:
    """`word` and `root`, the last word reached from it through `forms` (`word`, `form`).

    Each round joins what was reached to itself, so that the ways double; forms occur `ratio` times
    as often as their words, so a handful of rounds ends it.
    """
    reached = materialise(forms.select("word", F.col("form").alias("root")))
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        following = materialise(reached.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if following.where("moved").isEmpty():
            return following.drop("moved")
        reached = following.drop("moved")


def spelling_variants(words: DataFrame, ratio: int = 5, **index) -> DataFrame:
    """`words` (`word`, `n`, each word once) with `form`, `form_n`, `n_near` and `root`.

    `n_near` counts the words one edit away. Of those the one that occurs most often, of equal ones
    the first in code point order, is the word's `form` if it occurs at least `ratio` times as
    often; otherwise `form` and `form_n` are null. `root` is the last of the forms that follow each
    other, or the word itself. A null word has none of these and is its own root (null); an empty
    table gives an empty one; further columns of `words` are left out.
    """
    words = materialise(words.select("word", F.col("n").cast("long").alias("n")))
    pairs = materialise(near_words(words.where("word IS NOT NULL"), **index))
    both = pairs.select("word", "other", "other_n").unionByName(pairs.select(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    joined = words.join(best, "word", "left")
    follows = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    found = materialise(
        joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(follows, F.col("best.other")).alias("form"), F.when(follows, -F.col("best.less")).alias("form_n"))
    )
    roots = last_forms(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
