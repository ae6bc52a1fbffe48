"""Passage deduplication by winnowing over hashes of short word runs.

Lines and sentences do not matter here: a passage may begin and end anywhere. Over the hashes of
runs of 8 words, window minima are the fingerprints, with windows so wide that any `min_words`
words hold a whole one; a run of `min_words` words that two texts share therefore has a common
fingerprint, at the same place of the run. Only around fingerprints that occur twice are all
windows of `min_words` words hashed and compared, so what goes is exact to the word, against
every earlier occurrence and not the first alone. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, SPACE_CHARS, free_name, row_key
from tidemark.llm.line_dedup import MIN_WORDS, _cut
from tidemark.session import materialise

GRAM = 8
# Cuts in front of every word but the first, if no white space leads; nothing is lost.
_WORD_CUT = r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"
# Low bits of a packed hash that hold its place; an array has no more longs than that.
_PLACE = (1 << 28) - 1


def _powers(size: int) -> list[int]:
    return [1 << i for i in range(size.bit_length()) if size >> i]


def _shifted(name: str, by: int) -> Column:
    return F.slice(name, F.lit(by + 1), F.greatest(F.size(name) - by, F.lit(0)))


def _with_hashes(rows: DataFrame, size: int, out: str) -> DataFrame:
    """`rows` (with `words`) and `out`, the hash of the `size` words from each place on.

    Places where fewer words are left hold values without meaning.
    """
    rows = rows.withColumn("p1", F.transform("words", lambda w: F.xxhash64(w)))
    for power in _powers(size)[1:]:
        half = f"p{power // 2}"
        rows = rows.withColumn(f"p{power}", F.zip_with(half, _shifted(half, power // 2), lambda a, b: F.xxhash64(a, b)))
    parts = [power for power in reversed(_powers(size)) if size & power]
    name, done = f"p{parts[0]}", parts[0]
    for power in parts[1:]:
        rows = rows.withColumn(f"w{done + power}", F.zip_with(name, _shifted(f"p{power}", done), lambda a, b: F.xxhash64(a, b)))
        name, done = f"w{done + power}", done + power
    return rows.withColumn(out, F.col(name))


def _with_words(docs: DataFrame, text: str, doc_id: str, min_words: int) -> DataFrame:
    """`doc_id`, `k`, `words` and their number `n` of the texts that have `min_words`."""
    words = F.split(F.btrim(F.col(text), F.lit(SPACE_CHARS)), SPACE)
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("k"), words.alias("words"))
    return rows.withColumn("n", F.size("words")).where(F.col("n") >= min_words)


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """`f`, the hash of a chosen word run, its row (`doc_id`, `k`) and its first word `pos`."""
    gram = min(GRAM, min_words)
    width = min_words - gram + 1
    rows = _with_hashes(_with_words(docs, text, doc_id, min_words), gram, "g").select("doc_id", "k", "n", "g")
    packed = F.transform("g", lambda h, i: h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long")))
    rows = rows.withColumn("m1", packed)
    name, done = "m1", 1
    while done < width:  # two windows that overlap make one of any width up to twice theirs
        step = min(done, width - done)
        rows = rows.withColumn(f"m{done + step}", F.zip_with(name, _shifted(name, step), lambda a, b: F.least(a, b)))
        name, done = f"m{done + step}", done + step
    chosen = F.array_distinct(F.slice(name, F.lit(1), F.col("n") - (min_words - 1)))

    def fingerprint(m: Column) -> Column:
        pos = m.bitwiseAND(F.lit(_PLACE)).cast("int")
        return F.struct(F.get("g", pos).alias("f"), pos.alias("pos"))

    return rows.select("doc_id", "k", F.explode(F.transform(chosen, fingerprint)).alias("p")).select("doc_id", "k", "p.*")


def repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """Windows of `min_words` words that occurred before: `doc_id`, `k`, `starts` (first words, sorted).

    "Before" is by id (null first), then by the row's hash, then by position. Fingerprints and
    windows are counted with map-side combining; what occurs once is left behind there.
    """
    prints = materialise(fingerprints(docs, text, doc_id, min_words))
    twice = materialise(prints.groupBy("f").agg(F.count("*").alias("times")).where("times > 1").drop("times"))
    near = prints.join(twice, "f").groupBy("doc_id", "k").agg(F.collect_set("pos").alias("near"))
    near = materialise(near.select(F.col("doc_id").alias("near_id"), F.col("k").alias("near_k"), "near"))
    # The texts travel, and are cut into words behind the join.
    texts = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("k"), F.col(text).alias("text"))
    texts = texts.join(near, texts["k"].eqNullSafe(near["near_k"]) & texts["doc_id"].eqNullSafe(near["near_id"]))
    words = F.split(F.btrim("text", F.lit(SPACE_CHARS)), SPACE)
    rows = _with_hashes(texts.select("doc_id", "k", "near", words.alias("words")), min_words, "w")
    reach = min_words - min(GRAM, min_words)
    starts = F.transform("near", lambda p: F.sequence(F.greatest(p - reach, F.lit(0)), F.least(p, F.size("w") - min_words)))
    windows = F.transform(F.array_distinct(F.flatten(starts)), lambda s: F.struct(F.get("w", s).alias("h"), s.alias("pos")))
    windows = materialise(rows.select("doc_id", "k", F.explode(windows).alias("w")).select("doc_id", "k", "w.*"))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "k", "pos")
    firsts = windows.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    # Written, so that both sides of the join are shuffled for it and a skewed key can be split.
    firsts = materialise(firsts)
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("k") == F.col("first.k")) & (F.col("pos") == F.col("first.pos"))
    later = windows.join(firsts, "h").where(~is_first)
    return later.groupBy("doc_id", "k").agg(F.sort_array(F.collect_set("pos")).alias("starts"))


def dedup_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS, out: str = "kept_text") -> DataFrame:
    """`docs` with `out`, the text without the passages that occurred before, and `removed_words`.

    A word goes if it lies in any `min_words` neighbouring words that occurred before, in this
    text or an earlier one, wherever they begin; the white space behind it goes with it. Which
    white space stands between words does not count. A text of which no word is left becomes
    empty. Null stays null; texts of fewer words, and texts without a repeat, come out unchanged;
    texts of any length are read whole. Rows equal in id and text are one document and treated
    alike; rows with one id and different texts are ordered by hash. An empty table stays empty;
    columns already called like the new ones are replaced.
    """
    found = materialise(repeated(docs, text, doc_id, min_words))
    names = [c for c in docs.columns if c.lower() not in (out.lower(), "removed_words")]
    k = free_name(docs, "k")
    keyed = docs.withColumn(k, row_key(doc_id, text))
    other_id, other_k, starts, places = (free_name(keyed, x) for x in ("other_id", "other_k", "starts", "places"))
    found = found.select(F.col("doc_id").alias(other_id), F.col("k").alias(other_k), F.col("starts").alias(starts))
    rows = keyed.join(found, keyed[k].eqNullSafe(found[other_k]) & keyed[doc_id].eqNullSafe(found[other_id]), "left")
    # White space that leads the text is a piece of its own; a column, so that it is looked for once.
    lead = free_name(rows, "lead")
    rows = rows.withColumn(lead, F.when(F.length(F.ltrim(F.col(text), F.lit(SPACE_CHARS))) < F.length(text), F.lit(1)).otherwise(F.lit(0)))
    # Each start adds the words that the one before it has not covered.
    fresh = F.transform(starts, lambda s, i: F.sequence(F.greatest(s, F.coalesce(F.get(starts, i - 1) + min_words, F.lit(0))) + F.col(lead), s + min_words - 1 + F.col(lead)))
    return _cut(rows.withColumn(places, F.flatten(fresh)), text, places, min_words, names, out, _WORD_CUT)
