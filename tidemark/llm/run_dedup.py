"""Deduplication of repeated word runs by winnowing, inside lines and across them.

A gram of half of `min_words` words is a fingerprint if its first word has the least hash of its
neighbouring words, of which there are so many that any `min_words` words hold such a gram, at the
same place wherever they stand. A fingerprint's context, all words of the runs of `min_words` words
that hold it, is hashed with it: where the same context stood before, each of these runs did. What is
left are the first occurrences of contexts; where a fingerprint has several, all their runs of
`min_words` words are hashed and compared, wherever they begin. So every repeated run is found, against
all earlier texts. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE, SPACE_CHARS, free_name, row_key
from tidemark.llm.line_dedup import MIN_WORDS, _cut
from tidemark.llm.passage_dedup import _PLACE, _WORD_CUT
from tidemark.session import materialise


def _gram(min_words: int) -> int:
    """Words of a fingerprint."""
    return max(min_words // 2, 1)


def _least(name: str, steps: list[int]) -> Column:
    """The least of each value and those `steps` further on; there are none behind the end."""
    return F.transform(name, lambda v, i: F.least(v, *[F.get(name, i + s) for s in steps]))


def _word_hashes(text: str) -> Column:
    words = F.split(F.btrim(F.col(text), F.lit(SPACE_CHARS)), SPACE)
    return F.transform(words, lambda w: F.xxhash64(w))


def _hash_of(begin: Column, size: Column) -> Column:
    """Of the `size` words from `begin` on."""
    return F.xxhash64(F.slice("h", begin + 1, size))


def with_chosen(rows: DataFrame, min_words: int) -> DataFrame:
    """`rows` (with `h`, the hashes of `n` words) and `chosen`, where fingerprints begin: of the places of
    grams in any `min_words` words the one whose word has the least hash, of equal ones the first."""
    gram = _gram(min_words)
    width = min_words - gram + 1
    starts = F.slice("h", F.lit(1), F.greatest(F.col("n") - (gram - 1), F.lit(0)))
    rows = rows.withColumn("m1", F.transform(starts, lambda h, i: h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("long"))))
    done = 1
    while done < width:  # windows that touch or overlap make a wider one
        times = min(5, -(-width // done))
        wider = min(done * times, width)
        # The last of them begins where the wider one's last part does.
        steps = [min(done * t, wider - done) for t in range(1, times)]
        rows = rows.withColumn(f"m{wider}", _least(f"m{done}", steps))
        done = wider
    whole = F.greatest(F.col("n") - (min_words - 1), F.lit(0))
    places = F.array_distinct(F.slice(f"m{width}", F.lit(1), whole))
    return rows.withColumn("chosen", F.transform(places, lambda m: m.bitwiseAND(F.lit(_PLACE)).cast("int")))


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """`f`, the hash of a chosen gram, `c`, the hash of its context, its row (`doc_id`, `k`), its first word
    `pos`, and how many words of the context are to the `left` and to the `right` of it."""
    gram = _gram(min_words)
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("k"), _word_hashes(text).alias("h"))
    rows = rows.withColumn("n", F.size("h"))

    def fingerprint(pos: Column) -> Column:
        left = F.least(pos, F.lit(min_words - gram))
        right = F.least(F.col("n") - pos - gram, F.lit(min_words - gram))
        context = F.xxhash64(F.slice("h", pos - left + 1, left + gram + right), left, right)
        return F.struct(_hash_of(pos, F.lit(gram)).alias("f"), context.alias("c"), pos.alias("pos"), left.alias("left"), right.alias("right"))

    rows = with_chosen(rows, min_words)
    return rows.select("doc_id", "k", F.explode(F.transform("chosen", fingerprint)).alias("p")).select("doc_id", "k", "p.*")


def _windows(docs: DataFrame, near: DataFrame, text: str, doc_id: str, min_words: int) -> DataFrame:
    """Runs of `min_words` words that begin in the `starts` of `near`: `doc_id`, `k`, `w`, their hash, and `pos`."""
    near = near.groupBy("doc_id", "k").agg(F.collect_set(F.struct("begin", "end")).alias("starts"))
    near = materialise(near.select(F.col("doc_id").alias("near_id"), F.col("k").alias("near_k"), "starts"))
    # The texts travel, and are cut into words behind the join.
    texts = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("k"), F.col(text).alias("text"))
    # Equal rows are one document.
    texts = texts.join(near, texts["k"].eqNullSafe(near["near_k"]) & texts["doc_id"].eqNullSafe(near["near_id"]))
    rows = texts.select("doc_id", "k", _word_hashes("text").alias("h"), _all_of("starts").alias("places"))
    found = F.transform("places", lambda s: F.struct(_hash_of(s, F.lit(min_words)).alias("w"), s.alias("pos")))
    return rows.select("doc_id", "k", F.explode(found).alias("p")).select("doc_id", "k", "p.*")


def _all_of(ranges: str) -> Column:
    """The numbers in any of the `ranges` (`begin`, `end`, inclusive), each once."""
    return F.array_distinct(F.flatten(F.transform(ranges, lambda r: F.sequence(r["begin"], r["end"]))))


def repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """Runs of `min_words` words that occurred before, for each row with any: `doc_id`, `k`, `starts`, ranges
    (`begin`, `end`, inclusive) of their first words.

    "Before" is by id (null first), then by the row's hash, then by position. Fingerprints, contexts and
    runs are counted with map-side combining, and what occurs once is left behind there; one that half
    the documents share is a key of plain inner joins, which Spark splits when it is skewed.
    """
    prints = materialise(fingerprints(docs, text, doc_id, min_words))
    # Written, so that both sides of a join are shuffled for it and a skewed key can be split.
    twice = materialise(prints.groupBy("f").agg(F.count("*").alias("times")).where("times > 1").select("f"))
    prints = materialise(prints.join(twice, "f"))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "k", "pos")
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("k") == F.col("first.k")) & (F.col("pos") == F.col("first.pos"))
    starts = [(F.col("pos") - F.col("left")).alias("begin"), (F.col("pos") + F.col("right") - (min_words - _gram(min_words))).alias("end")]

    contexts = materialise(prints.groupBy("f", "c").agg(F.min(place).alias("first"), F.first("left").alias("left"), F.first("right").alias("right"), F.count("*").alias("times")))
    copies = prints.join(contexts.where("times > 1").select("f", "c", "first"), ["f", "c"]).where(~is_first).select("doc_id", "k", *starts)

    several = materialise(contexts.groupBy("f").agg(F.count("*").alias("times")).where("times > 1").select("f"))
    near = contexts.join(several, "f").select("first.doc_id", "first.k", "first.pos", "left", "right").select("doc_id", "k", *starts)
    windows = materialise(_windows(docs, near, text, doc_id, min_words))
    firsts = materialise(windows.groupBy("w").agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1").drop("times"))
    others = windows.join(firsts, "w").where(~is_first).select("doc_id", "k", F.col("pos").alias("begin"), F.col("pos").alias("end"))
    # No more of them in a document than it has words.
    return copies.unionByName(others).groupBy("doc_id", "k").agg(F.collect_set(F.struct("begin", "end")).alias("starts"))


def dedup_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS, out: str = "kept_text") -> DataFrame:
    """`docs` with `out`, the text without its later repeated word runs, and `removed_words`.

    A word goes if it lies in any `min_words` neighbouring words that occurred before, in this
    text or an earlier one, wherever they begin; no other word goes. Of a text that occurred before
    nothing is left.
    The white space behind a word goes with it.
    Which white space stands between words does not count. A text of which no word is left becomes
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
    found = found.select(F.col("doc_id").alias(other_id), F.col("k").alias(other_k), F.sort_array(_all_of("starts")).alias(starts))
    rows = keyed.join(found, keyed[k].eqNullSafe(found[other_k]) & keyed[doc_id].eqNullSafe(found[other_id]), "left")
    # White space that leads the text is a piece of its own; a column, so that it is looked for once.
    lead = free_name(rows, "lead")
    rows = rows.withColumn(lead, F.when(F.length(F.ltrim(F.col(text), F.lit(SPACE_CHARS))) < F.length(text), F.lit(1)).otherwise(F.lit(0)))
    # Each start adds the words that the one before it has not covered.
    fresh = F.transform(starts, lambda s, i: F.sequence(F.greatest(s, F.coalesce(F.get(starts, i - 1) + min_words, F.lit(0))) + F.col(lead), s + min_words - 1 + F.col(lead)))
    return _cut(rows.withColumn(places, F.flatten(fresh)), text, places, min_words, names, out, _WORD_CUT)
