"""Line deduplication by winnowing over line hashes.

A line that holds several sentences is cut at its sentence ends, so that a passage inside a long
line is a run of pieces like any other. Over the hashes of neighbouring pairs of pieces, window
minima are the fingerprints: of any two neighbouring pairs one is chosen, so a run of three
pieces that two documents share has a fingerprint in both. A piece of `min_words` words is a
fingerprint by itself. A fingerprint that occurred before marks its pieces as repeated. As the
next fingerprint of a shared run is at most two pieces on, a match reaches at most one piece
beyond the first and the last one, and the hashes of the neighbours, which travel with the
fingerprint, decide that: matches are extended both ways without reading the other text again.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CHARS, free_name, row_key, word_count
from tidemark.session import materialise

# Repeated runs of fewer words stay.
MIN_WORDS = 25
# Cuts in front of a line with a word, and of a sentence; nothing is lost.
_CUT = r"(?<=\n)(?=[\x20\t]*\S)|(?<=[.!?]\x20)(?=\S)"


def pieces_of(text: Column, cut: str = _CUT) -> Column:
    """Lines, cut at sentence ends, with the white space behind them; joined they are the text."""
    return F.split(F.coalesce(text, F.lit("")), cut)


def _short(hash64: Column) -> Column:
    return hash64.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")


def hashed_pieces(docs: DataFrame, text: str, doc_id: str, min_words: int) -> DataFrame:
    """`h`, the hashes of each row's pieces, and `long`, which of them have `min_words` words."""
    # White space around a piece does not count.
    bare = F.transform(pieces_of(F.col(text)), lambda p: F.when(F.endswith(p, F.lit("\n")), F.btrim(p, F.lit(SPACE_CHARS))).otherwise(F.trim(p)))
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("k"), bare.alias("pieces"))

    def is_long(piece: Column) -> Column:
        """By its spaces, which are at least as many as the words less one."""
        return (F.length(piece) >= 2 * min_words - 1) & (F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit(""))) >= min_words - 1)

    return rows.select("doc_id", "k", F.transform("pieces", lambda p: F.xxhash64(p)).alias("h"), F.transform("pieces", is_long).alias("long"))


def fingerprints(rows: DataFrame) -> DataFrame:
    """Fingerprints of hashed rows: `f`, the row (`doc_id`, `k`), `pos`, `n` pieces, neighbours `left` and `right`."""
    n = F.size("h")
    rows = rows.withColumn("pairs", F.slice(F.zip_with("h", F.slice("h", F.lit(2), n), lambda a, b: F.xxhash64(a, b)), F.lit(1), n - 1))

    def chosen(pair: Column, i: Column) -> Column:
        """Whether the pair is the minimum of the window it opens or closes; of equal ones the first."""
        return (F.size("pairs") == 1) | F.coalesce(pair <= F.get("pairs", i + 1), F.lit(False)) | F.coalesce(pair < F.get("pairs", i - 1), F.lit(False))

    def fingerprint(f: Column, i: Column, n: int) -> Column:
        return F.struct(f.alias("f"), i.alias("pos"), F.lit(n).alias("n"), _short(F.get("h", i - 1)).alias("left"), _short(F.get("h", i + n)).alias("right"))

    prints = F.concat(
        F.transform("pairs", lambda p, i: F.when(chosen(p, i), fingerprint(p, i, 2))),
        F.transform("h", lambda h, i: F.when(F.get("long", i), fingerprint(h, i, 1))),
    )
    prints = F.filter(prints, lambda p: p.isNotNull())
    return rows.select("doc_id", "k", F.explode(prints).alias("p")).select("doc_id", "k", "p.*")


def repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS) -> DataFrame:
    """Places of pieces that occurred before, for each row with any: `doc_id`, `k`, sorted `places`.

    "Before" is by id (null first), then by the row's hash, then by position; the first
    occurrence of a fingerprint stays. First occurrences are found with map-side combining, and
    a fingerprint that half the documents share is one key of a plain inner join, which Spark
    splits when it is skewed.
    """
    prints = fingerprints(materialise(hashed_pieces(docs, text, doc_id, min_words)))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "k", "pos", "left", "right")
    firsts = prints.groupBy("f", "n").agg(F.min(place).alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    # Written, so that both sides of the join are shuffled for it and a skewed key can be split.
    firsts = materialise(firsts)
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("k") == F.col("first.k")) & (F.col("pos") == F.col("first.pos"))
    later = prints.join(firsts, ["f", "n"]).where(~is_first)
    begin = F.col("pos") - F.when(F.col("left") == F.col("first.left"), F.lit(1)).otherwise(F.lit(0))
    last = F.col("pos") + F.col("n") - F.when(F.col("right") == F.col("first.right"), F.lit(0)).otherwise(F.lit(1))
    later = later.select("doc_id", "k", F.sequence(begin, last).alias("places"))
    # No more of them in a document than it has pieces.
    return later.groupBy("doc_id", "k").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set("places")))).alias("places"))


def _cut(df: DataFrame, text: str, places: str, min_words: int, names: list[str], out: str, cut: str = _CUT) -> DataFrame:
    """Cuts the runs of neighbouring `places` out of the text, if they have `min_words` words."""
    pieces, runs, total = free_name(df, "pieces"), free_name(df, "runs"), free_name(df, "total")
    marked = F.col(places)
    begins = F.filter(marked, lambda p, i: F.coalesce(p - F.get(marked, i - 1) > 1, F.lit(True)))
    ends = F.transform(F.filter(marked, lambda p, i: F.coalesce(F.get(marked, i + 1) - p > 1, F.lit(True))), lambda p: p + 1)
    df = df.withColumn(pieces, F.when(marked.isNotNull(), pieces_of(F.col(text), cut))).withColumn(runs, F.arrays_zip(begins.alias("begin"), ends.alias("end")))

    def joined(begin: Column, end: Column) -> Column:
        return F.array_join(F.slice(F.col(pieces), begin + 1, end - begin), "")

    sized = F.transform(runs, lambda r: F.struct(r["begin"].alias("begin"), r["end"].alias("end"), word_count(joined(r["begin"], r["end"])).alias("words")))
    df = df.withColumn(runs, F.filter(sized, lambda r: r["words"] >= min_words))
    removed = F.aggregate(F.transform(runs, lambda r: r["words"]), F.lit(0).cast("long"), lambda a, b: a + b)
    df = df.withColumn(total, F.when(F.size(runs) > 0, removed))
    from_, to = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["end"])), F.concat(F.transform(runs, lambda r: r["begin"]), F.array(F.size(pieces)))
    rest = F.array_join(F.zip_with(from_, to, joined), "")
    rest = F.when(F.btrim(rest, F.lit(SPACE_CHARS)) == "", F.lit("")).otherwise(rest)
    kept = F.when(F.col(total) > 0, rest).otherwise(F.col(text))
    both = F.struct(kept.alias(out), F.coalesce(F.col(total), F.lit(0).cast("long")).alias("removed_words"))
    # Unfolded from an array of one, so that a filter on the result does not cut the text again.
    done = free_name(df, "done")
    return df.select(*names, F.explode(F.array(both)).alias(done)).select(*names, f"{done}.{out}", f"{done}.removed_words")


def dedup_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_words: int = MIN_WORDS, out: str = "kept_text") -> DataFrame:
    """`docs` with `out`, the text without its later repeated runs, and `removed_words`.

    A run is a longest stretch of neighbouring pieces that occurred before, in this text or an
    earlier one; runs of fewer than `min_words` words stay. Any passage of which three whole
    pieces, or one piece of `min_words` words, occurred before is found. A text of which no word
    is left becomes empty. Null stays null; empty texts, and texts without a repeat, come out
    unchanged. Rows equal in id and text are one document and treated alike; rows with one id
    and different texts are ordered by hash. An empty table stays empty; columns already called
    like the new ones are replaced.
    """
    found = materialise(repeated(docs, text, doc_id, min_words))
    names = [c for c in docs.columns if c.lower() not in (out.lower(), "removed_words")]
    k = free_name(docs, "k")
    keyed = docs.withColumn(k, row_key(doc_id, text))
    other_id, other_k, places = (free_name(keyed, x) for x in ("other_id", "other_k", "places"))
    found = found.select(F.col("doc_id").alias(other_id), F.col("k").alias(other_k), F.col("places").alias(places))
    rows = keyed.join(found, keyed[k].eqNullSafe(found[other_k]) & keyed[doc_id].eqNullSafe(found[other_id]), "left")
    return _cut(rows, text, places, min_words, names, out)
