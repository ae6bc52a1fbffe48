"""Benchmark decontamination by a broadcast hash set of n-grams.

Windows of the benchmark's words are hashed; so are the windows of every document, from hashes
of one, two, four and eight words, so that a window of any length costs a few hashes instead of
one per word. Windows found in the hash set are verified word by word, and what they cover is
counted. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, null_safe_join, row_key
from tidemark.session import fits, materialise

WINDOW = 13
# Windows of the benchmark up to which their hashes are broadcast; a larger set is joined by shuffle.
BROADCAST_WINDOWS = 500_000
# Documents with a hit up to which their keys are broadcast to the texts.
BROADCAST_HITS = 200_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, cut at every ASCII character that is no letter or digit."""
    whole = F.coalesce(text, F.lit(""))
    low = F.when(F.length(whole) == F.octet_length(whole), F.lower(whole)).otherwise(F.translate(whole, _UPPER, _LOWER))
    return F.filter(F.split(low, _BETWEEN), lambda w: w != "")


def _with_windows(df: DataFrame, lengths: list[int]) -> DataFrame:
    """`df` (with `words`) and a column `h<n>`: the hash of the `n` words from each place on.

    Places where fewer than `n` words are left hold values without meaning.
    """

    def joined(a: str, b: str, shift: int) -> Column:
        return F.zip_with(F.col(a), F.slice(F.col(b), shift + 1, F.greatest(F.size(b) - shift, F.lit(0))), lambda x, y: F.xxhash64(x, y))

    df = df.withColumn("p1", F.transform("words", lambda w: F.xxhash64(w)))
    for power in (2, 4, 8):
        if power <= max(lengths):
            df = df.withColumn(f"p{power}", joined(f"p{power // 2}", f"p{power // 2}", power // 2))
    for length in lengths:
        parts = [power for power in (8, 4, 2, 1) if length & power]
        name, done = f"p{parts[0]}", parts[0]
        for power in parts[1:]:
            df = df.withColumn(f"w{length}_{done + power}", joined(name, f"p{power}", done))
            name, done = f"w{length}_{done + power}", done + power
        df = df.withColumn(f"h{length}", F.col(name))
    return df


def _count(length: int) -> Column:
    """Number of windows of `length` words in a document of `n` words."""
    return F.greatest(F.col("n") - (length - 1), F.lit(0))


def benchmark_windows(items: DataFrame, text: str, item_id: str) -> DataFrame:
    """Distinct windows: `h`, `length`, `words`, and `items`, the ids that hold them as text."""
    rows = items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("words")).withColumn("n", F.size("words")).where("n > 0")
    rows = rows.withColumn("length", F.least("n", F.lit(WINDOW)))
    places = F.sequence(F.lit(1), F.col("n") - F.col("length") + 1)
    rows = rows.select("item", "length", F.explode(F.transform(places, lambda i: F.slice("words", i, F.col("length")))).alias("words"))
    rows = rows.groupBy("length", "words").agg(F.collect_set("item").alias("items"))
    rows = rows.withColumn("n", F.col("length"))
    return materialise(rows)


def _hashed(windows: DataFrame, lengths: list[int]) -> DataFrame:
    rows = _with_windows(windows, lengths)
    chosen = F.coalesce(*[F.when(F.col("length") == n, F.col(f"h{n}")[0]) for n in lengths])
    return rows.select(chosen.alias("h"), "length", F.col("words").alias("window"), "items")


def scan(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", item_text: str = "text", item_id: str = "item_id") -> DataFrame:
    """Verified hits of each document with at least one: `doc_id`, `k` (its row), `hits`.

    `hits` lists `pos` (first word, from 0), `length` and `items` (ids as text) by place. The
    benchmark's windows are the only thing that may be broadcast, after a count; a set that is
    too large is joined by shuffle.
    """
    windows = benchmark_windows(items, item_text, item_id)
    lengths = sorted(r["length"] for r in windows.select("length").distinct().collect())
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("k"), F.col(text).alias("text"))
    if not lengths:
        hits = F.lit(None).cast("array<struct<pos:int,length:int,items:array<string>>>")
        return rows.where(F.lit(False)).select("doc_id", "k", hits.alias("hits"))
    hashed = materialise(_hashed(windows, lengths))
    spread = rows.select("doc_id", "k", words_of(F.col("text")).alias("words")).withColumn("n", F.size("words"))
    spread = _with_windows(spread.where(F.col("n") >= min(lengths)), lengths)
    every = F.concat(*[F.slice(f"h{n}", F.lit(1), _count(n)) for n in lengths])
    # The place in the joined list tells length and position.
    spread = spread.select("doc_id", "k", "n", F.posexplode(every).alias("at", "h"))
    offset, offsets = F.lit(0), []
    for n in lengths:
        offsets.append((n, offset))
        offset = offset + _count(n)
    known = hashed.groupBy("h", "length").agg(F.count("*").alias("_windows")).drop("_windows")
    known = F.broadcast(known) if fits(known, BROADCAST_WINDOWS) else known
    start = F.coalesce(*[F.when(F.col("length") == n, F.col("at") - o) for n, o in offsets])
    inside = F.coalesce(*[F.when(F.col("length") == n, (F.col("at") >= o) & (F.col("at") < o + _count(n))) for n, o in offsets])
    found = spread.join(known, "h").where(inside).select("doc_id", "k", "h", "length", start.alias("pos")).distinct()
    # One row per document, its places as an array: no more of them than it has words.
    found = materialise(found.groupBy("doc_id", "k").agg(F.collect_list(F.struct("pos", "length", "h")).alias("found")))
    # The words of the few documents with a hit; all others are left behind at the scan.
    keys = found.select("k").distinct()
    keys = F.broadcast(keys) if fits(keys, BROADCAST_HITS) else keys
    hit_texts = null_safe_join(rows.join(keys, "k", "left_semi").dropDuplicates(["doc_id", "k"]), found, ["doc_id", "k"])
    places = hit_texts.select("doc_id", "k", words_of(F.col("text")).alias("words"), "found")
    places = places.select("doc_id", "k", F.explode(F.transform("found", lambda f: F.struct(f["pos"].alias("pos"), f["length"].alias("length"), f["h"].alias("h"), F.slice("words", f["pos"] + 1, f["length"]).alias("window")))).alias("f")).select("doc_id", "k", "f.*")
    checked = places.join(hashed, ["h", "length", "window"])
    by_place = F.sort_array(F.collect_list(F.struct("pos", "length", "items")))
    return checked.groupBy("doc_id", "k").agg(by_place.alias("hits"))


def covered(hits: Column) -> Column:
    """Number of words that at least one of the sorted hits covers."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

    def step(state, hit):
        end = F.greatest(state["end"], hit["pos"] + hit["length"])
        return F.struct(end.alias("end"), (state["n"] + F.greatest(F.lit(0), hit["pos"] + hit["length"] - F.greatest(state["end"], hit["pos"]))).alias("n"))

    return F.aggregate(hits, start, step, lambda state: state["n"])


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_text: str = "text",
    item_id: str = "item_id",
    per_mille: int = 50,
) -> DataFrame:
    """`doc_id`, `k` (the row), `n_words`, `n_hit`, `item_ids` (sorted as text) and `contaminated` of each row.

    A window is 13 consecutive words of an item, or all words of a shorter one. A document word
    inside any occurrence of a window is hit; a document is contaminated if at least `per_mille`
    thousandths of its words are. Null and wordless texts have no hits, nor has anything if the
    benchmark is empty; an item without words or without an id counts for nothing in `item_ids`.
    Rows equal in id and text get equal results. Very long texts are read whole. Extra columns,
    whatever their names, are not looked at.
    """
    found = scan(docs, items, text, doc_id, item_text, item_id)
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    found = found.select("doc_id", "k", covered(F.col("hits")).cast("long").alias("n_hit"), ids.alias("item_ids"))
    found = materialise(found)
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("k"), F.size(words_of(F.col(text))).cast("long").alias("n_words"))
    found = F.broadcast(found) if fits(found, BROADCAST_HITS // 10) else found
    rows = null_safe_join(rows, found, ["doc_id", "k"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.select(
        "doc_id",
        "k",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (n_hit * 1000 >= F.col("n_words") * per_mille)).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", per_mille: int = 50) -> DataFrame:
    """The rows of `docs` that `decontaminate` does not call contaminated, with all their columns."""
    judged = decontaminate(docs, items, text, doc_id, per_mille=per_mille).where("contaminated").select("doc_id", "k").distinct()
    judged = materialise(judged)
    judged = F.broadcast(judged) if fits(judged, BROADCAST_HITS) else judged
    k = free_name(docs, "k")
    keyed = docs.withColumn(k, row_key(doc_id, text))
    bad_id, bad_k = free_name(keyed, "bad_id"), free_name(keyed, "bad_k")
    bad = judged.select(F.col("doc_id").alias(bad_id), F.col("k").alias(bad_k))
    return keyed.join(bad, keyed[k].eqNullSafe(bad[bad_k]) & keyed[doc_id].eqNullSafe(bad[bad_id]), "left_anti").drop(k)
