"""Similarity join of documents by the Jaccard index of their word five-grams.

MinHash signatures are cut into bands; documents that agree in a band are candidates. They are
shuffled on band hashes, as stars around the least document of a bucket, never as pairs.
Candidates that hang together are then verified on their full n-gram sets, block against block
inside tasks: what comes out is each document's number of links and a spanning star, so a group
of a thousand near copies gives a thousand rows and not a million.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free_name, null_safe_join, row_key
from tidemark.llm.graph import components
from tidemark.session import fits, materialise

SHINGLE = 5  # words
THRESHOLD = 800  # thousandths
# At the threshold a pair agrees in at least one band with probability 1 - (1 - 0.8 ** 6) ** 26,
# 0.9996; at 0.5 with 0.34.
BANDS, ROWS = 26, 6

# What one task verifies at a time: documents and n-grams of a block.
BLOCK_DOCS, BLOCK_GRAMS = 400, 1_000_000
# Candidates up to which their keys are broadcast to the texts.
BROADCAST_CANDIDATES = 100_000

_MEMO = 500_000  # words whose hashes a worker remembers
_SIGNATURE = T.StructType([T.StructField("node", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])

_random = np.random.default_rng(20_240_501)
_STEPS = _random.integers(1 << 62, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _random.integers(0, 1 << 31, BANDS * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = _random.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_MIX = _random.integers(1 << 62, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MEMO:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, hashes: _Hashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the lower-cased text's word five-grams.

    A text of fewer words is one n-gram; one without words has none.
    """
    words = text.lower().encode("utf-8", "surrogatepass").split() if text else ()
    if not words:
        return np.empty(0, dtype=np.uint64)
    ids = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(SHINGLE, len(ids))
    grams = np.zeros(len(ids) - n + 1, dtype=np.uint64)
    for i in range(n):
        grams += ids[i : len(ids) - n + 1 + i] * _STEPS[i]
    return np.unique(_mixed(grams))


def band_hashes(grams: np.ndarray) -> np.ndarray:
    """One 64-bit value for each band of the MinHash signature."""
    low = (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, dtype=np.uint32)
    for start in range(0, len(low), 2048):
        np.minimum(least, (low[start : start + 2048, None] * _FACTORS + _SHIFTS).min(axis=0), out=least)
    rows = least.reshape(BANDS, ROWS).astype(np.uint64)
    return _mixed((rows * _MIX).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


@F.pandas_udf(_SIGNATURE)
def signature(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    hashes = _Hashes()
    for texts in batches:
        rows = []
        for text in texts:
            grams = shingles(text, hashes)
            if len(grams):
                node = np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64)
                rows.append((int(node), len(grams), band_hashes(grams)))
            else:
                rows.append((None, 0, None))
        yield pd.DataFrame(rows, columns=["node", "n_shingles", "bands"]).astype({"node": "Int64"})


@F.pandas_udf(T.BinaryType())
def gram_set(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    hashes = _Hashes()
    for texts in batches:
        yield pd.Series([shingles(text, hashes).tobytes() for text in texts], dtype=object)


def linked(sets: list[np.ndarray], threshold: int) -> np.ndarray:
    """Boolean matrix: which two of the sets are similar enough."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    gram, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    shared = times[gram] > 1
    column = np.cumsum(times > 1) - 1
    owner, gram = owner[shared], column[gram[shared]]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    # Counts below 2 ** 24 are exact in 32 bits; the columns come in slices of bounded size.
    width = max(1, 16_000_000 // len(sets))
    order = np.argsort(gram, kind="stable")
    owner, gram = owner[order], gram[order]
    start = 0
    while start < len(gram):
        end = np.searchsorted(gram, gram[start] + width)
        part = np.zeros((len(sets), int(gram[end - 1] - gram[start]) + 1), dtype=np.float32)
        part[owner[start:end], gram[start:end] - gram[start]] = 1
        common += part @ part.T
        start = end
    common = common.astype(np.int64)
    return common * 1000 >= threshold * (sizes[:, None] + sizes[None, :] - common)


def _verified(threshold: int):
    """Links and a spanning star of every component in a group of blocks."""

    def verify(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in group.groupby("component", sort=False):
            nodes, blocks = part["node"].to_numpy(), part["block"].to_numpy()
            near = linked([np.frombuffer(b, dtype=np.uint64) for b in part["grams"]], threshold)
            np.fill_diagonal(near, False)
            if part["hi"].iloc[0] != part["lo"].iloc[0]:  # pairs inside a block have a group of their own
                near &= blocks[:, None] != blocks[None, :]
            root = np.arange(len(nodes))
            for i in np.flatnonzero(near.any(axis=1)):  # flood from each node not yet reached
                if root[i] != i or not near[i].any():
                    continue
                front = np.array([i])
                reached = np.zeros(len(nodes), dtype=bool)
                reached[i] = True
                while len(front):
                    new = near[front].any(axis=0) & ~reached
                    reached |= new
                    front = np.flatnonzero(new)
                root[reached] = i
            links = near.sum(axis=1)
            out.append(pd.DataFrame({"node": nodes, "links": links.astype(np.int64), "root": nodes[root]})[links > 0])
        return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "root": []}).astype("int64")

    return verify


def similar(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: int = THRESHOLD) -> DataFrame:
    """For each row: `doc_id`, `k` (the row), `node` (its n-gram set), `n_links` and `root` (its group).

    `n_links` counts the other n-gram sets with a Jaccard index of at least `threshold`
    thousandths; `root` is the same for all that are linked directly or through others, and null
    for a row without words, which is like nothing else.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), row_key(doc_id, text).alias("k"), F.col(text).alias("text"))
    signed = materialise(rows.select("doc_id", "k", signature("text").alias("s")).select("doc_id", "k", "s.*"))
    nodes = signed.where("node IS NOT NULL").dropDuplicates(["node"])
    keys = nodes.select("node", F.posexplode("bands").alias("band", "hash")).select("node", F.xxhash64("band", "hash").alias("bucket"))
    hubs = materialise(keys.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n"))
    stars = keys.join(hubs, "bucket").where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b"))
    groups = components(stars)
    members = groups.unionAll(groups.select("root", "root").distinct()).select("node", F.col("root").alias("component"))
    members = materialise(members.join(nodes.select("node", "n_shingles", "doc_id", "k"), "node"))
    sized = members.groupBy("component").agg(F.count("*").alias("docs"), F.sum("n_shingles").alias("grams"))
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    members = members.join(materialise(sized.select("component", blocks.alias("blocks"))), "component")
    members = members.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.select("k", "doc_id", "node", "component", "blocks", "block")
    total = members.count()
    members = F.broadcast(members) if total <= BROADCAST_CANDIDATES else members
    found = rows.join(members.select("k", F.col("doc_id").alias("other_id"), "node", "component", "blocks", "block"), "k")
    # One text for each set, however often its row is repeated.
    found = found.where(F.col("doc_id").eqNullSafe(F.col("other_id"))).dropDuplicates(["node"])
    # Small components share a group; a block of a large one meets every other block of it.
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("lo"), F.greatest("block", j).alias("hi")))
    shares = max(1, total // BLOCK_DOCS)
    unit = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(shares))).otherwise(F.col("component"))
    found = found.select("node", "component", "block", F.col("blocks") == 1, unit.alias("unit"), gram_set("text").alias("grams"), pairs.alias("pairs")).toDF("node", "component", "block", "small", "unit", "grams", "pairs")
    found = found.select("node", "component", "block", "small", "unit", "grams", F.explode("pairs").alias("pair")).select("*", "pair.lo", "pair.hi").drop("pair")
    checked = found.groupBy("small", "unit", "lo", "hi").applyInPandas(_verified(threshold), "node long, links long, root long")
    checked = materialise(checked)
    links = checked.groupBy("node").agg(F.sum("links").alias("n_links"))
    roots = components(checked.select(F.col("node").alias("a"), F.col("root").alias("b"))).withColumnRenamed("root", "component")
    linked_nodes = materialise(links.join(roots, "node", "left"))
    linked_nodes = F.broadcast(linked_nodes) if fits(linked_nodes, BROADCAST_CANDIDATES) else linked_nodes
    result = signed.join(linked_nodes, "node", "left")
    return result.select("doc_id", "k", "node", "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "node").alias("root"))


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: `doc_id`, `k`, `class_id`, `n_links`, `n_copies`, `n_shingles`.

    `class_id` is the least id among the documents that are linked to it directly or through
    others, itself included. `n_links` counts the other n-gram sets with a Jaccard index of at
    least `threshold` thousandths, `n_copies` the rows with the same n-gram set. A text of fewer
    than five words is one n-gram; null, empty and wordless texts have none and are alone. Rows
    equal in id and text are copies of each other. Rows with a null id have links like any
    other. An empty table stays empty, other columns are ignored, texts are read whole.
    """
    found = materialise(similar(docs, text, doc_id, threshold))
    worded = found.where("node IS NOT NULL")
    # Both with map-side combining, and written, so that Spark can split a large group in the joins.
    classes = materialise(worded.groupBy("root").agg(F.min("doc_id").alias("class_id")).withColumnRenamed("root", "of"))
    copies = materialise(worded.groupBy("node").agg(F.count("*").alias("n_copies")).withColumnRenamed("node", "set"))
    rows = found.join(classes, F.col("root") == F.col("of"), "left").join(copies, F.col("node") == F.col("set"), "left")
    alone = F.col("node").isNull()
    return rows.select("doc_id", "k", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "n_links", F.coalesce("n_copies", F.lit(1)).alias("n_copies"), "n_shingles")


def one_of_each(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", threshold: int = THRESHOLD) -> DataFrame:
    """One row of each group of `docs` whose rows are similar directly or through others.

    Of a chain of near copies only the first stays, also where its ends are less alike than
    `threshold`: what goes is like a row of its group, not always like the one that stays.
    Of each group the row with the least id stays (null last; of one id the least row hash), and
    one of rows equal in id and text. Rows without words all stay.
    """
    found = materialise(similar(docs, text, doc_id, threshold))
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id"), F.col("k"))
    firsts = found.where("root IS NOT NULL").groupBy("root").agg(F.min(place).alias("first"))
    keep = firsts.select("first.doc_id", "first.k").unionAll(found.where("root IS NULL").select("doc_id", "k").distinct())
    times = found.where("root IS NOT NULL").groupBy("doc_id", "k").agg(F.count("*").alias("times")).where("times > 1")
    keep = materialise(null_safe_join(keep, times, ["doc_id", "k"], "left"))
    k = free_name(docs, "k")
    keyed = docs.withColumn(k, row_key(doc_id, text))
    other_id, other_k, times = (free_name(keyed, x) for x in ("other_id", "other_k", "times"))
    keep = keep.select(F.col("doc_id").alias(other_id), F.col("k").alias(other_k), F.col("times").alias(times))
    rows = keyed.join(keep, keyed[k].eqNullSafe(keep[other_k]) & keyed[doc_id].eqNullSafe(keep[other_id]))
    once = rows.where(F.col(times).isNull()).select(*docs.columns)
    again = rows.where(F.col(times).isNotNull()).dropDuplicates([k, doc_id]).select(*docs.columns)
    return once.unionAll(again)
