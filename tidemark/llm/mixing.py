"""Mixing sources to target weights.

Every document gets a hash-random key. Within each source the keys are cut into equal ranges,
sorted range by range, and a document's place is the sum of the ranges before its own plus the
running sum inside it. The mix takes whole epochs of a source while its target allows, and cuts
the last one at the word where the budget ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Hexadecimal digits of the key that name its range: 4,096 ranges in each source.
RANGE_DIGITS = 3


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, most: float) -> DataFrame:
    """Targets of the sources in `sizes` (one row per source: `source`, `source_size`).

    Sources in code point order, null last, weigh `weights`, repeating. They share `share` times
    all words by weight; a target stops at `most` times its source, and what it leaves is shared
    again. That is one water level: sources are full below a ratio of limit to weight, and
    weight times level above it.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("limit", F.lit(float(most)) * F.col("source_size"))
    everything = Window.partitionBy()
    full_before = F.sum("limit").over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("limit")
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = rows.withColumn("level", (F.lit(float(share)) * F.sum("source_size").over(everything) - full_before) / open_weight)
    fits = F.col("level") <= F.col("limit") / F.col("weight")
    rows = rows.withColumn("rank", F.row_number().over(by_ratio)).withColumn("level", F.min_by("level", F.when(fits, F.col("rank"))).over(everything))
    return rows.select("source", "source_size", F.coalesce(F.least(F.col("limit"), F.col("weight") * F.col("level")), F.col("limit")).alias("target"))


def mix(
    df: DataFrame,
    size: str = "size",
    source: str = "source",
    key: str = "doc_id",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
) -> DataFrame:
    """`df` with `source_size` (words of its source), `target` (its source's) and `taken`.

    `taken` is the number of words the mix takes of a document, repeats counted: full epochs,
    and of the last epoch the documents before the cut; the one on the cut gives the words up to
    it. The words taken of a source add up to its target, rounded down.

    The order is the MD5 of `key` as text, so reruns agree; of a null key it is the MD5 of
    nothing, and rows with one key follow by size. Rows equal in both are interchangeable. A
    null size counts as 0; a null source is a source of its own; an empty table stays empty.
    Columns already called like the three new ones, in any case, are replaced; all others may have
    any name. Only the sums per source and per range are gathered; rows move once, to their range.
    """
    names = [c for c in df.columns if c.lower() not in ("source_size", "target", "taken")]
    # The given columns travel as one, so that no name of theirs meets one of these.
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("given"),
        F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("long").alias("words"),
        F.col(f"`{source}`").isNull().alias("nameless"),
        F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("of"),
        F.md5(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).cast("binary")).alias("hash"),
    )
    rows = rows.withColumn("part", F.substring("hash", 1, RANGE_DIGITS))
    where = ["nameless", "of"]
    ranges = rows.groupBy(*where, "part").agg(F.sum("words").alias("words"))
    # One row per source; the ranges above bound what one source gathers.
    sizes = ranges.groupBy(*where).agg(F.sum("words").alias("source_size"))
    targets = source_targets(sizes.select(F.when(~F.col("nameless"), F.col("of")).alias("source"), "source_size"), weights, share, most)
    targets = targets.select(F.col("source").isNull().alias("nameless"), F.coalesce("source", F.lit("")).alias("of"), "source_size", "target")
    before = Window.partitionBy(*where).orderBy("part")
    starts = ranges.join(targets, where).withColumn("start", F.sum("words").over(before) - F.col("words")).drop("words")
    inside = Window.partitionBy(*where, "part").orderBy("hash", "words").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("place", F.sum("words").over(inside) - F.col("words")).join(starts, [*where, "part"])
    place = F.col("start") + F.col("place")
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("CAST(floor(target) AS BIGINT) DIV source_size")).otherwise(F.lit(0)).cast("long")
    rest = budget - epochs * F.col("source_size")
    taken = epochs * F.col("words") + F.greatest(F.lit(0), F.least(F.col("words"), rest - place))
    return placed.select(*[F.col("given")[c].alias(c) for c in names], "source_size", "target", taken.cast("long").alias("taken"))
