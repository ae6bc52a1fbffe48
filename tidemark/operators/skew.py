"""Joins and ranks that stay spread out when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import fits, materialise

# Most keys that are salted; no more than so many numbers reach the driver.
HOT_KEYS = 2_000
# The sketch's error is a small part of a partition's share.
_SKETCH_SIZE = 16_384
_SKETCH_GROUPS = 256
# A group of at most so many rows is sorted by one task.
GROUP_ROWS = 1_000_000
# Tasks that a stream, whose keys cannot be counted beforehand, spreads one key over.
SALTS = 32


def hot_keys(df: DataFrame, keys) -> DataFrame | None:
    """Hashes of the keys that hold more rows than a shuffle partition should, and into how many
    parts each is dealt, so that a part is about a partition's share: hash, salts.

    One pass over the key columns with a mergeable sketch, merged in two steps: nothing
    is shuffled but sketches. Fewer keys than partitions can hold as much, and `HOT_KEYS` at
    most are taken. The answer only steers salting, it never decides which rows a result holds.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = df.select(F.xxhash64(*keys).alias("key"), (F.spark_partition_id() % _SKETCH_GROUPS).alias("part"))
    parts = hashed.groupBy("part").agg(
        F.expr(f"approx_top_k_accumulate(key, {_SKETCH_SIZE})").alias("sketch"), F.count(F.lit(1)).alias("n")
    )
    # Grouped, so that an empty table has no sketch at all.
    whole = parts.groupBy(F.lit("all")).agg(F.expr(f"approx_top_k_combine(sketch, {_SKETCH_SIZE})").alias("sketch"), F.sum("n").alias("n"))
    top = whole.select("n", F.expr(f"inline(approx_top_k_estimate(sketch, {min(HOT_KEYS, partitions)}))"))
    share = F.greatest(F.lit(1), F.ceil(F.col("n") / partitions))
    found = top.where((F.col("count") >= share) & (F.col("count") > 1)).select("item", F.least(F.ceil(F.col("count") / share) + 1, F.lit(partitions)).cast("int").alias("salts"))
    rows = [(r["item"], r["salts"]) for r in found.collect()]
    return df.sparkSession.createDataFrame(rows, "_hash BIGINT, _salts INT") if rows else None


def skew_join(left: DataFrame, right: DataFrame, on, how: str = "left", hot=None, right_stored: bool = False) -> DataFrame:
    """Equi-join of `left` with `right`, which holds a key once or a few times.

    Left rows of a hot key, and left rows without a key, are dealt to several tasks by a
    hash of the row, as many as the key holds partitions' worth of rows; the matching
    right rows are repeated for each of them. All other keys are joined as usual, so the
    right side hardly grows. A right side that is a stored table is counted first, and
    broadcast if it is small. `hot` takes what `hot_keys` found, also for a larger table.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    on = list(on)
    if right_stored and fits(right):
        return left.join(F.broadcast(right), on, how)
    hot = hot_keys(left, on) if hot is None else hot
    if hot is None:
        return left.join(right, on, how)

    def salted(df: DataFrame) -> DataFrame:
        # No more rows than there are partitions.
        marked = df.withColumn("_own", F.xxhash64(*on)).join(F.broadcast(hot), F.col("_own") == F.col("_hash"), "left")
        return marked.withColumn("_salts", F.coalesce("_salts", F.lit(1))).drop("_own", "_hash")

    spread = F.pmod(F.xxhash64(*left.columns), F.col("_salts")).cast("int")
    dealt = salted(left).withColumn("_salt", spread).drop("_salts")
    repeated = salted(right).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts")
    return dealt.join(repeated, [*on, "_salt"], how).drop("_salt")


def rank_within(
    df: DataFrame, groups, order: list[Column], name: str = "rank", largest: int | None = None
) -> DataFrame:
    """`row_number()` within `groups` by `order`, without one task per large group.

    If the `largest` group is known to be small, this is a plain window. Otherwise rows
    are range-partitioned by group and order, so a large group spans many partitions.
    Each partition numbers its own rows; a group continued from an earlier partition
    adds the rows counted there. A partition continues at most one group, so that
    table is never longer than the number of partitions.
    """
    groups = list(groups)
    if largest is not None and largest <= GROUP_ROWS:
        return df.withColumn(name, F.row_number().over(Window.partitionBy(*groups).orderBy(*order)).cast("long"))
    cut = df.repartitionByRange(*groups, *order).withColumn("_cut", F.spark_partition_id())
    # The cut points must be the same for the count and for the numbering.
    cut = materialise(cut)
    on = ["_cut", *groups]
    local = cut.withColumn(name, F.row_number().over(Window.partitionBy(*on).orderBy(*order)).cast("long"))
    counted = cut.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*groups).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    continued = (
        counted.withColumn("_before", F.sum("_rows").over(before)).where("_before is not null").drop("_rows")
    )
    return (
        local.join(F.broadcast(continued), on, "left")
        .withColumn(name, F.col(name) + F.coalesce("_before", F.lit(0)))
        .drop("_cut", "_before")
    )
