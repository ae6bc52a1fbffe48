"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """`node` and `root`, the least node of its component, for every node of `edges` but the roots.

    `edges` has two long columns, `a` and `b`. Every round links each node's greater neighbours
    to its least neighbour, then each node to the least of its lesser neighbours, until nothing
    changes (large-star, small-star). Neighbours are never gathered: a node's least neighbour is
    an aggregate with map-side combining. It is written before it is joined back to the edges, so
    that both sides are shuffled for the join and Spark can split a node with very many edges.
    Each round's edges are written to the shared folder as well; what reaches the driver is their
    number and a checksum.
    """
    current = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    seen = None
    while True:
        current = materialise(current)
        now = current.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("b", "a") % 1_000_003).alias("s")).first()
        if now == seen or not now["n"]:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(current.select("b", "a"))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        large = materialise(large)
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        current = small.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
