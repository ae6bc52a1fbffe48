"""Trie of the conversations' common beginnings, with totals of every node's subtree.

A node is a sequence of first turns; its name is made of hashes of the turns and their places, so
texts are read once and never shuffled. Totals go from the leaves to the root by time-forward
processing: a shard's nodes are sorted externally by reverse level, and each sends its totals to
its parent through a priority queue that spills; the parent, later in that order, takes them out.

Shards are parts of the trie that hang together. Nodes are graded by how many conversations pass
through them: up to `SHARD`, up to `SHARD` squared, and so on. A shard is a topmost node of its
grade with what hangs below it in that grade: at most `SHARD` nodes a level, however many
conversations share a beginning. Grades are worked off from the least; each time the totals of the
shard roots are summed by parent and handed to the shards of the grades above.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import fits, materialise

SHARD = 1024
# Messages of a task that wait in memory; more are kept in sorted runs on disk.
IN_MEMORY = 200_000
# Conversation ids that are joined into one string, by their value.
IDS = 65_536

NODE = ["depth", "x1", "x2"]
UNIT = ["u_depth", "u1", "u2"]


class SpillingQueue:
    """Smallest item first. Beyond `limit` items the larger part lies in sorted runs on disk; the
    files have no name and end with the task."""

    def __init__(self, limit: int = IN_MEMORY, block: int = 5_000):
        self.limit, self.block = limit, block
        self.items: list[tuple] = []
        self.heads: list[tuple] = []  # smallest item of each run, and the run

    def push(self, item: tuple) -> None:
        heapq.heappush(self.items, item)
        if len(self.items) > self.limit:
            # What comes next stays in memory.
            self.items.sort()
            keep = self.limit // 2
            run = self._run(self.items[keep:])
            del self.items[keep:]
            heapq.heappush(self.heads, (next(run), id(run), run))

    def _run(self, items: list[tuple]) -> Iterator[tuple]:
        file = tempfile.TemporaryFile()  # noqa: SIM115
        for i in range(0, len(items), self.block):
            pickle.dump(items[i : i + self.block], file)
        file.seek(0)

        def read():
            with file:
                while True:
                    try:
                        block = pickle.load(file)
                    except EOFError:
                        return
                    yield from block

        return read()

    def first(self) -> tuple | None:
        if self.heads and (not self.items or self.heads[0][0] < self.items[0]):
            return self.heads[0][0]
        return self.items[0] if self.items else None

    def pop(self) -> tuple:
        if self.heads and (not self.items or self.heads[0][0] < self.items[0]):
            item, number, run = self.heads[0]
            following = next(run, None)
            if following is None:
                heapq.heappop(self.heads)
            else:
                heapq.heapreplace(self.heads, (following, number, run))
            return item
        return heapq.heappop(self.items)


def turn_keys(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns as `conv_id`, `place` (from 1), `k1`, `k2` (hashes of role and text), `chars` (of the text).

    Turns are in order of `turn`, null first; those of equal number follow by the hashes. A null
    role or text counts as empty. Rows without `conv_id` belong to no conversation and are left out.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = df.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.xxhash64(*said).alias("k1"),
        F.xxhash64(F.lit(1), *reversed(said)).alias("k2"),
        F.length(said[1]).cast("long").alias("chars"),
    )
    own = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "k1", "k2")
    return rows.select("conv_id", F.row_number().over(own).cast("long").alias("place"), "k1", "k2", "chars")


def _paths(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row for every beginning of every conversation: the node's name, its parent's, the text's length."""
    start = conversations.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in ("place", "k1", "k2", "chars")])
    own = Window.partitionBy("conv_id").orderBy("place")
    rows = turns.select(*start.columns).unionByName(start)
    rows = rows.withColumn("depth", F.row_number().over(own).cast("long") - 1)
    # Places are part of what is hashed, so the order of turns matters although sums by XOR have none.
    rows = rows.withColumns(
        {
            "t1": F.when(F.col("depth") > 0, F.xxhash64("depth", "k1", "k2")).otherwise(F.lit(0)),
            "t2": F.when(F.col("depth") > 0, F.xxhash64("k2", "k1", "depth")).otherwise(F.lit(0)),
        }
    )
    so_far = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({"x1": F.bit_xor("t1").over(so_far), "x2": F.bit_xor("t2").over(so_far), "ends": F.lead("place").over(own).isNull()})
    return rows.select("conv_id", *NODE, F.expr("x1 ^ t1").alias("p1"), F.expr("x2 ^ t2").alias("p2"), "chars", "ends")


def _graded(paths: DataFrame, shard: int) -> DataFrame:
    """Nodes with their grade and the root of their shard."""
    limits, limit = [], shard
    while limit < 1 << 62:
        limits.append(limit)
        limit *= shard
    grade = sum((F.when(F.col("n_convs") > m, 1).otherwise(0) for m in limits), F.lit(0))
    # At most one in `shard` of the rows has such a node.
    busy = paths.groupBy(*NODE).agg(F.count("*").alias("n_convs")).where(F.col("n_convs") > shard)
    busy = materialise(busy.select(*NODE, grade.alias("grade")))
    marked = paths.join(F.broadcast(busy) if fits(busy) else busy, NODE, "left").withColumn("grade", F.coalesce("grade", F.lit(0)))
    # Fewer conversations pass through deeper nodes, so grades only fall along a conversation.
    stretch = Window.partitionBy("conv_id", "grade").orderBy("depth")
    marked = marked.withColumns({u: F.first(c).over(stretch) for u, c in zip(UNIT, NODE)})
    same = ["p1", "p2", "chars", "grade", *UNIT]
    nodes = marked.groupBy(*NODE).agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *[F.max(c).alias(c) for c in same])
    return nodes.withColumn("own_saved", (F.col("n_convs") - 1) * F.col("chars"))


def _time_forward(limit: int):
    """Function for `mapInArrow` over nodes in order of shard and reverse level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = SpillingQueue(limit)
        for batch in batches:
            rows = zip(*[batch.column(c).to_pylist() for c in (*NODE, "p1", "p2", "u_depth", "own_saved", "below", "below_leaves", "below_saved")])
            totals = []
            for depth, x1, x2, p1, p2, top, saved, children, leaves, below in rows:
                saved += below
                while (first := waiting.first()) is not None and first[:3] == (-depth, x1, x2):
                    children, leaves, saved = children + 1, leaves + first[3], saved + first[4]
                    waiting.pop()
                leaves = leaves if children else 1
                totals.append((children, leaves, saved))
                if depth > top:
                    waiting.push((1 - depth, p1, p2, leaves, saved))
            new = [pa.array(column, pa.int64()) for column in zip(*totals)] or [pa.array([], pa.int64())] * 3
            kept = [batch.column(c) for c in _KEPT]
            yield pa.RecordBatch.from_arrays([*kept, *new], [*_KEPT, "n_children", "n_leaves", "saved_tokens"])

    return run


_KEPT = ["conv_id", *NODE, "p1", "p2", "u_depth", "n_convs"]
_TOTALS = ", ".join(f"{c} BIGINT" for c in [*_KEPT, "n_children", "n_leaves", "saved_tokens"])


def _totals(nodes: DataFrame, in_memory: int) -> DataFrame:
    """All nodes with the totals of their subtrees, one grade after the other."""
    top = nodes.agg(F.max("grade")).first()[0] or 0
    done: list[DataFrame] = []
    for grade in range(top + 1):
        mine = nodes.where(F.col("grade") == grade)
        if done:
            sent = done[0]
            for part in done[1:]:
                sent = sent.unionByName(part)
            sent = sent.where("depth = u_depth AND depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("x1"), F.col("p2").alias("x2"))
            mine = mine.join(sent.agg(F.count("*").alias("below"), F.sum("n_leaves").alias("below_leaves"), F.sum("saved_tokens").alias("below_saved")), NODE, "left")
            mine = mine.fillna(0, ["below", "below_leaves", "below_saved"])
        else:
            mine = mine.withColumns({c: F.lit(0).cast("long") for c in ("below", "below_leaves", "below_saved")})
        ordered = mine.repartition(*UNIT).sortWithinPartitions(*UNIT, F.desc("depth"), "x1", "x2")
        done.append(materialise(ordered.mapInArrow(_time_forward(in_memory), _TOTALS)))
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    return found


def _joined_hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's strings, joined by commas; rows come in order of node and string."""
    node, digest, rows = None, None, []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()])], [*NODE, "ends_sha256"])

    for part in batches:
        for *name, ids in zip(*[part.column(c).to_pylist() for c in (*NODE, "ids")]):
            if name != node:
                if node is not None:
                    rows.append((*node, digest.hexdigest()))
                node, digest = name, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if rows:
            yield batch()
            rows = []
    if node is not None:
        rows.append((*node, digest.hexdigest()))
        yield batch()


def _ends(paths: DataFrame) -> DataFrame:
    """Hash of the ids that end at a node. Ids are joined range by range, each of at most `IDS`
    ids, and the strings of a node pass through one running digest: none is ever held whole."""
    ended = paths.where("ends").select(*NODE, "conv_id", F.floor(F.col("conv_id") / IDS).alias("part"))
    strings = ended.groupBy(*NODE, "part").agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    strings = strings.withColumn("ids", F.array_join(F.transform("ids", lambda i: i.cast("string")), ","))
    ordered = strings.repartition(*NODE).sortWithinPartitions(*NODE, "part")
    return ordered.select(*NODE, "ids").mapInArrow(_joined_hash, "depth BIGINT, x1 BIGINT, x2 BIGINT, ends_sha256 STRING")


def trie(turns: DataFrame, conversations: DataFrame | None = None, shard: int = SHARD, in_memory: int = IN_MEMORY) -> DataFrame:
    """Nodes of the trie of `turns` (`conv_id`, `place`, `k1`, `k2`, `chars`; see `turn_keys`).

    `conversations` (`conv_id`) names conversations that may have no turn; they end at the root.
    Per node: `conv_id` (smallest member), `depth`, `parent_conv_id` (the parent's; null for the
    root), `n_convs`, `n_children`, `n_leaves`, `saved_tokens` (over the subtree, for each node
    its text's characters times the members but one) and `ends_sha256` (of the ids that end here,
    ascending, joined by commas; of the empty string where none does).

    Two beginnings are one node if 128 bits of hashes agree. Conversations of equal turns share
    all their nodes; an empty text is a turn like any other. Without conversations there is no
    node, not even the root. Other columns are not looked at.
    """
    known = turns.select("conv_id") if conversations is None else conversations.select("conv_id").unionByName(turns.select("conv_id"))
    paths = materialise(_paths(turns, known.where("conv_id IS NOT NULL").distinct()))
    nodes = materialise(_graded(paths, shard))
    found = _totals(nodes, in_memory)
    parents = found.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("x1").alias("p1"), F.col("x2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    found = found.join(_ends(paths), NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
    none = hashlib.sha256(b"").hexdigest()
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")
    )


def with_shared_heads(turns: DataFrame, block: int = 100, heads: int = 6) -> DataFrame:
    """`turns` (see `turn_keys`) rebuilt: a conversation's first h turns come from the first one of
    its block of ids, as far as that has them, with h = crc32 of the id in decimal, modulo `heads`.

    Blocks begin at multiples of `block`, also below zero. A block without that conversation gives
    nothing. A block's first turns are joined to its conversations only, `heads` - 1 to each of at
    most `block`, so no key grows with the table.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    first = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(block))
    lenders = turns.where((F.col("conv_id") == first) & (F.col("place") < heads)).withColumnRenamed("conv_id", "first")
    borrowers = turns.select("conv_id").distinct().select("conv_id", first.alias("first"), h.alias("h")).where("h > 0")
    borrowed = borrowers.join(lenders, "first").where("place <= h").select(*turns.columns)
    return turns.where(F.col("place") > h).unionByName(borrowed)
