"""The trie of conversations against dictionaries of tuples."""

import random

import pytest

from tests.llm import brute
from tidemark.llm import prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string, depth int, x1 string, place int, grade int"


def key(row):
    return tuple((v is not None, v) for v in row)


def same(found, rows):
    assert found.columns == COLUMNS
    assert sorted((tuple(r) for r in found.collect()), key=key) == sorted(brute.trie(rows), key=key)


@pytest.mark.parametrize(("shard", "in_memory"), [(1024, 200_000), (2, 4), (3, 1)])
def test_shards_of_any_size_give_the_same_nodes(spark, shard, in_memory):
    rnd = random.Random(shard)
    rows = []
    for c in range(0, 700):
        for t in range(rnd.choice([1, 2, 3, 9])):
            rows.append((c, t if t else None, rnd.choice(["user", None, ""]), rnd.choice(["a", "bb", None, "é😀"])))
    rows += [(c, t, "user", "one beginning of many") for c in range(800, 1100) for t in range(c % 7 + 1)]
    rows += [(1203, t, "user", str(t % 5)) for t in range(400)] + [(1204, t, "user", str(t % 5)) for t in range(300)]
    rows += [(-3, 0, "user", "below zero"), (-100, 0, "user", "lends"), (-100, 1, "user", "lends"), (10**12, 0, None, None)]
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA).repartition(6)
    turns = prefix_trie.turn_keys(df)
    same(prefix_trie.trie(prefix_trie.with_shared_heads(turns), turns, shard, in_memory), rows)


def test_edges(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert prefix_trie.trie(prefix_trie.turn_keys(empty)).collect() == []
    rows = [(None, 0, "user", "nobody's"), (1, 0, "user", "x" * 300_000), (1, 1, "user", "x" * 300_000), (101, 0, "user", "x" * 300_000)]
    turns = prefix_trie.turn_keys(spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA))
    same(prefix_trie.trie(prefix_trie.with_shared_heads(turns), turns), rows)
    # Repeated rows are turns of their own; without rebuilding, both stay.
    twice = spark.createDataFrame([(5, 0, "user", "a"), (5, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    assert [(r.depth, r.n_leaves) for r in prefix_trie.trie(prefix_trie.turn_keys(twice)).orderBy("depth").collect()] == [(0, 1), (1, 1), (2, 1)]


def test_whole_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(queries.op13_prefix_trie(spark, sf), rows)


def test_the_queue_spills(tmp_path):
    rnd = random.Random(1)
    queue, items, out = prefix_trie.SpillingQueue(10, 3), [], []
    for _ in range(500):
        item = (rnd.randrange(1000), rnd.randrange(9))
        items.append(item)
        queue.push(item)
    assert queue.heads
    while queue.first() is not None:
        assert queue.first() == min(queue.first(), *queue.items[:1])
        out.append(queue.pop())
        if len(out) == 100:
            queue.push((2000, 1))
            items.append((2000, 1))
    assert out == sorted(items)
