from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark import reassign_periods, reconcile
from tidemark.operators import skew
from tidemark.operators.inventory import list_paths, reconcile_status, with_folders
from tidemark.operators.reassign import free_names
from tidemark.operators.skew import rank_within, skew_join


def paths_of(spark, *paths):
    return spark.createDataFrame([(p.rstrip("/"), p.endswith("/")) for p in paths], "path STRING, is_dir BOOLEAN")


def test_listing(spark, tmp_path):
    (tmp_path / "a" / "empty").mkdir(parents=True)
    (tmp_path / "a" / "_x.pdf").write_bytes(b"12345")
    (tmp_path / "zero.pdf").write_bytes(b"")
    listed = list_paths(spark, str(tmp_path))
    assert sorted(map(tuple, listed.collect())) == [
        (f"{tmp_path}/a", True, None), (f"{tmp_path}/a/_x.pdf", False, 5), (f"{tmp_path}/a/empty", True, None),
        (f"{tmp_path}/zero.pdf", False, 0),
    ]
    assert list_paths(spark, str(tmp_path / "a" / "empty")).count() == 0


def test_folders_of_files(spark):
    files = spark.createDataFrame([("/a/b/x",), ("/a/y",), ("z",)], "path STRING")
    assert sorted(map(tuple, with_folders(files).collect())) == [
        ("/a", True), ("/a/b", True), ("/a/b/x", False), ("/a/y", False), ("z", False),
    ]


def test_reconciling(spark):
    rows = [
        ("kept", "/d/a.pdf"), ("folder", "/d/f"), ("repaired", "/d/z.zip"), ("upper", "/d/u.ZIP"), ("blank", ""), ("null", None),
        ("gone", "/d/gone.pdf"), ("file-not-folder", "/d/n.zip"), ("spelling", "/d/s.ZIP"), ("both", "/d/b.zip"), ("no-folder", "/d/q.zip"),
    ]
    manifest = spark.createDataFrame([(k, p, "old") for k, p in rows], "url STRING, saved_path STRING, filename STRING")
    present = paths_of(spark, "/d/a.pdf", "/d/f/", "/d/z/", "/d/u/", "/d/n", "/d/s.zip", "/d/b.zip", "/d/b/")
    kept, removed = reconcile(manifest, present)
    assert {r["url"]: (r["saved_path"], r["filename"]) for r in kept.collect()} == {
        "kept": ("/d/a.pdf", "old"), "folder": ("/d/f", "old"), "repaired": ("/d/z", "z"), "upper": ("/d/u", "u"), "both": ("/d/b.zip", "old"),
    }
    assert {r["url"] for r in removed.collect()} == {"blank", "null", "gone", "file-not-folder", "spelling", "no-folder"}


def test_rows_without_a_path_do_not_gather_in_one_task(spark):
    manifest = spark.range(3000).selectExpr("id AS seq", "if(id % 3 = 0, null, concat('/d/', id)) AS saved_path", "'f' AS filename")
    judged = reconcile_status(manifest, manifest.selectExpr("concat('/d/', seq) AS path", "false AS is_dir"))
    assert {r[0]: r[1] for r in judged.groupBy("status").count().collect()} == {"kept": 2000, "removed": 1000}
    assert "_salt" in judged._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join_equals_a_plain_one(spark, how):
    left = spark.range(2000).selectExpr("id", "if(id % 3 = 0, 7, if(id % 5 = 0, null, id)) AS k")
    right = spark.range(0, 2000, 7).selectExpr("id AS k", "id * 2 AS v")
    salted, plain = skew_join(left, right, ["k"], how), left.join(right, ["k"], how)
    assert "_salt" in salted._jdf.queryExecution().analyzed().toString()
    assert sorted(map(str, salted.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    stored = skew_join(left, right, ["k"], how, right_stored=True)
    assert sorted(map(str, stored.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_ranks_across_partitions(spark):
    rows = spark.range(5000).selectExpr("id", "if(id % 3 < 2, 'hot', concat('g', id % 40)) AS g", "pmod(hash(id), 1000) AS o")
    order = [F.col("o").desc(), F.col("id")]
    far = rank_within(rows.repartition(7), ["g"], order)
    near = rank_within(rows, ["g"], order, largest=5000)
    assert {(r["id"], r["rank"]) for r in far.collect()} == {(r["id"], r["rank"]) for r in near.collect()}


def named_one_by_one(incoming, taken):
    """The same names, given out one by one."""
    names, held = {}, defaultdict(set)
    for folder, name in taken:
        held[folder].add(name)
    present = {f: set(n) for f, n in held.items()}
    natural = defaultdict(set)
    for folder, name, _, _ in incoming:
        natural[folder].add(name)
    for folder, name, is_dir, item in sorted(incoming, key=lambda r: r[3]):
        used = held[folder]
        if name not in used:
            names[item] = name
        else:
            dot = name.rfind(".")
            head, tail = (name, "") if is_dir or not 0 < dot < len(name) - 1 else (name[:dot], name[dot:])
            number = 1
            while f"{head}_{number}{tail}" in used | natural[folder] | present.get(folder, set()):
                number += 1
            names[item] = f"{head}_{number}{tail}"
        used.add(names[item])
    return names


CROWD = [("/f", n, d, i) for i, (n, d) in enumerate(
    [("a.pdf", False)] * 5 + [("a_1.pdf", False)] * 2 + [(".hidden", False)] * 2 + [("a.tar.gz", False)] * 3
    + [("dir.x", True)] * 3 + [("alone.pdf", False), ("none", False), ("none", False)] + [("many.pdf", False)] * 60
)] + [("/g", "a.pdf", False, 1000)]
TAKEN = [("/f", n) for n in ("a.pdf", "a_2.pdf", "a.tar_1.gz", "dir.x", "dir_1.x", "dir.x_2", "many_7.pdf", "many_07.pdf", "many_59.pdf")]


@pytest.mark.parametrize("group_rows", [1_000_000, 0])
def test_free_names(spark, monkeypatch, group_rows):
    monkeypatch.setattr(skew, "GROUP_ROWS", group_rows)
    incoming = spark.createDataFrame(CROWD, "folder STRING, name STRING, is_dir BOOLEAN, item BIGINT")
    taken = spark.createDataFrame(TAKEN, "folder STRING, name STRING")
    got = {r["item"]: r["new_name"] for r in free_names(incoming, taken).collect()}
    assert got == named_one_by_one(CROWD, TAKEN)
    assert [got[i] for i in range(5)] == ["a_3.pdf", "a_4.pdf", "a_5.pdf", "a_6.pdf", "a_7.pdf"]


@pytest.mark.parametrize("group_rows", [1_000_000, 0])
def test_numbers_far_apart_are_gaps(spark, monkeypatch, group_rows):
    """Taken numbers of any size cost a row each, the free ones between them nothing."""
    monkeypatch.setattr(skew, "GROUP_ROWS", group_rows)
    names = [("/f", "a.pdf", False, i) for i in range(40)]
    taken = [("/f", "a.pdf"), *[("/f", f"a_{n}.pdf") for n in (1, 2, 5, 9, 10, 11, 30, 10**6, 10**17)]]
    incoming = spark.createDataFrame(names, "folder STRING, name STRING, is_dir BOOLEAN, item BIGINT")
    found = free_names(incoming, spark.createDataFrame(taken, "folder STRING, name STRING"))
    assert {r["item"]: r["new_name"] for r in found.collect()} == named_one_by_one(names, taken)
    plan = found._jdf.queryExecution().analyzed().toString()
    assert "sequence(" not in plan


def test_no_collisions(spark):
    incoming = spark.createDataFrame([("/f", "a", False, 1)], "folder STRING, name STRING, is_dir BOOLEAN, item BIGINT")
    taken = spark.createDataFrame([("/f", "b")], "folder STRING, name STRING")
    assert [r["new_name"] for r in free_names(incoming, taken).collect()] == ["a"]


@pytest.mark.parametrize("strict", [False, True])
def test_reassigning(spark, strict):
    inventory = paths_of(
        spark, "/d/1996/", "/d/1997/", "/d/1996/statyearbk96_0.pdf", "/d/1996/1997_table.xls", "/d/1996/table-97.xls",
        "/d/1996/sub/", "/d/1996/sub/table-97.xls", "/d/1996/sub/x-96.pdf", "/d/1996/part-98/", "/d/1996/part-98/y-99.pdf",
        "/d/1996/part-98/more/", "/d/1996/part-98/more/z.pdf", "/d/1996/own-96/", "/d/1996/own-96/k.pdf",
        "/d/1996/plain.pdf", "/d/1997/table-97.xls", "/d/1998/part-98/", "/d/2001/a-97.pdf",
    )
    moves = reassign_periods(inventory, "/d", strict=strict)
    got = {r["old_path"]: (r["new_path"], r["is_root"]) for r in moves.collect()}
    expected = {
        # by path, the one in "sub" comes first
        "/d/1996/sub/table-97.xls": ("/d/1997/table-97_1.xls", True),
        "/d/1996/table-97.xls": ("/d/1997/table-97_2.xls", True),
        "/d/1996/sub/x-96.pdf": ("/d/1996/x-96.pdf", True),
        "/d/1996/part-98": ("/d/1998/part-98_1", True),
        "/d/1996/part-98/y-99.pdf": ("/d/1998/part-98_1/y-99.pdf", False),
        "/d/1996/part-98/more": ("/d/1998/part-98_1/more", False),
        "/d/1996/part-98/more/z.pdf": ("/d/1998/part-98_1/more/z.pdf", False),
    }
    if not strict:
        expected["/d/1996/1997_table.xls"] = ("/d/1997/1997_table.xls", True)
    assert got == expected


def test_a_key_of_a_few_thousandths_is_salted_on_many_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        rows = spark.range(100_000).selectExpr("if(id % 250 = 0, -1, id) AS k", "id")
        found = skew.hot_keys(rows, ["k"]).collect()
        wanted = rows.where("k = -1").selectExpr("xxhash64(k) AS h").first()["h"]
        assert [(r["_hash"], r["_salts"]) for r in found] == [(wanted, 5)]
        assert skew.hot_keys(rows.limit(0), ["k"]) is None
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
