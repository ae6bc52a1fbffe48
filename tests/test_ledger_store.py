"""States of the ledger: what a write touches, what a failure leaves, what the index holds."""

import random

import pytest
from pyspark.sql import functions as F

from tests.plans import physical
from tidemark import latest_manifest, repoint
from tidemark.plans.ledger_run import clean_ledger, run_ledger
from tidemark.sources.ledger_store import LedgerStore
from tidemark.sources.schemas import MANIFEST, OBSERVATION

LAYOUT = "period STRING, url STRING, version INT, saved_path STRING"


def ledger_rows(spark, rows):
    df = spark.createDataFrame(rows, LAYOUT)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in MANIFEST])


def given(df):
    return sorted(((r["period"], r["url"], r["version"], r["saved_path"], r["seq"]) for r in df.collect()), key=str)


def same_index(store):
    assert given(store.latest()) == given(latest_manifest(store.read()))


def test_index_and_rows_agree_after_any_writes(spark, tmp_path):
    rnd = random.Random(11)
    store, plain, batch = LedgerStore(spark, str(tmp_path / "l"), buckets=3), [], 0
    periods = ["2020", "2021", "a/b=c%", None]
    for step in ("append", "append", "replay", "rewrite", "replay", "append", "replace", "replay", "replay-nothing", "rewrite-nothing", "append"):
        rows = [(rnd.choice(periods), f"u{rnd.randrange(9)}", rnd.randrange(1, 4), f"/{step}/{i}") for i in range(rnd.randrange(1, 15))]
        if step == "append":
            store.append(ledger_rows(spark, rows), batch)
            plain += [(*r, batch) for r in rows]
            batch += 1
        elif step.startswith("replay"):
            again = rnd.randrange(batch)
            rows = rows if step == "replay" else []
            store.append(ledger_rows(spark, rows), again)
            plain = [r for r in plain if r[4] != again] + [(*r, again) for r in rows]
        elif step == "replace":
            store.replace(store.read().where("url <> 'u3'"))
            plain = [r for r in plain if r[1] != "u3"]
        else:
            chosen = ["2020", None]
            gone = step == "rewrite-nothing"
            store.rewrite(store.read(periods=chosen).withColumn("saved_path", F.lit("/new")).where(F.lit(not gone)), chosen)
            plain = [(*r[:3], "/new", r[4]) if r[0] in chosen else r for r in plain if not (gone and r[0] in chosen)]
        assert given(store.read()) == sorted(plain, key=str), step
        assert given(store.read(before=1)) == sorted((r for r in plain if r[4] < 1), key=str)
        same_index(store)
        assert given(LedgerStore(spark, str(tmp_path / "l")).latest()) == given(store.latest())


def test_a_rewrite_leaves_other_periods_folders(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "l"))
    store.append(ledger_rows(spark, [(str(2000 + i % 10), f"u{i}", 1, f"/d/{i}") for i in range(100)]), 0)
    before = store.state()
    moves = spark.createDataFrame([("2003", "u13", "/e/13")], "period STRING, url STRING, new_path STRING")
    store.rewrite(repoint(store.read(periods=["2003"]), moves), ["2003"])
    after = store.state()
    assert {p for p in before.rows if p.period != "2003"} == {p for p in after.rows if p.period != "2003"}
    assert {p for p in before.latest if p.period != "2003"} == {p for p in after.latest if p.period != "2003"}
    assert {r["saved_path"] for r in store.read().where("url = 'u13'").collect()} == {"/e/13"}
    same_index(store)
    with pytest.raises(ValueError, match="other periods"):
        store.rewrite(store.read(), ["2003"])


def test_cleaning_writes_touched_periods_only(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "l"))
    store.append(ledger_rows(spark, [(str(2000 + i % 10), f"u{i}", 1, f"/d/{i}") for i in range(100)]), 0)
    paths = spark.range(100).selectExpr("concat('/d/', id) AS path", "false AS is_dir")
    before = store.state()
    assert {r[0]: r[1] for r in clean_ledger(store, paths).collect()} == {"kept": 100}
    assert store.state() == before
    assert {r[0]: r[1] for r in clean_ledger(store, paths.where("path <> '/d/42'")).collect()} == {"kept": 99, "removed": 1}
    assert {p.period for p in set(before.rows) - set(store.state().rows)} == {"2002"}
    assert store.read().count() == 99
    same_index(store)


def test_compaction_gathers_crowded_periods(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "l"))
    for batch in range(5):
        store.append(ledger_rows(spark, [("busy", f"u{batch}", 1, f"/d/{batch}")] + [("calm", "v", 1, "/v")] * (batch == 2)), batch)
    before = given(store.read())
    assert store.compact(most=5) == [] and store.compact(most=3) == ["busy"]
    assert sorted(p.period for p in store.state().rows) == ["busy", "calm"]
    assert given(store.read()) == before
    store.append(ledger_rows(spark, [("busy", "u1", 7, "/again")]), 1)
    assert {(r["url"], r["version"]) for r in store.read().where("seq = 1").collect()} == {("u1", 7)}
    same_index(store)


def test_a_failing_write_is_not_seen(spark, tmp_path, monkeypatch):
    store, reader = LedgerStore(spark, str(tmp_path / "l")), LedgerStore(spark, str(tmp_path / "l"))
    store.append(ledger_rows(spark, [("p", "a", 1, "/a"), ("q", "b", 1, "/b")]), 0)
    seen = given(reader.read())

    def broken(*_):
        raise OSError("no room")

    for name in ("_commit", "_indexed"):
        for write in (
            lambda: store.append(ledger_rows(spark, [("p", "a", 2, "/a2")]), 0),
            lambda: store.append(ledger_rows(spark, [("p", "a", 2, "/a2")]), 1),
            lambda: store.rewrite(store.read(periods=["p"]), ["p"]),
            lambda: store.replace(store.read()),
        ):
            with monkeypatch.context() as patched:
                patched.setattr(store, name, broken)
                with pytest.raises(OSError):
                    write()
            assert given(reader.read()) == given(store.read()) == seen
            same_index(reader)
    with pytest.raises(OSError), store.run():
        store.append(ledger_rows(spark, [("p", "c", 1, "/c")]), 1)
        assert store.read().count() == 3 and reader.read().count() == 2
        broken()
    assert given(reader.read()) == given(store.read()) == seen
    with store.run():
        store.append(ledger_rows(spark, [("p", "c", 1, "/c")]), 1)
        store.rewrite(store.read(periods=["q"]).withColumn("saved_path", F.lit("/q")), ["q"])
        assert given(reader.read()) == seen
    assert len(reader._commits()) == 2 and reader.read().count() == 3
    same_index(reader)


def test_a_commit_is_written_once(spark, tmp_path, monkeypatch):
    store = LedgerStore(spark, str(tmp_path / "l"))
    store.append(ledger_rows(spark, [("p", "a", 1, "/a")]), 0)
    monkeypatch.setattr(store, "_commits", lambda: [])
    with pytest.raises(Exception, match="(?i)exist"):
        store.append(ledger_rows(spark, [("p", "b", 1, "/b")]), 1)
    monkeypatch.undo()
    assert [r["url"] for r in store.read().collect()] == ["a"]


def test_a_run_reads_the_index_only(spark, tmp_path, monkeypatch):
    store = LedgerStore(spark, str(tmp_path / "l"))
    found = spark.createDataFrame([("p", "h/a.pdf", "a.pdf"), ("q", "h/b.pdf", "b.pdf")], "period STRING, url STRING, filename STRING")
    base = {"head_ok": True, "cond_status": 200, "get_status": 200, "bytes": 1}
    sightings = [{**base, "period": p, "url": u, "etag": e, "sha256": e} for p, u, e in (("p", "h/a.pdf", "1"), ("q", "h/b.pdf", "1"))]
    now = spark.createDataFrame([tuple(r.get(c) for c in OBSERVATION.names) for r in sightings], OBSERVATION)
    run_ledger(store, found, now, "/d", "s", 0)
    changed = now.withColumn("etag", F.lit("2")).withColumn("sha256", F.lit("2"))
    plans = []
    latest = LedgerStore.latest
    monkeypatch.setattr(LedgerStore, "latest", lambda *a, **k: plans.append(latest(*a, **k)) or plans[-1])
    monkeypatch.setattr(LedgerStore, "read", lambda *a, **k: pytest.fail("the history was read"))
    assert tuple(run_ledger(store, found, changed, "/d", "s", 1).summary.first()) == (0, 2, 0, 0, 0)
    plan = physical(plans[0])
    assert "/latest/" in plan and "/rows/" not in plan and "SortAggregate" not in plan
    monkeypatch.undo()
    same_index(store)
    assert store.read().count() == 4
