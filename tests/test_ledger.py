import hashlib
import io
import re
import zipfile

from pyspark.sql import functions as F

from tests.plans import physical
from tidemark import apply_changes, latest_manifest, plan_changes, register_existing, repoint, run_summary
from tidemark.operators import ledger
from tidemark.operators.ledger import fingerprint_wanted, new_rows, to_fetch
from tidemark.plans.ledger_run import clean_ledger, refile_combined, run_ledger, unpack_archives
from tidemark.sources.ledger_store import LedgerStore
from tidemark.sources.schemas import MANIFEST, MANIFEST_TEXT, OBSERVATION, text_manifest, typed_manifest
from tidemark.sources.tables import read_text_manifest

TEXT_ROW = {name: "" for name in MANIFEST_TEXT.names}


def text_rows(spark, *rows):
    cells = [tuple({**TEXT_ROW, "period": "p", **r}[c] for c in MANIFEST_TEXT.names) + (i,) for i, r in enumerate(rows)]
    return spark.createDataFrame(cells, ", ".join(f"{c} STRING" for c in MANIFEST_TEXT.names) + ", seq BIGINT")


def seen(spark, *rows):
    base = {"period": "p", "head_ok": True, "cond_status": 200, "get_status": 200}
    return spark.createDataFrame([tuple({**base, **r}.get(c) for c in OBSERVATION.names) for r in rows], OBSERVATION)


def links(spark, *urls):
    return spark.createDataFrame([("p", u, u.rsplit("/", 1)[-1].lower()) for u in urls], "period STRING, url STRING, filename STRING")


def reasons(planned):
    return {r["url"]: (r["decision"], r["reason"]) for r in planned.collect()}


def test_every_reason(spark):
    known = text_rows(
        spark,
        {"url": "etag", "etag": "e", "version": "1"},
        {"url": "time", "etag": "other", "last_modified": "t", "bytes": "5"},
        {"url": "time-size", "last_modified": "t", "bytes": "5"},
        {"url": "time-unknown", "last_modified": "t", "bytes": "5"},
        {"url": "time-zero", "last_modified": "t", "bytes": "0"},
        {"url": "time-blank", "last_modified": "t"},
        {"url": "304"}, {"url": "head"}, {"url": "cond"}, {"url": "gone"}, {"url": "changed", "etag": "e"},
        {"url": "broken", "bytes": "many", "etag": "e"},
        {"url": "blank-etag", "etag": ""},
    )
    now = seen(
        spark,
        {"url": "etag", "etag": "e"},
        {"url": "time", "etag": "new", "last_modified": "t", "content_length": 5},
        {"url": "time-size", "last_modified": "t", "content_length": 6},
        {"url": "time-unknown", "last_modified": "t"},
        {"url": "time-zero", "last_modified": "t", "content_length": 0},
        {"url": "time-blank", "last_modified": "t"},
        {"url": "304", "cond_status": 304},
        {"url": "head", "head_ok": False, "cond_status": 304},
        {"url": "cond", "cond_status": None},
        {"url": "changed", "etag": "f"},
        {"url": "broken", "etag": "e"},
        {"url": "blank-etag", "etag": ""},
        {"url": "new"},
    )
    wanted = links(spark, *[r["url"] for r in known.collect()], "new")
    skip, version = (lambda r: ("skip", r)), (lambda r: ("version", r))
    assert reasons(plan_changes(wanted, known, now)) == {
        "etag": skip("etag-match"), "time": skip("last-modified-match"), "time-size": version("content-may-differ"),
        "time-unknown": skip("last-modified-match"), "time-zero": version("content-may-differ"),
        "time-blank": skip("last-modified-match"), "304": skip("not-modified"), "head": version("head-failed"),
        "cond": version("head-failed"), "gone": version("head-failed"), "changed": version("content-may-differ"),
        "broken": ("error", "bad-size"), "blank-etag": version("content-may-differ"), "new": ("download", "unseen"),
    }
    fast = reasons(plan_changes(wanted, known, now, " FAST "))
    assert fast["new"] == ("download", "unseen") and fast["broken"] == skip("seen-fast")
    assert plan_changes(wanted, known, now, links_stored=True).count() == wanted.count()


def test_latest_takes_the_later_of_equal_versions(spark):
    rows = text_rows(
        spark,
        {"url": "a", "version": "2", "etag": "x"}, {"url": "a", "version": "2", "etag": "y"}, {"url": "a", "version": "1"},
        {"url": "b", "version": "", "etag": "blank"}, {"url": "b", "version": "1", "etag": "later"},
        {"url": "c", "version": "v9", "etag": "broken"}, {"url": "c", "version": "1", "etag": "fine"},
    )
    assert {r["url"]: r["etag"] for r in latest_manifest(rows).collect()} == {"a": "y", "b": "later", "c": "fine"}


def test_outcomes_and_new_rows(spark):
    known = text_rows(
        spark,
        {"url": "h/same.pdf", "sha256": "s", "version": "1"}, {"url": "h/new.b.pdf", "sha256": "s", "version": "4"},
        {"url": "h/blank", "sha256": "s", "version": ""}, {"url": "h/odd.x", "sha256": "s", "version": "v"},
        {"url": "h/304.x", "sha256": "s", "version": "1"}, {"url": "h/skip.x", "etag": "e", "version": "1"},
        {"url": "h/broken.x", "bytes": "?", "version": "1"},
    )
    changed = [{"url": u, "sha256": "t", "bytes": 9, "etag": "e2"} for u in ("h/new.b.pdf", "h/blank", "h/odd.x")]
    now = seen(
        spark, *changed, {"url": "h/same.pdf", "sha256": "s", "etag": "e2"}, {"url": "h/304.x", "get_status": 304},
        {"url": "h/skip.x", "etag": "e"}, {"url": "h/first.PDF?x=1", "sha256": "u", "bytes": 1, "etag": ""},
        {"url": "h/lost.pdf"}, {"url": "h/disk.pdf", "sha256": "u"}, {"url": "h/broken.x", "sha256": "u"},
    )
    urls = [r["url"] for r in now.select("url").collect()]
    files = spark.createDataFrame([("/d/p/disk.pdf", b"abc")], "path STRING, content BINARY")
    planned = plan_changes(links(spark, *urls), known, now)
    assert "h/skip.x" not in {r["url"] for r in to_fetch(planned).collect()}
    applied = apply_changes(planned, "/d", files)
    assert {r["url"]: r["outcome"] for r in applied.collect()} == {
        "h/same.pdf": "unchanged", "h/new.b.pdf": "versioned", "h/blank": "versioned", "h/odd.x": "versioned",
        "h/304.x": "unchanged", "h/skip.x": "skipped", "h/first.PDF?x=1": "downloaded", "h/lost.pdf": "errors",
        "h/disk.pdf": "registered", "h/broken.x": "errors",
    }
    assert tuple(run_summary(applied).first()) == (2, 3, 1, 2, 2)
    rows = {r["url"]: r for r in new_rows(applied, "/d", "s", 7).collect()}
    assert {u: (r["version"], r["saved_path"]) for u, r in rows.items()} == {
        "h/new.b.pdf": (5, "/d/p/new.v5.b.pdf"), "h/blank": (2, "/d/p/blank.v2"), "h/odd.x": (2, "/d/p/odd.v2.x"),
        "h/first.PDF?x=1": (1, "/d/p/first.PDF"), "h/disk.pdf": (1, "/d/p/disk.pdf"),
    }
    disk = rows["h/disk.pdf"]
    assert (disk["sha256"], disk["bytes"], disk["etag"]) == (hashlib.sha256(b"abc").hexdigest(), 3, None)
    assert rows["h/first.PDF?x=1"]["etag"] is None and set(r["seq"] for r in rows.values()) == {7}


def test_registering_leaves_known_keys_alone(spark):
    files = spark.createDataFrame([("/d/p/a.pdf", b"1"), ("/d/p/b.pdf", b"2"), ("/d/p/x.pdf", b"3")], "path STRING, content BINARY")
    known = text_rows(spark, {"url": "h/b.pdf"})
    got = register_existing(links(spark, "h/A.pdf", "h/b.pdf", "h/c.pdf"), known, files, "/d", "s")
    assert [(r["url"], r["saved_path"], r["version"], r["bytes"]) for r in got.collect()] == [("h/A.pdf", "/d/p/a.pdf", 1, 1)]


def test_content_is_hashed_for_wanted_files_only(spark, tmp_path):
    for name in "abc":
        (tmp_path / f"{name}.bin").write_bytes(name.encode())
    files = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "content")
    wanted = files.where(F.col("path").contains("b.bin")).select("path")
    got = fingerprint_wanted(files, wanted, ["path"])
    assert [r["sha256"] for r in got.collect()] == [hashlib.sha256(b"b").hexdigest()]
    plan = physical(got)
    assert plan.index("sha2") < plan.index("BroadcastHashJoin")  # a plan reads bottom up


def test_repointing(spark):
    rows = text_rows(spark, {"url": "a", "version": "1", "saved_path": "/o/1"}, {"url": "a", "version": "2", "saved_path": "/o/2"}, {"url": "b", "saved_path": "/o/b"})
    ledger = typed_manifest(rows).drop("problem")
    moves = spark.createDataFrame([("p", "a", "/n/a"), ("p", "zz", "/n/z")], "period STRING, url STRING, new_path STRING")
    both = {(r["url"], r["version"]): (r["saved_path"], r["filename"]) for r in repoint(ledger, moves).collect()}
    assert both == {("a", 1): ("/n/a", "a"), ("a", 2): ("/n/a", "a"), ("b", 1): ("/o/b", None)}
    last = {(r["url"], r["version"]): r["saved_path"] for r in repoint(ledger, moves, latest_only=True).collect()}
    assert last == {("a", 1): "/o/1", ("a", 2): "/n/a", ("b", 1): "/o/b"}


def test_text_manifest_file(spark, tmp_path):
    path = tmp_path / "manifest.csv"
    path.write_text(
        ",".join(MANIFEST_TEXT.names) + "\n"
        's,2020,"https://h/a,b.pdf",a.pdf,/d/a.pdf,12,aa,,,,2024-01-02T03:04:05Z\n'
        "s,2021,https://h/c.pdf,c.pdf,,x,,,,two,\n",
        encoding="utf-8",
    )
    typed = typed_manifest(read_text_manifest(spark, str(path))).orderBy("seq")
    first, second = typed.collect()
    assert (first["url"], first["bytes"], first["version"], first["etag"], first["problem"]) == ("https://h/a,b.pdf", 12, 1, None, None)
    assert (second["version"], second["problem"], second["saved_path"]) == (None, "version", None)
    assert text_manifest(typed).orderBy("period").first()["downloaded_at"] == "2024-01-02T03:04:05Z"
    elsewhere = spark.newSession()
    elsewhere.conf.set("spark.sql.session.timeZone", "America/New_York")
    typed = typed_manifest(read_text_manifest(elsewhere, str(path)))
    assert typed.select(F.unix_timestamp("downloaded_at")).collect()[0][0] == 1704164645
    assert text_manifest(typed).orderBy("period").first()["downloaded_at"] == "2024-01-02T03:04:05Z"


def test_store_replays_and_rewrites(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    assert store.read().count() == 0 and store.read().schema == MANIFEST
    rows = typed_manifest(text_rows(spark, {"url": "a"}, {"url": "b", "period": "01"})).drop("problem")
    for _ in range(2):
        store.append(rows, 3)
    assert sorted((r["url"], r["period"], r["seq"]) for r in store.read().collect()) == [("a", "p", 3), ("b", "01", 3)]
    assert store.read(before=3).count() == 0
    store.replace(store.read().where("url = 'a'"))
    store.append(rows.where("url = 'b'"), 4)
    assert sorted((r["url"], r["seq"]) for r in store.read().collect()) == [("a", 3), ("b", 4)]
    assert "isnotnull(period" in physical(store.read().where("period = '01'"))


def test_a_run_twice_leaves_the_same_ledger(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    found = links(spark, "h/a.pdf", "h/b.pdf")
    now = seen(spark, *[{"url": u, "sha256": u, "bytes": 1, "etag": "e"} for u in ("h/a.pdf", "h/b.pdf")])
    for batch in (0, 0, 1):
        run = run_ledger(store, found, now, "/d", "s", batch)
        assert store.read().count() == 2
    assert tuple(run.summary.first()) == (0, 0, 2, 0, 0)


def test_cleaning_and_refiling_keep_the_ledger_in_step(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    rows = text_rows(
        spark,
        {"period": "1996", "url": "a", "saved_path": "/d/1996/yb97.pdf", "filename": "yb97.pdf"},
        {"period": "1996", "url": "b", "saved_path": "/d/1996/t98/deep/x.pdf"},
        {"period": "1996", "url": "c", "saved_path": "/d/1996/z.zip"},
        {"period": "1996", "url": "d", "saved_path": "/d/1996/gone.pdf"},
    )
    store.append(typed_manifest(rows).drop("problem"), 0)
    paths = [
        ("/d/1996/yb97.pdf", False), ("/d/1996/t98", True), ("/d/1996/t98/deep", True), ("/d/1996/t98/deep/x.pdf", False),
        ("/d/1996/z", True), ("/d/1997", True), ("/d/1997/yb97.pdf", False),
    ]
    inventory = spark.createDataFrame(paths, "path STRING, is_dir BOOLEAN")
    assert {r[0]: r[1] for r in clean_ledger(store, inventory).collect()} == {"kept": 2, "repaired": 1, "removed": 1}
    refile_combined(store, inventory, "/d")
    assert {r["url"]: (r["saved_path"], r["filename"]) for r in store.read().collect()} == {
        "a": ("/d/1997/yb97_1.pdf", "yb97_1.pdf"), "b": ("/d/1998/t98/deep/x.pdf", "x.pdf"), "c": ("/d/1996/z", "z"),
    }


def test_unpacking_points_the_ledger_to_the_folder(spark, tmp_path):
    stream = io.BytesIO()
    with zipfile.ZipFile(stream, "w") as archive:
        archive.writestr("a.txt", "abc")
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    rows = text_rows(spark, {"url": "a", "saved_path": "/d/p/a.ZIP"}, {"url": "b", "saved_path": "/d/p/b.zip"})
    store.append(typed_manifest(rows).drop("problem"), 0)
    archives = spark.createDataFrame([("/d/p/a.ZIP", stream.getvalue()), ("/d/p/b.zip", b"?")], "path STRING, content BINARY")
    members = unpack_archives(store, archives)
    assert sorted((r["path"], r["error"]) for r in members.collect() if r["path"]) == [("/d/p/a/a.txt", None)]
    assert {r["url"]: r["saved_path"] for r in store.read().collect()} == {"a": "/d/p/a", "b": "/d/p/b.zip"}


def test_many_links_still_prune_the_ledger(spark, tmp_path, monkeypatch):
    """With more links than are broadcast, the periods prune folders and the keys filter before the aggregate."""
    monkeypatch.setattr(ledger, "fits", lambda *_: False)
    store = LedgerStore(spark, str(tmp_path / "l"))
    empty = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in MANIFEST}
    rows = spark.range(40).select(*[{"period": F.concat(F.lit("p"), F.col("id") % 4), "url": F.concat(F.lit("u"), "id")}.get(n, c).alias(n) for n, c in empty.items()])
    store.append(rows, 0)
    keys = rows.where("period = 'p1'").select("period", "url")
    latest = ledger.latest_manifest(store.read(), keys)
    plan = physical(latest)
    assert re.search(r"PartitionFilters: \[[^\]]*period#\d+ = p1", plan) and "LeftSemi" in plan
    assert latest.count() == 10
