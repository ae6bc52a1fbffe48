import csv
import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.plans import physical
from tidemark import expand_archives, harmonise, read_workbooks
from tidemark.operators.ledger import repoint
from tidemark.operators.types import infer_types
from tidemark.sources.archives import moves_of_archives, read_archives
from tidemark.operators.inventory import list_paths
from tidemark.plans.harmonise_run import harmonise_files
from tidemark.plans.ledger_run import run_ledger, unpack_archives
from tidemark.sources.binary import normal_path
from tidemark.sources.ledger_store import LedgerStore
from tidemark.sources.schemas import LONG, MANIFEST, MANIFEST_TEXT, OBSERVATION, TEXT, table
from tidemark.sources.tables import (
    read_mapping,
    read_release,
    read_text_manifest,
    release_schema,
    stored_megabytes,
    write_harmonised,
    write_text_manifest,
    write_unmapped_report,
)
from tidemark.sources.workbooks import PIECE, _files, decode_workbooks, workbook_headers
from workload.containers import ROWS_PER_WORKBOOK, harmonise_workbooks, workbook_bytes, workbook_parts, workbooks

ROWS = (
    '<row r="1"><c r="A1" t="inlineStr"><is><t>ID</t></is></c><c r="C1" t="s"><v>0</v></c><c r="AB1" t="inlineStr"><is><r><t>WI</t></r><r><t>DE</t></r></is></c></row>'
    '<row r="2"><c r="A2"><v>7</v></c><c r="C2" s="1"><v>43831.5</v></c><c r="AB2" t="b"><v>1</v></c></row>'
    '<row r="4"><c r="A4" t="str"><v>N/A</v></c><c r="C4" t="s"><v>1</v></c><c r="AB4" t="e"><v>#DIV/0!</v></c></row>'
)


def zipped(*members):
    stream = io.BytesIO()
    with zipfile.ZipFile(stream, "w") as archive:
        for name in members:
            archive.writestr(name, b"x")
    return stream.getvalue()


def book(tmp_path, name="b.xlsx"):
    path = tmp_path / name
    path.write_bytes(workbook_bytes(ROWS))
    return str(path)


def test_workbook(spark, tmp_path):
    path = book(tmp_path)
    assert release_schema(spark, path).names == ["ID", "open", "WIDE"]
    rows = read_workbooks(spark, path, ["WIDE", "ID", "open", "ABSENT"]).orderBy("row_no").collect()
    assert [(r["row_no"], r["ID"], r["open"], r["WIDE"], r["ABSENT"], r["error"]) for r in rows] == [
        (1, "7", "2020-01-01 12:00:00", "true", None, None), (2, None, "closed", None, None, None),
    ]
    kept = harmonise({2020: read_release(spark, path)}, {"ID": "ID", "WIDE": "NAME"}, table(ID=LONG, NAME=TEXT))
    assert sorted(map(str, kept.collect())) == ["Row(ID=7, NAME='true', SOURCE_YEAR=2020)", "Row(ID=None, NAME=None, SOURCE_YEAR=2020)"]


def test_broken_workbook_is_a_row(spark):
    files = spark.createDataFrame([("/b.xlsx", b"no workbook"), ("/g.xlsx", workbook_bytes(ROWS))], "path STRING, content BINARY")
    rows = decode_workbooks(files, ["ID"]).collect()
    assert sorted((r["path"], r["error"]) for r in rows) == [("/b.xlsx", "BadZipFile"), ("/g.xlsx", None), ("/g.xlsx", None)]
    assert workbook_headers(files.where("path = '/g.xlsx'")).count() == 3


def test_archives(spark, tmp_path):
    stream = io.BytesIO()
    with zipfile.ZipFile(stream, "w") as archive:
        archive.writestr("../../up/./a.txt", b"abc")
        archive.writestr("dir/", b"")
    (tmp_path / "x.tables.zip").write_bytes(stream.getvalue())
    (tmp_path / "bad.ZIP").write_bytes(b"nothing")
    members = expand_archives(read_archives(spark, str(tmp_path)), keep_content=True)
    good = members.where("error is null").first()
    assert (good["member"], good["size"], bytes(good["content"])) == ("../../up/./a.txt", 3, b"abc")
    assert good["sha256"] == hashlib.sha256(b"abc").hexdigest()
    assert good["path"].endswith("/x.tables/up/a.txt") and good["folder"].endswith("/x.tables")
    bad = members.where("error is not null").first()
    assert bad["archive"].endswith("/bad.ZIP") and bad["error"] == "not a valid archive" and bad["path"] is None

    archive = good["archive"]
    ledger = spark.createDataFrame(
        [("p", "u", archive, "x.tables.zip", 1, 0), ("p", "v", bad["archive"], "bad.ZIP", 1, 0)],
        "period STRING, url STRING, saved_path STRING, filename STRING, version INT, seq BIGINT",
    )
    followed = repoint(ledger, moves_of_archives(ledger, members))
    assert {r["url"]: r["filename"] for r in followed.collect()} == {"u": "x.tables", "v": "bad.ZIP"}


def test_stored_files_are_hashed_by_path(spark, tmp_path):
    (tmp_path / "2020").mkdir()
    (tmp_path / "2020" / "a.pdf").write_bytes(b"abc")
    (tmp_path / "2020" / "empty.pdf").write_bytes(b"")
    (tmp_path / "2020" / "z.zip").write_bytes(zipped("m.txt"))
    (tmp_path / "2020" / "other.zip").write_bytes(b"never opened")
    files = list_paths(spark, f"file://{tmp_path}/").where("NOT is_dir").select("path", "length")
    links = spark.createDataFrame(
        [("2020", f"https://h/{n}", n) for n in ("a.pdf", "empty.pdf", "z.zip", "absent.pdf")], "period STRING, url STRING, filename STRING"
    )
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    seen = spark.createDataFrame([], OBSERVATION)
    run = run_ledger(store, links, seen, f"file:{tmp_path}", "s", 3, files=files)
    assert {r["filename"]: r["outcome"] for r in run.applied.collect()} == {
        "a.pdf": "registered", "empty.pdf": "registered", "z.zip": "registered", "absent.pdf": "errors",
    }
    rows = {r["filename"]: r for r in store.read().collect()}
    assert (rows["a.pdf"]["sha256"], rows["a.pdf"]["bytes"]) == (hashlib.sha256(b"abc").hexdigest(), 3)
    assert rows["empty.pdf"]["bytes"] == 0 and rows["a.pdf"]["saved_path"] == f"{tmp_path}/2020/a.pdf"
    members = unpack_archives(store, read_archives(spark, str(tmp_path)), batch=3)
    assert [r["path"] for r in members.collect()] == [f"{tmp_path}/2020/z/m.txt"]
    assert {r["saved_path"] for r in store.read().where("filename = 'z'").collect()} == {f"{tmp_path}/2020/z"}
    assert unpack_archives(store, read_archives(spark, str(tmp_path)), batch=4).count() == 0


def test_a_large_member_does_not_stop_the_ledger(spark, tmp_path):
    """Following an archive needs no content, so no length of a member is too much for it."""
    stored = spark.createDataFrame([("/d/2020/z.zip", zipped("m.txt"))], "path STRING, content BINARY")
    assert [r["error"] for r in expand_archives(stored, keep_content=True, longest=0).collect()] == ["member too large for a row"]
    store = LedgerStore(spark, str(tmp_path / "ledger"))
    values = {"period": "2020", "url": "https://h/z.zip", "saved_path": "/d/2020/z.zip"}
    store.append(spark.createDataFrame([tuple(values.get(n) for n in MANIFEST.names)], MANIFEST), 0)
    assert [(r["path"], r["error"], r["content"]) for r in unpack_archives(store, stored).collect()] == [("/d/2020/z/m.txt", None, None)]
    assert [r["saved_path"] for r in store.read().collect()] == ["/d/2020/z"]


def test_columns_go_by_header(spark, tmp_path):
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "1.csv").write_text('\ufeffFINAL_2025,NOTE,ORIGINAL\n"X, y",n,A\nZ,,B\n', encoding="utf-8")
    (tmp_path / "m" / "2.csv").write_text("ORIGINAL,FINAL\nB,W,extra\nC\n", encoding="utf-8")
    (tmp_path / "m" / "3.csv").write_text("ORIGINAL,FINAL\n", encoding="utf-8")
    rows = read_mapping(spark, str(tmp_path / "m")).orderBy("line_no").collect()
    assert [(r["original"], r["final"]) for r in rows] == [("A", "X, y"), ("B", "Z"), ("B", "W"), ("C", None)]
    (tmp_path / "bad.csv").write_text("ORIGINAL,OTHER\nA,B\n", encoding="utf-8")
    with pytest.raises(ValueError, match="no column for final: ORIGINAL, OTHER"):
        read_mapping(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "ledger.csv").write_text("version,url,NEW,period\n3,h/a,x,2020\n", encoding="utf-8")
    row = read_text_manifest(spark, str(tmp_path / "ledger.csv")).first()
    assert (row["period"], row["url"], row["version"], row["sha256"]) == ("2020", "h/a", "3", None)
    (tmp_path / "nokey.csv").write_text("version,url\n3,h/a\n", encoding="utf-8")
    with pytest.raises(ValueError, match="period"):
        read_text_manifest(spark, str(tmp_path / "nokey.csv"))
    (tmp_path / "empty.csv").write_text("", encoding="utf-8")
    assert read_text_manifest(spark, str(tmp_path / "empty.csv")).count() == 0


@pytest.mark.parametrize(
    ("cells", "kind"),
    [
        (["1", " -22 ", "", None], "bigint"), (["1", "2.5", "1e3"], "double"), (["007", "8"], "string"), (["1", "x"], "string"), (["true", "FALSE"], "boolean"),
        (["true", "1"], "string"), (["2020-02-29"], "date"), (["2020-02-30"], "string"), (["2020-01-01", "2020-01-01 10:00:00"], "timestamp"),
        (["2020-01-01T10:00:00Z"], "timestamp"), (["2020-01-01", "3"], "string"), ([None, " "], "string"), (["9223372036854775807"], "bigint"),
        (["9223372036854775808"], "string"), (["123456789012345678", "0.5"], "string"), ([".5", "5."], "double"), (["+3"], "bigint"), (["NaN"], "string"),
    ],
)
def test_the_narrowest_type_that_holds_all_cells(spark, cells, kind):
    parts = spark.createDataFrame([(c, "k") for c in cells], "v STRING, `V.x` STRING").repartition(3)
    assert [f.dataType.simpleString() for f in infer_types(parts)] == [kind, "string"]


def test_paths_have_one_form(spark):
    forms = ["file:/a//b/", "file:///a/b", "file://localhost/a/b", "/a/b//", "/a/b", "s3://k//x/", "hdfs://h:1/a//b", "/", "a/b/"]
    got = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "i INT, p STRING").select("i", normal_path(F.col("p"))).orderBy("i").collect()
    assert [r[1] for r in got] == ["/a/b"] * 5 + ["s3://k/x", "hdfs://h:1/a/b", "/", "a/b"]


def test_damaged_workbook_is_left_out_whole(spark, tmp_path):
    lines = ROWS + "".join(f'<row><c r="A{i}"><v>{i}</v></c></row>' for i in range(5, 6005)) + '<row><c r="A1" t="s"><v>99</v></c></row>'
    (tmp_path / "2020.xlsx").write_bytes(workbook_bytes(lines))
    (tmp_path / "2021.xlsx").write_bytes(workbook_bytes(ROWS))
    (tmp_path / "map.csv").write_text("ORIGINAL,FINAL\nID,ID\n")
    files = {y: str(tmp_path / f"{y}.xlsx") for y in (2020, 2021)}
    report = harmonise_files(spark, files, str(tmp_path / "map.csv"), 2021, str(tmp_path / "out"), target=table(ID=LONG))
    assert list(report.skipped) == [2020] and "IndexError" in report.skipped[2020]
    assert report.rows_by_release == {2021: 2}
    headers = workbook_headers(spark.createDataFrame([("/b.xlsx", b"no"), ("/g.xlsx", workbook_bytes(ROWS))], "path STRING, content BINARY"))
    assert headers.where("error is null").count() == 3 and headers.where("error is not null").count() == 1


def test_manifest_text_survives_a_round_trip(spark, tmp_path):
    values = ['"abc"', 'W/"a,b"', "line\nbreak", "back\\slash", "", 'tail"', " spaced "]
    rows = spark.createDataFrame([(f"u{i}", v, i) for i, v in enumerate(values)], "url STRING, etag STRING, seq BIGINT")
    rows = rows.select(*[F.col(n).cast(f.dataType).alias(n) if n in rows.columns else F.lit(None).cast(f.dataType).alias(n) for n, f in ((f.name, f) for f in MANIFEST)])
    write_text_manifest(rows, str(tmp_path / "m"))
    back = read_text_manifest(spark, str(tmp_path / "m")).orderBy("seq").collect()
    assert [(r["url"], r["etag"] or "") for r in back] == [(f"u{i}", v) for i, v in enumerate(values)]
    with open(tmp_path / "one.csv", "w", newline="") as out:
        writer = csv.writer(out)
        writer.writerow(MANIFEST_TEXT.names)
        for i, v in enumerate(values):
            writer.writerow([f"u{i}" if n == "url" else v if n == "etag" else "" for n in MANIFEST_TEXT.names])
    back = read_text_manifest(spark, str(tmp_path / "one.csv")).orderBy("seq").collect()
    assert [(r["url"], r["etag"] or "") for r in back] == [(f"u{i}", v) for i, v in enumerate(values)]


def test_replay_after_a_rewrite(spark, tmp_path):
    store = LedgerStore(spark, str(tmp_path / "l"))
    rows = spark.range(3).select(*[F.concat(F.lit("u"), "id").alias(f.name) if f.name == "url" else F.lit("p" if f.name == "period" else None).cast(f.dataType).alias(f.name) for f in MANIFEST])
    for batch in (0, 1):
        store.append(rows.withColumn("url", F.concat("url", F.lit(f"-{batch}"))), batch)
    store.replace(store.read())
    before = sorted(map(str, store.read().collect()))
    store.append(rows.withColumn("url", F.concat("url", F.lit("-0"))), 0)
    assert sorted(map(str, store.read().collect())) == before
    store.append(rows.limit(0), 1)
    assert {r["url"] for r in store.read().collect()} == {"u0-0", "u1-0", "u2-0"}


def test_sinks(spark, tmp_path):
    rows = harmonise(
        {y: spark.createDataFrame([(y, "n")], "ID BIGINT, NAME STRING") for y in (2020, 2021)},
        {"ID": "ID", "NAME": "NAME"}, table(ID=LONG, NAME=TEXT),
    )
    write_harmonised(rows, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("SOURCE_YEAR=*")) == ["SOURCE_YEAR=2020", "SOURCE_YEAR=2021"]
    plan = physical(spark.read.parquet(str(tmp_path / "out")).where("SOURCE_YEAR = 2021"))
    assert "PartitionFilters: [isnotnull(SOURCE_YEAR" in plan
    empty = spark.createDataFrame([], "COLUMN_NAME STRING, YEARS_APPEARED STRING")
    assert not write_unmapped_report(empty, str(tmp_path / "none")) and not (tmp_path / "none").exists()
    sizes = spark.createDataFrame([("a", 1048576), ("b", 524288)], "path STRING, length BIGINT")
    assert stored_megabytes(sizes).first()[0] == 1.5


def test_workbooks_travel_in_pieces(spark):
    """No row that goes to Python is larger than a piece, however large a workbook; each comes out whole."""
    lines = ROWS + "".join(f"<row><c><v>{hashlib.sha256(b'%d' % i).hexdigest()}</v></c></row>" for i in range(400))
    large = workbook_bytes(lines)
    some = [("/l.xlsx", large), ("/l.xlsx", large), ("/e.xlsx", b""), ("/n.xlsx", None), ("/p.xlsx", large[: 3 * PIECE]), (None, workbook_bytes(ROWS))]
    files = spark.createDataFrame(some, "path STRING, content BINARY")
    assert len(large) > 5 * PIECE
    assert _files(files.coalesce(1)).agg(F.max(F.octet_length("content"))).first()[0] == PIECE
    for spread in (files.coalesce(1), files.repartition(3)):
        rows = [(r["path"], r["row_no"], r["error"]) for r in decode_workbooks(spread, ["ID"]).collect()]
        assert sorted(r for r in rows if r[0] == "/l.xlsx") == sorted(2 * [("/l.xlsx", i, None) for i in range(1, 403)])
        assert sorted(map(str, (r for r in rows if r[0] != "/l.xlsx"))) == [
            "('/e.xlsx', None, 'BadZipFile')", "('/n.xlsx', None, 'BadZipFile')", "('/p.xlsx', None, 'BadZipFile')", "(None, 1, None)", "(None, 2, None)",
        ]


def test_workbooks_are_made_few_at_a_time(spark):
    """Arrow functions would get as many as 10,000 workbooks of XML at once."""
    plan = physical(workbooks(spark, "/root/testdata/sf0.001"))
    assert "MapInPandas" not in plan and "BatchEvalPython" in plan


def test_harmonised_workbooks_travel_in_pieces(spark):
    plan = physical(harmonise_workbooks(spark, "/root/testdata/sf0.001"))
    assert "MapInPandas" not in plan and plan.index("MapInArrow") < plan.index("Generate explode") < plan.index("BatchEvalPython")


def test_long_workbooks_are_made_in_parts(spark, tmp_path):
    """Keys that come often make a workbook long; what goes to Python is a part of it, and its rows stay in order."""
    orders = spark.range(3 * ROWS_PER_WORKBOOK + 1).selectExpr(
        "CASE WHEN id % 5 = 0 THEN NULL WHEN id = 1 THEN 999 ELSE id % 7 END AS o_orderkey", "if(id % 2 = 0, 'O', 'F') AS o_orderstatus",
        "CASE WHEN id % 11 <> 0 THEN timestamp_ntz'2024-01-01 00:00:00' END AS o_orderdate", "concat('p', id % 3) AS o_orderpriority",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    parts = workbook_parts(spark, str(tmp_path)).where("path = '/data/b0.xlsx'")
    assert parts.count() > 2 and parts.agg(F.max(F.size(F.split("rows", "</row>")))).first()[0] <= ROWS_PER_WORKBOOK + 2
    books = workbooks(spark, str(tmp_path))
    assert "BatchEvalPythonUDTF" in physical(books)
    found = [(r["path"], r["row_no"], r["CASE_ID"] or r["CASE_NO"]) for r in decode_workbooks(books, ["CASE_ID", "CASE_NO"]).where("row_no IS NOT NULL").collect()]
    kept = orders.where("o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL AND o_orderkey < 999").orderBy("o_orderkey").collect()
    assert len(kept) > 2 * ROWS_PER_WORKBOOK - 250
    assert [(n, key) for path, n, key in sorted(found, key=lambda r: r[1]) if path == "/data/b0.xlsx"] == [(i, str(r[0])) for i, r in enumerate(kept, 1)]
    assert [(path, key) for path, _, key in found if path != "/data/b0.xlsx"] == [("/data/b3.xlsx", "999")]
    assert {r["path"] for r in books.collect()} == {None, "/data/b0.xlsx", "/data/b3.xlsx"}
