import pytest
from pyspark.sql import types as T

from tests.plans import physical
from tidemark import audit_columns, harmonise, pick_release_files
from tidemark.operators.audit import mapping_for
from tidemark.operators.harmonise import reject_counts, resolve_columns
from tidemark.plans.harmonise_run import audit_of, harmonise_files, release_files
from tidemark.sources.schemas import LONG, TEXT, table
from tidemark.sources.tables import read_mapping
from tidemark.sources.wage_columns import wage_columns
from workload.releases import drifted_cases

TARGET = table(ID=LONG, NAME=TEXT)
SF = "/root/testdata/sf0.001"


def test_identity_is_not_implied(spark):
    release = spark.createDataFrame([(1, "a")], "ID BIGINT, NAME STRING")
    kept = harmonise({2020: release}, {"ID": "ID"}, TARGET)
    assert [tuple(r) for r in kept.collect()] == [(1, None, 2020)]
    assert resolve_columns(2020, ["ID", "NAME"], {"ID": "ID"}, TARGET.names).unmapped == ["NAME"]
    own = harmonise({2020: release}, {}, TARGET, identity=True)
    assert [tuple(r) for r in own.collect()] == [(1, "a", 2020)]


def test_names_match_case_and_all(spark):
    release = spark.createDataFrame([(1, 2)], "a BIGINT, b BIGINT").toDF("id", "ID")
    kept = harmonise({1: release}, {"ID": "ID", "id": "NAME"}, TARGET)
    assert [tuple(r) for r in kept.collect()] == [(2, "1", 1)]


def test_odd_names(spark):
    release = spark.createDataFrame([(1, "x")], "a BIGINT, b STRING").toDF("a.b", "it's `q`")
    kept = harmonise({1: release}, {"a.b": "ID", "it's `q`": "NAME"}, TARGET)
    assert [tuple(r) for r in kept.collect()] == [(1, "x", 1)]


def test_ignored_columns_and_missing_targets():
    found = resolve_columns(2015, ["ID", "VOIDED_DATE", "OLD", "LOST"], {"ID": "ID", "OLD": "GONE"}, ["ID"], ["VOIDED_DATE"])
    assert (found.sources, found.unmapped, found.off_target) == ({"ID": [0]}, ["OLD", "LOST"], {"OLD": "GONE"})


def test_collisions_take_the_first_value(spark):
    release = spark.createDataFrame([(None, "2"), (1, "9"), (None, "x")], "a BIGINT, b STRING")
    table_ = harmonise({1: release}, {"a": "ID", "b": "ID"}, TARGET, audit=True)
    assert sorted((r.ID is None, r.ID) for r in table_.collect())[:2] == [(False, 1), (False, 2)]
    assert [tuple(r) for r in reject_counts(table_).collect()] == [(1, "ID", 1)]
    assert resolve_columns(1, ["a", "b"], {"a": "ID", "b": "ID"}, ["ID"]).collisions() == {"ID": [0, 1]}


def test_no_releases_give_an_empty_table(spark):
    empty = harmonise({}, {}, TARGET)
    assert empty.columns == ["ID", "NAME", "SOURCE_YEAR"] and empty.count() == 0


def test_harmonising_shuffles_nothing_and_prunes(spark):
    whole = drifted_cases(spark, SF)
    assert "Exchange" not in physical(whole)
    one = physical(whole.where("SOURCE_YEAR = 1999").select("CASE_ID"))
    assert one.count("FileScan") == 1 and "o_totalprice" not in one
    pushed = physical(whole.where("CASE_ID = 5"))
    assert pushed.count("EqualTo(o_orderkey,5)") == 7


def test_file_choice(spark):
    listing = [
        ("one", "Anything.xlsx"), ("none", "a.XLSX"), ("none", "b.csv"), ("two", "a.xlsx"), ("two", "b.xlsx"),
        ("token", "a.xlsx"), ("token", "PW_Disclosure_Data.xlsx"), ("lower", "disclosure_data.xlsx"), ("lower", "b.xlsx"),
        ("form", "A_Disclosure_Data.xlsx"), ("form", "Z_Disclosure_Data_Revised_Form.xlsx"),
        ("tie", "b_Disclosure_Data.xlsx"), ("tie", "a_Disclosure_Data.xlsx"),
    ]
    picked = pick_release_files(spark.createDataFrame(listing, "release STRING, file_name STRING"))
    assert {r[0]: r[1] for r in picked.collect()} == {
        "one": "Anything.xlsx", "none": None, "two": None, "token": "PW_Disclosure_Data.xlsx", "lower": None,
        "form": "Z_Disclosure_Data_Revised_Form.xlsx", "tie": "a_Disclosure_Data.xlsx",
    }


def test_audit(spark):
    headers = spark.createDataFrame(
        [(2020, "A"), (2021, "A"), (2020, "OK"), (2021, "OFF"), (2015, "IGN"), (2020, "A")], "release INT, column_name STRING"
    )
    mapping = spark.createDataFrame([(" OK ", "T", 1), ("OFF", "T", 1), ("OFF", "GONE", 2)], "original STRING, final STRING, line_no BIGINT")
    targets = spark.createDataFrame([("T",)], "column_name STRING")
    ignored = spark.createDataFrame([(2015, "IGN")], "release INT, column_name STRING")
    got = {r[0]: r[1] for r in audit_columns(headers, mapping, targets, ignored).collect()}
    assert got == {"A": [2020, 2021], "OFF": [2021]}


def test_mapping_file(spark, tmp_path):
    path = tmp_path / "mapping.csv"
    path.write_text("ORIGINAL,FINAL\n A , X \nB,Y\nA,Z\n", encoding="utf-8")
    assert mapping_for(["A", "B", "C"], read_mapping(spark, str(path))) == {"A": "Z", "B": "Y"}


def test_wage_mapping():
    mapping = wage_columns()
    assert (len(mapping), sum(a == b for a, b in mapping.items()), len(set(mapping.values()))) == (168, 124, 124)


def test_a_whole_run(spark, tmp_path):
    base = tmp_path / "releases"
    spark.createDataFrame([("1", "a", "v")], "NO STRING, LABEL STRING, OLD STRING").coalesce(1).write.option("header", True).csv(str(base / "2020.csv"))
    spark.createDataFrame([(2, "b"), (3, "c")], "ID BIGINT, NAME STRING").write.parquet(str(base / "2021"))
    mapping = tmp_path / "mapping.csv"
    mapping.write_text("ORIGINAL,FINAL\nNO,ID\nLABEL,NAME\nID,ID\nNAME,NAME\n", encoding="utf-8")
    mapping.write_text(mapping.read_text(encoding="utf-8") + "OLD,GONE\n", encoding="utf-8")
    files = {2020: str(base / "2020.csv"), 2021: str(base / "2021"), 2022: str(base / "missing")}
    report = harmonise_files(spark, files, str(mapping), 2021, str(tmp_path / "out"), str(tmp_path / "unmapped"))
    assert (report.rows, report.columns, report.rejected, report.unmapped) == (3, 3, 0, 1)
    assert report.rows_by_release == {2020: 1, 2021: 2} and list(report.skipped) == [2022]
    assert (report.collisions, report.off_target) == ({}, {2020: {"OLD": "GONE"}})
    stored = spark.read.parquet(str(tmp_path / "out")).select("ID", "NAME", "SOURCE_YEAR").orderBy("ID")
    assert [tuple(r) for r in stored.collect()] == [(1, "a", 2020), (2, "b", 2021), (3, "c", 2021)]
    lines = spark.read.option("header", True).csv(str(tmp_path / "unmapped")).collect()
    assert [tuple(r) for r in lines] == [("OLD", "2020")]


def test_release_folders(spark, tmp_path):
    for name in ("2020/a_Disclosure_Data.xlsx", "2020/b.xlsx", "2021/only.xlsx", "2022/no.csv"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"")
    got = release_files(spark, str(tmp_path), [2020, 2021, 2022])
    assert got == {2020: f"{tmp_path}/2020/a_Disclosure_Data.xlsx", 2021: f"{tmp_path}/2021/only.xlsx"}


@pytest.mark.parametrize("identity, expected", [(False, {"NAME": [1]}), (True, {})])
def test_audit_of_releases(spark, identity, expected):
    release = spark.createDataFrame([], "ID BIGINT, NAME STRING")
    mapping = spark.createDataFrame([("ID", "ID", 0)], "original STRING, final STRING, line_no BIGINT")
    audit = audit_of(spark, {1: release}, mapping, TARGET, identity=identity)
    assert {r[0]: r[1] for r in audit.collect()} == expected


def test_types_of_the_anchor(spark):
    release = spark.createDataFrame([("7", "n"), ("x", None)], "ID STRING, NAME STRING")
    kept = harmonise({1: release}, {"ID": "ID", "NAME": "NAME"}, T.StructType(TARGET.fields))
    assert sorted((r.ID or 0) for r in kept.collect()) == [0, 7]


def test_release_folders_are_direct_children(spark, tmp_path):
    from tidemark.plans.harmonise_run import release_files

    for place in ("2020", "old/2020", "2021/more", "2021"):
        (tmp_path / place).mkdir(parents=True, exist_ok=True)
        (tmp_path / place / f"{place.replace('/', '_')}.xlsx").write_bytes(b"")
    assert release_files(spark, f"file:{tmp_path}/") == {2020: f"file:{tmp_path}/2020/2020.xlsx", 2021: f"file:{tmp_path}/2021/2021.xlsx"}


def test_a_text_anchor_needs_declared_types(spark, tmp_path):
    import pytest

    from tidemark.plans.harmonise_run import harmonise_files

    (tmp_path / "2020.csv").write_text("ID\n1\n")
    with pytest.raises(ValueError, match="declare the types"):
        harmonise_files(spark, {2020: str(tmp_path / "2020.csv")}, str(tmp_path / "m.csv"), 2020, str(tmp_path / "out"))
