"""Workbooks (.xlsx) as rows of bytes, read to one row per sheet row.

The unit of work is a workbook, whose size its format bounds (1,048,576 rows). Cells
arrive as text; dates as ISO text. The first sheet is read, its first row is the header.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.binary import normal_folder, normal_path, open_file, read_binary

# Built-in number formats that show a date or time.
_DATE_FORMATS = frozenset([*range(14, 23), *range(45, 48)])
# Cell texts that stand for a missing value.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Bytes of a workbook that travel to Python as one row.
PIECE = 1024
_EPOCHS = {False: dt.datetime(1899, 12, 30), True: dt.datetime(1904, 1, 1)}


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _column_index(reference: str) -> int:
    """0 for ``A7``, 27 for ``AB7``."""
    index = 0
    for letter in re.match(r"[A-Z]+", reference).group():
        index = index * 26 + ord(letter) - 64
    return index - 1


def _all_text(element) -> str:
    """Text of a string item without phonetic hints."""
    if _local(element.tag) == "rPh":
        return ""
    own = element.text or "" if _local(element.tag) == "t" else ""
    return own + "".join(_all_text(child) for child in element)


def _children(archive: zipfile.ZipFile, member: str, tag: str):
    """Elements `tag` of an XML member, each forgotten after use."""
    if member not in archive.namelist():
        return
    with archive.open(member) as stream:
        for _, element in ElementTree.iterparse(stream):
            if _local(element.tag) == tag:
                yield element
                element.clear()


def _date_styles(archive: zipfile.ZipFile) -> set[int]:
    """Indexes of the cell styles that show dates."""
    custom = {
        int(f.get("numFmtId")): re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", f.get("formatCode", ""))
        for f in _children(archive, "xl/styles.xml", "numFmt")
    }
    dates = _DATE_FORMATS | {i for i, code in custom.items() if re.search(r"[ymdhs]", code, re.I)}
    styles = [
        int(x.get("numFmtId", 0)) for cells in _children(archive, "xl/styles.xml", "cellXfs") for x in cells
    ]
    return {i for i, number_format in enumerate(styles) if number_format in dates}


def _first_sheet(archive: zipfile.ZipFile) -> tuple[str, bool]:
    """Member of the first sheet, and whether dates count from 1904."""
    sheet = next(_children(archive, "xl/workbook.xml", "sheet"))
    relation = next(v for k, v in sheet.attrib.items() if _local(k) == "id")
    target = next(
        r.get("Target") for r in _children(archive, "xl/_rels/workbook.xml.rels", "Relationship") if r.get("Id") == relation
    )
    properties = next(_children(archive, "xl/workbook.xml", "workbookPr"), None)
    from_1904 = properties is not None and properties.get("date1904") in ("1", "true")
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}", from_1904


def _date_text(serial: float, from_1904: bool) -> str:
    moment = _EPOCHS[from_1904] + dt.timedelta(milliseconds=round(serial * 86_400_000))
    return moment.isoformat(sep=" ")


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet, as lists of cell texts."""
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        shared = [_all_text(item) for item in _children(archive, "xl/sharedStrings.xml", "si")]
        dates = _date_styles(archive)
        member, from_1904 = _first_sheet(archive)
        for row in _children(archive, member, "row"):
            cells: list[str | None] = []
            for place, cell in enumerate(c for c in row if _local(c.tag) == "c"):
                index = _column_index(cell.get("r")) if cell.get("r") else place
                cells.extend([None] * (index + 1 - len(cells)))
                cells[index] = _cell_text(cell, shared, dates, from_1904)
            yield cells


def _cell_text(cell, shared: list[str], dates: set[int], from_1904: bool) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(_all_text(child) for child in cell)
    value = next((child.text for child in cell if _local(child.tag) == "v"), None)
    if value is None:
        return None
    if kind == "s":
        return shared[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    if kind == "n" and int(cell.get("s", 0)) in dates:
        return _date_text(float(value), from_1904)
    return None if kind == "e" else value


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Path and bytes of each workbook, opened here unless the batches hold their pieces."""
    held = []
    for batch in batches:
        for i, path in enumerate(batch.column(0).to_pylist()):
            if batch.num_columns > 1:
                held.append(batch.column(1)[i].as_py() or b"")
                if batch.column(2)[i].as_py():
                    content, held = b"".join(held), []
                    yield path, content
            else:
                with open_file(path) as stream:
                    yield path, stream.read()


def _files(files: DataFrame) -> DataFrame:
    """`path` of each workbook; contents in pieces, the `last` marked, since a batch for Python is
    bounded by its rows: however many or large the workbooks are, it holds 10 MB."""
    path = normal_path(F.col("path")).alias("path")
    if "content" not in files.columns:
        return files.select(path)
    size = F.coalesce(F.octet_length("content"), F.lit(0))
    last = F.greatest(F.ceil(size / PIECE).cast("int") - 1, F.lit(0))
    pieces = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(F.substring(F.col("content"), i * PIECE + 1, F.lit(PIECE)).alias("content"), (i == last).alias("last")))
    return files.select(path, F.explode(pieces).alias("piece")).select("path", "piece.content", "piece.last")


def workbook_headers(files: DataFrame) -> DataFrame:
    """Header of every workbook in `files` (path, maybe content): path, pos, column_name, error.

    A workbook that cannot be read gives one row with `error`.
    """
    layout = pa.schema([("path", pa.string()), ("pos", pa.int32()), ("column_name", pa.string()), ("error", pa.string())])

    def first_rows(batches):
        for path, content in _contents(batches):
            try:
                header = next(sheet_rows(content), [])
                rows = [{"path": path, "pos": i, "column_name": n} for i, n in enumerate(header) if n is not None]
            except Exception as failure:  # a broken workbook must not end the job
                rows = [{"path": path, "error": type(failure).__name__}]
            yield pa.RecordBatch.from_pylist(rows, schema=layout)

    return _files(files).mapInArrow(first_rows, "path STRING, pos INT, column_name STRING, error STRING")


def workbook_columns(spark: SparkSession, path: str) -> list[str]:
    """Column names of the workbooks at or below `path`, each once, in order of place."""
    headers = workbook_headers(read_workbook_files(spark, path)).where("error IS NULL")
    first = headers.groupBy("column_name").agg(F.min("pos").alias("pos"))
    return [r["column_name"] for r in first.orderBy("pos", "column_name").collect()]


def read_workbook_files(spark: SparkSession, path: str) -> DataFrame:
    """One workbook, or all at or below a folder: path."""
    if path.lower().endswith(".xlsx"):
        return spark.createDataFrame([(normal_folder(spark, path),)], "path STRING")
    return read_binary(spark, path, ".xlsx")


def workbook_errors(spark: SparkSession, path: str) -> list[str]:
    """What is wrong with the workbooks at or below `path`, one line for each that cannot be read."""
    broken = decode_workbooks(read_workbook_files(spark, path), []).where("error IS NOT NULL")
    return [f"{r['error']} in {r['path']}" for r in broken.select("path", "error").collect()]


def decode_workbooks(files: DataFrame, columns, missing=MISSING, rows_per_batch: int = 4096) -> DataFrame:
    """Rows of every workbook in `files` (path, maybe content) as text columns.

    Result: path, row_no (from 1), `columns` in the given order, error. A column a
    workbook lacks is null. A file that cannot be read to its end gives one row with
    `error` and no other: it is read through before its first row is handed on.
    """
    columns, missing = list(columns), frozenset(missing)
    schema = T.StructType(
        [T.StructField("path", T.StringType()), T.StructField("row_no", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in columns]
        + [T.StructField("error", T.StringType())]
    )
    arrow = pa.schema(
        [("path", pa.string()), ("row_no", pa.int64()), *[(c, pa.string()) for c in columns], ("error", pa.string())]
    )

    def batch_of(path, first, rows, places):
        picked = [
            [None if p is None or p >= len(r) or r[p] in missing else r[p] for r in rows] for p in places
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([path] * len(rows), pa.string()),
                pa.array(range(first, first + len(rows)), pa.int64()),
                *[pa.array(p, pa.string()) for p in picked],
                pa.nulls(len(rows), pa.string()),
            ],
            schema=arrow,
        )

    def decode_one(path, content):
        rows = sheet_rows(content)
        header = next(rows, [])
        places = [header.index(c) if c in header else None for c in columns]
        number, held = 1, []
        for row in rows:
            held.append(row)
            if len(held) == rows_per_batch:
                yield batch_of(path, number, held, places)
                number, held = number + len(held), []
        yield batch_of(path, number, held, places)

    def decode(batches):
        for path, content in _contents(batches):
            try:
                for _ in sheet_rows(content):
                    pass
            except Exception as failure:  # a broken workbook must not end the job
                yield pa.RecordBatch.from_pylist([{"path": path, "error": type(failure).__name__}], schema=arrow)
                continue
            yield from decode_one(path, content)

    return _files(files).mapInArrow(decode, schema)


def read_workbooks(spark: SparkSession, path: str, columns, missing=MISSING) -> DataFrame:
    """Rows of the workbooks at or below `path`, see `decode_workbooks`."""
    return decode_workbooks(read_workbook_files(spark, path), columns, missing)
