"""Archives and workbooks, rendered from the tables in pieces of fixed size."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators.harmonise import harmonise
from tidemark.sources.archives import expand_archives, moves_of_archives
from tidemark.sources.schemas import LONG, TEXT, table as layout
from tidemark.sources.workbooks import decode_workbooks, workbook_headers
from workload.data import table

DOCUMENTS_PER_ARCHIVE = 20
ROWS_PER_WORKBOOK = 250


def archives(spark, sf):
    """An archive per `DOCUMENTS_PER_ARCHIVE` documents, every seventh cut short."""

    def pack(documents: pd.DataFrame) -> pd.DataFrame:
        number = int(documents["number"].iloc[0])
        stream = io.BytesIO()
        with zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("texts/", "")
            for doc_id, text in zip(documents["doc_id"], documents["text"]):
                archive.writestr(f"../texts/{doc_id}.txt", text)
        content = stream.getvalue()
        if number % 7 == 3:
            content = content[: len(content) // 2]
        return pd.DataFrame({"path": [f"/data/a{number}.zip"], "content": [content]})

    documents = table(spark, sf, "documents").select(
        F.floor(F.col("doc_id") / DOCUMENTS_PER_ARCHIVE).alias("number"), "doc_id", "text"
    )
    return documents.groupBy("number").applyInPandas(pack, "path STRING, content BINARY")


def archive_members(spark, sf):
    return expand_archives(archives(spark, sf)).drop("content")


def archive_moves(spark, sf):
    manifest = table(spark, sf, "documents").selectExpr(
        "lang AS period",
        "concat('https://files.example.org/', doc_id) AS url",
        f"concat('/data/a', floor(doc_id / {DOCUMENTS_PER_ARCHIVE}), '.zip') AS saved_path",
    )
    return moves_of_archives(manifest, expand_archives(archives(spark, sf)))


_CONTENT_TYPES = '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"/>'
_SHEET = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATION = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


class Workbook:
    """A minimal workbook, written in parts; of its XML no more is held than the part at hand."""

    def __init__(self):
        self._stream = io.BytesIO()
        self._book = zipfile.ZipFile(self._stream, "w", zipfile.ZIP_DEFLATED)
        members = {
            "[Content_Types].xml": _CONTENT_TYPES,
            "xl/workbook.xml": f'<workbook xmlns="{_SHEET}" xmlns:r="{_RELATION}"><sheets><sheet name="a" sheetId="1" r:id="rId1"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>',
            "xl/styles.xml": f'<styleSheet xmlns="{_SHEET}"><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>',
            "xl/sharedStrings.xml": f'<sst xmlns="{_SHEET}"><si><t>open</t></si><si><r><t>clo</t></r><r><t>sed</t></r></si></sst>',
        }
        for name, text in members.items():
            self._book.writestr(name, text)
        self._sheet = self._book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self.write(f'<worksheet xmlns="{_SHEET}"><sheetData>')

    def write(self, rows: str) -> None:
        self._sheet.write(rows.encode())

    def close(self) -> bytes:
        """The bytes of the whole workbook."""
        self.write("</sheetData></worksheet>")
        self._sheet.close()
        self._book.close()
        return self._stream.getvalue()


def workbook_bytes(rows: str) -> bytes:
    """A minimal workbook around the XML of its rows."""
    book = Workbook()
    book.write(rows)
    return book.close()


class WorkbookOfParts:
    """Table function: the parts of one workbook in, its path and bytes out."""

    def __init__(self):
        self._path = self._book = None

    def eval(self, part):
        if self._book is None:
            self._path, self._book = part["path"], Workbook()
        self._book.write(part["rows"])

    def terminate(self):
        if self._book is not None:
            yield self._path, self._book.close()


def workbook_parts(spark, sf):
    """XML of at most `ROWS_PER_WORKBOOK` rows of a workbook: number, part, path, rows. Keys that come often make many parts."""

    last = "if(number % 3 = 0, '', {})"
    row = (
        "concat('<row><c><v>', o_orderkey, '</v></c><c t=\"s\"><v>', if(o_orderstatus = 'O', 0, 1), '</v></c><c s=\"1\"><v>', "
        "datediff(o_orderdate, date'1899-12-30'), '</v></c>', "
        + last.format("concat('<c t=\"str\"><v>', if(o_orderkey % 11 = 0, 'N/A', o_orderpriority), '</v></c>')")
        + ", '</row>')"
    )
    name = "concat('<c t=\"inlineStr\"><is><t>', n, '</t></is></c>')"
    names = "array(if(number % 2 = 1, 'CASE_NO', 'CASE_ID'), 'STATUS', 'RECEIVED', 'PRIORITY')"
    header = f"array_join(transform(slice({names}, 1, if(number % 3 = 0, 3, 4)), n -> {name}), '')"
    place = "row_number() OVER (PARTITION BY number ORDER BY line)"
    parts = (
        table(spark, sf, "orders")
        .withColumn("number", F.expr(f"floor(o_orderkey / {ROWS_PER_WORKBOOK})"))
        .selectExpr("number", f"struct(o_orderkey, {row} AS xml) AS line")
        .selectExpr("number", f"floor(({place} - 1) / {ROWS_PER_WORKBOOK}) AS part", "line")
        .groupBy("number", "part")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"))
    )
    return parts.selectExpr(
        "number",
        "part",
        "concat('/data/b', number, '.xlsx') AS path",
        f"concat(if(part = 0, concat('<row>', {header}, '</row>'), ''), array_join(transform(lines, l -> l.xml), '')) AS rows",
    )


def workbooks(spark, sf):
    """A workbook per `ROWS_PER_WORKBOOK` orders; names drift from book to book."""
    # Parts go to Python 100 at a time; batches of the Arrow functions would hold 10,000.
    zipped = F.udtf(WorkbookOfParts, returnType="path STRING, content BINARY", useArrow=False)
    return zipped(workbook_parts(spark, sf).asTable().partitionBy("number").orderBy("part"))


def workbook_ingest(spark, sf):
    return decode_workbooks(workbooks(spark, sf), ["CASE_ID", "CASE_NO", "STATUS", "RECEIVED", "PRIORITY"])


def workbook_header_names(spark, sf):
    return workbook_headers(workbooks(spark, sf)).where("error IS NULL").select("path", F.col("pos").cast("long").alias("pos"), "column_name")


def harmonise_workbooks(spark, sf):
    text = decode_workbooks(workbooks(spark, sf), ["CASE_ID", "CASE_NO", "STATUS", "PRIORITY"])
    mapping = {"CASE_ID": "CASE_ID", "CASE_NO": "CASE_ID", "STATUS": "CASE_STATUS", "PRIORITY": "PRIORITY"}
    return harmonise({2025: text}, mapping, layout(CASE_ID=LONG, CASE_STATUS=TEXT, PRIORITY=TEXT))


QUERIES = {
    "archive_members": archive_members,
    "archive_moves": archive_moves,
    "workbook_ingest": workbook_ingest,
    "workbook_headers": workbook_header_names,
    "harmonise_workbooks": harmonise_workbooks,
}

_STATUS = "CASE WHEN o_orderstatus = 'O' THEN 'open' ELSE 'closed' END"
_PRIORITY = "CASE WHEN (o_orderkey // 250) % 3 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE o_orderpriority END"

ORACLE = {
    "archive_members": """
        WITH d AS (SELECT *, doc_id // 20 AS number, '/data/a' || number AS folder FROM documents)
        SELECT folder || '.zip' AS archive, folder, '../texts/' || doc_id || '.txt' AS member,
               folder || '/texts/' || doc_id || '.txt' AS path, octet_length(encode(text)) AS size, sha256(text) AS sha256,
               CAST(NULL AS VARCHAR) AS error
        FROM d WHERE number % 7 <> 3
        UNION ALL
        SELECT DISTINCT folder || '.zip', folder, NULL, NULL, NULL, NULL, 'not a valid archive' FROM d WHERE number % 7 = 3""",
    "archive_moves": """
        SELECT lang AS period, 'https://files.example.org/' || doc_id AS url, '/data/a' || (doc_id // 20) AS new_path
        FROM documents WHERE (doc_id // 20) % 7 <> 3""",
    "workbook_ingest": f"""
        SELECT '/data/b' || (o_orderkey // 250) || '.xlsx' AS path,
               row_number() OVER (PARTITION BY o_orderkey // 250 ORDER BY o_orderkey) AS row_no,
               CASE WHEN (o_orderkey // 250) % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS "CASE_ID",
               CASE WHEN (o_orderkey // 250) % 2 = 1 THEN CAST(o_orderkey AS VARCHAR) END AS "CASE_NO",
               {_STATUS} AS "STATUS", strftime(o_orderdate, '%Y-%m-%d 00:00:00') AS "RECEIVED", {_PRIORITY} AS "PRIORITY",
               CAST(NULL AS VARCHAR) AS error
        FROM orders""",
    "workbook_headers": """
        WITH b AS (SELECT DISTINCT o_orderkey // 250 AS number FROM orders),
        h AS (SELECT number, unnest([CASE WHEN number % 2 = 1 THEN 'CASE_NO' ELSE 'CASE_ID' END, 'STATUS', 'RECEIVED', 'PRIORITY']) AS column_name,
                     unnest([0, 1, 2, 3]) AS pos FROM b)
        SELECT '/data/b' || number || '.xlsx' AS path, CAST(pos AS BIGINT) AS pos, column_name FROM h WHERE number % 3 <> 0 OR pos < 3""",
    "harmonise_workbooks": f"""
        SELECT o_orderkey AS "CASE_ID", {_STATUS} AS "CASE_STATUS", {_PRIORITY} AS "PRIORITY", 2025 AS "SOURCE_YEAR" FROM orders""",
}
