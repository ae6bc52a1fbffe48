"""Reading releases and mappings, writing harmonised tables and reports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.harmonise import YEAR
from tidemark.sources.schemas import KEY, MANIFEST_TEXT, MAPPING, text_manifest
from tidemark.sources.workbooks import read_workbooks, workbook_columns, workbook_errors


def read_release(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """One release by the ending of its path: a workbook, CSV with header, or Parquet.

    A workbook arrives as text columns; types are given by the target schema later. One
    that cannot be read to its end is an error, so that none of its rows is taken.
    Without `schema` a CSV's columns are text too, named by its header line.
    """
    if path.lower().endswith(".xlsx"):
        if errors := workbook_errors(spark, path):
            raise ValueError(errors[0])
        names = schema.names if schema else workbook_columns(spark, path)
        return read_workbooks(spark, path, names).select(*[f"`{n}`" for n in names])
    if path.lower().endswith((".csv", ".csv.gz")):
        reader = spark.read.option("header", True).option("enforceSchema", False)
        return (reader.schema(schema) if schema else reader).csv(path)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def release_schema(spark: SparkSession, path: str) -> T.StructType:
    """Names and types of a release; its rows are not read."""
    if path.lower().endswith(".xlsx"):
        return T.StructType([T.StructField(n, T.StringType()) for n in workbook_columns(spark, path)])
    return read_release(spark, path).schema


# Quotes inside a quoted cell are doubled, and a cell may hold line breaks.
_QUOTED = {"quote": '"', "escape": '"', "multiLine": True}


def _by_header(spark: SparkSession, path: str, wanted: dict[str, str], required: list[str], number: str) -> DataFrame:
    """Lines of CSV files as text columns, each read from the place that its file's header gives it.

    `wanted` is column name to a pattern of the header's name; of several that match the last
    counts. Headers may differ between files, have further names, and lack all but the `required`
    ones, whose absence is an error. A header is one line. `number` becomes the lines' order: by
    file name, then by their place in the file.
    """
    # No record has more cells than its line has commas, and one.
    commas = spark.read.text(path).agg(F.max(F.regexp_count("value", F.lit(",")))).first()[0]
    cells = [f"c{i}" for i in range((commas or 0) + 1)]
    layout = T.StructType([T.StructField(c, T.StringType()) for c in cells])
    rows = spark.read.options(**_QUOTED, header=False, enforceSchema=True).schema(layout).csv(path)
    rows = rows.select(F.array(*cells).alias("_cells"), F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_at"))
    # One header per file; a file with line breaks in cells is read by one task.
    headers = rows.groupBy("_file").agg(F.min("_at").alias("first"), F.min_by("_cells", "_at").alias("names")).orderBy("_file").collect()
    places = []
    for rank, header in enumerate(headers):
        names = [(n or "").removeprefix("\ufeff").strip() for n in header["names"]]
        found = [max((i for i, n in enumerate(names) if re.fullmatch(pattern, n)), default=None) for pattern in wanted.values()]
        if missing := [c for c, place in zip(wanted, found) if place is None and c in required]:
            raise ValueError(f"{header['_file']} has no column for {', '.join(missing)}: {', '.join(n for n in names if n)}")
        places.append((header["_file"], rank, header["first"], found))
    if not places:
        return spark.createDataFrame([], T.StructType([*[T.StructField(c, T.StringType()) for c in wanted], T.StructField(number, T.LongType())]))
    known = spark.createDataFrame(places, "_file STRING, _rank BIGINT, _first BIGINT, _places ARRAY<INT>")
    lines = rows.join(F.broadcast(known), "_file").where("_at > _first")
    place = F.shiftleft("_rank", 33) + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return lines.select(*[F.get("_cells", F.col("_places")[i]).alias(c) for i, c in enumerate(wanted)], place.alias(number))


def read_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Mapping file with the columns ``ORIGINAL`` and ``FINAL`` or ``FINAL_<year>``, in any order
    and beside others: original, final, line_no.

    Lines are numbered in file order, so that a later line can win.
    """
    return _by_header(spark, path, {"original": "ORIGINAL", "final": r"FINAL(_\d{4})?"}, MAPPING.names, "line_no")


def read_text_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest as text columns, with its line order as `seq`; one file, or several in order of name.

    Columns go by the names in each file's header. Those of the key must be there; others that a
    file lacks are null, and what it has besides is left out.
    """
    return _by_header(spark, path, {name: name for name in MANIFEST_TEXT.names}, KEY, "seq")


def write_text_manifest(rows: DataFrame, path: str) -> None:
    """Ledger rows as CSV text in order of `seq`, cells quoted as `read_text_manifest` reads them.

    Written by many tasks; the files' names give the order.
    """
    ordered = rows.repartitionByRange(F.col("seq")).sortWithinPartitions("seq")
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "emptyValue": ""}
    text_manifest(ordered).write.mode("overwrite").options(header=True, quote='"', escape='"', **kept).csv(path)


def write_harmonised(table: DataFrame, path: str) -> None:
    """Harmonised table, one folder per release.

    A task of the union reads one release only, so it writes to one folder and no
    shuffle is needed to keep the number of files down.
    """
    table.write.mode("overwrite").partitionBy(YEAR).parquet(path)


def write_unmapped_report(report: DataFrame, path: str) -> bool:
    """Report as CSV in name order; nothing is written when there is nothing to say."""
    if report.isEmpty():
        return False
    report.write.mode("overwrite").option("header", True).csv(path)
    return True


def stored_megabytes(files: DataFrame) -> DataFrame:
    """Size of listed files (path, length) in MB."""
    return files.agg(F.round(F.coalesce(F.sum("length"), F.lit(0)) / 1048576, 2).alias("size_mb"))
