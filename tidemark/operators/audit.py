"""Audits of column names across releases, and the choice of a release's file.

Both read metadata tables, which still may be long: every step combines on the map
side before it shuffles.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import strip


def headers_of(releases: Mapping[int, DataFrame]) -> DataFrame:
    """Header table of the given releases: release, pos, column_name. Reads no rows."""
    rows = [(year, pos, name) for year, data in releases.items() for pos, name in enumerate(data.columns)]
    return SparkSession.active().createDataFrame(rows, "release INT, pos INT, column_name STRING")


def effective_mapping(mapping: DataFrame) -> DataFrame:
    """Mapping with both names stripped, each original once: the last line wins.

    Expects ``original``, ``final`` and the line number ``line_no``.
    """
    stripped = mapping.select(strip(F.col("original")).alias("original"), strip(F.col("final")).alias("final"), "line_no")
    return stripped.groupBy("original").agg(F.max_by("final", "line_no").alias("final"))


def mapping_for(columns, mapping: DataFrame) -> dict[str, str]:
    """The mapping of the given column names; never more entries than names."""
    names = list(dict.fromkeys(columns))
    wanted = mapping.sparkSession.createDataFrame([(n,) for n in names], "original STRING")
    return {r["original"]: r["final"] for r in effective_mapping(mapping).join(wanted, "original", "left_semi").collect()}


def on_target(mapping: DataFrame, targets: DataFrame) -> DataFrame:
    """Mapping rows whose final name is a column of the target."""
    return mapping.join(targets.select(F.col("column_name").alias("final")), "final", "left_semi").select(
        "original", "final"
    )


def audit_columns(headers: DataFrame, mapping: DataFrame, targets: DataFrame, ignored: DataFrame | None = None) -> DataFrame:
    """Columns that found no home: column_name, years (ascending).

    `headers` is (release, column_name), `mapping` (original, final, line_no),
    `targets` (column_name) and `ignored` (release, column_name). A column has no home
    if the mapping lacks it or maps it to a name the target lacks.
    """
    # One row per column and release before anything is joined or collected.
    seen = headers.groupBy("column_name", "release").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
    if ignored is not None:
        seen = seen.join(ignored, ["release", "column_name"], "left_anti")
    homes = on_target(effective_mapping(mapping), targets).select(F.col("original").alias("column_name"))
    return (
        seen.join(homes, "column_name", "left_anti")
        .groupBy("column_name")
        .agg(F.sort_array(F.collect_list("release")).alias("years"))
    )


def unmapped_report(audit: DataFrame) -> DataFrame:
    """The audit for reading: COLUMN_NAME, YEARS_APPEARED, sorted by name."""
    years = F.array_join(F.col("years").cast("array<string>"), ", ")
    return audit.select(F.col("column_name").alias("COLUMN_NAME"), years.alias("YEARS_APPEARED")).orderBy("COLUMN_NAME")


# How the main data file of a release is named.
FILE_ENDING = ".xlsx"
MAIN_TOKEN = "Disclosure_Data"
PREFERRED_TOKENS = ("new_form", "revised_form")


def pick_release_files(
    listing: DataFrame,
    ending: str = FILE_ENDING,
    token: str = MAIN_TOKEN,
    preferred=PREFERRED_TOKENS,
    releases=None,
) -> DataFrame:
    """Main file of every release in `listing` (release, file_name): release, file_name.

    A single file with the ending is taken whatever its name. Of several, those with
    the token count, a preferred one first; ties go to the lower name. A release
    without such a file keeps a row with a null name.
    """
    name, low = F.col("file_name"), F.lower("file_name")
    workbook = F.endswith(name, F.lit(ending))
    marked = workbook & F.contains(name, F.lit(token))
    favoured = F.lit(False)
    for word in preferred:
        favoured = favoured | F.contains(low, F.lit(word.lower()))
    if releases is not None:
        listing = listing.where(F.col("release").isin(list(releases)))
    return (
        listing.groupBy("release")
        .agg(
            F.count_if(workbook).alias("_files"),
            F.min(F.when(workbook, name)).alias("_any"),
            F.min(F.when(marked & favoured, name)).alias("_favoured"),
            F.min(F.when(marked, name)).alias("_marked"),
        )
        .select(
            "release",
            F.when(F.col("_files") == 1, F.col("_any")).otherwise(F.coalesce("_favoured", "_marked")).alias("file_name"),
        )
    )
