"""Harmonising a set of release files in one job."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.audit import audit_columns, headers_of, mapping_for, pick_release_files, unmapped_report
from tidemark.operators.harmonise import IGNORED_COLUMNS, REJECTED, YEAR, harmonise, resolve_columns
from tidemark.operators.inventory import list_paths
from tidemark.operators.types import infer_types
from tidemark.sources.binary import normal_folder
from tidemark.sources.tables import read_mapping, read_release, release_schema, write_harmonised, write_unmapped_report


@dataclass
class HarmoniseReport:
    rows: int = 0
    columns: int = 0
    rejected: int = 0
    rows_by_release: dict[int, int] = field(default_factory=dict)
    skipped: dict[int, str] = field(default_factory=dict)
    unmapped: int = 0
    # Per release: target columns with several sources, and sources mapped to no target.
    collisions: dict[int, dict[str, list[str]]] = field(default_factory=dict)
    off_target: dict[int, dict[str, str]] = field(default_factory=dict)


def release_files(spark: SparkSession, folder: str, releases=None) -> dict[int, str]:
    """Main file of each release folder ``<folder>/<year>``; the list is one entry per year.

    Only files directly in such a folder count, and only folders directly in `folder`.
    """
    given, folder = folder.rstrip("/"), normal_folder(spark, folder)
    files = list_paths(spark, folder).where("NOT is_dir")
    year = F.regexp_extract("path", rf"\A{re.escape(folder.rstrip('/'))}/(\d{{4}})/[^/]*\z", 1).try_cast("int")
    listing = files.select(
        year.alias("release"), F.regexp_extract("path", r"[^/]*\z", 0).alias("file_name")
    ).where("release is not null")
    picked = pick_release_files(listing, releases=releases).where("file_name is not null")
    return {r["release"]: f"{given}/{r['release']}/{r['file_name']}" for r in picked.collect()}


def harmonise_files(
    spark: SparkSession,
    files: Mapping[int, str],
    mapping_path: str,
    anchor: int,
    output: str,
    report: str | None = None,
    target: T.StructType | None = None,
    ignored: Mapping[int, tuple] = IGNORED_COLUMNS,
    identity: bool = False,
    infer: bool = False,
) -> HarmoniseReport:
    """Stack `files` (year to path) under the schema of the `anchor` release.

    A release that cannot be opened is left out and named in the report; a value that
    does not fit its column is counted. Counts are observed while the table is
    written, so the releases are read once. Without `target` the anchor's own types
    count; an anchor that arrives as text has none, so that a target must be declared, or
    with `infer` types are found in the cells of all releases, which are read once more for that.
    """
    result = HarmoniseReport()
    untyped = target is None and files[anchor].lower().endswith((".xlsx", ".csv", ".csv.gz"))
    if untyped and not infer:
        raise ValueError(f"{files[anchor]} holds text only: declare the types of the target")
    target = target or release_schema(spark, files[anchor])
    mapping_table = read_mapping(spark, mapping_path)
    releases: dict[int, DataFrame] = {}
    for year, path in files.items():
        try:
            releases[year] = read_release(spark, path)
        except Exception as failure:
            result.skipped[year] = f"{type(failure).__name__}: {failure}".splitlines()[0]
    if not releases:
        return result

    names = [c for data in releases.values() for c in data.columns]
    mapping = mapping_for(names, mapping_table)
    if untyped:
        target = inferred_target(releases, mapping, target.names, ignored, identity)
    for year, data in releases.items():
        found = resolve_columns(year, data.columns, mapping, target.names, ignored.get(year, ()), identity)
        if found.collisions():
            result.collisions[year] = {t: [data.columns[i] for i in s] for t, s in found.collisions().items()}
        if found.off_target:
            result.off_target[year] = found.off_target
    table = harmonise(releases, mapping, target, ignored, identity, audit=True)
    seen = Observation("harmonise")
    per_release = [F.count_if(F.col(YEAR) == y).alias(f"rows_{y}") for y in releases]
    observed = table.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.sum(F.size(REJECTED)).alias("rejected"), *per_release
    )
    write_harmonised(observed.drop(REJECTED), output)
    counts = seen.get
    result.rows, result.rejected = counts["rows"], counts["rejected"] or 0
    result.rows_by_release = {y: counts[f"rows_{y}"] for y in releases}
    result.columns = len(target.names) + 1

    audit = audit_of(spark, releases, mapping_table, target, ignored, identity)
    result.unmapped = audit.count()
    if report:
        write_unmapped_report(unmapped_report(audit), report)
    return result


def inferred_target(
    releases: Mapping[int, DataFrame],
    mapping: Mapping[str, str],
    names: list[str],
    ignored: Mapping[int, tuple] = IGNORED_COLUMNS,
    identity: bool = False,
) -> T.StructType:
    """The columns `names` with the narrowest types that hold their cells in all releases."""
    text = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return infer_types(harmonise(releases, mapping, text, ignored, identity).drop(YEAR))


def audit_of(
    spark: SparkSession,
    releases: Mapping[int, DataFrame],
    mapping: DataFrame,
    target: T.StructType,
    ignored: Mapping[int, tuple] = IGNORED_COLUMNS,
    identity: bool = False,
) -> DataFrame:
    """Unmapped columns of the given releases, from their headers alone."""
    targets = spark.createDataFrame([(n,) for n in target.names], "column_name STRING")
    dropped = spark.createDataFrame(
        [(year, name) for year, names in ignored.items() for name in names], "release INT, column_name STRING"
    )
    if identity:
        own = targets.select(
            F.col("column_name").alias("original"), F.col("column_name").alias("final"), F.lit(-1).cast("long").alias("line_no")
        )
        mapping = mapping.unionByName(own)
    return audit_columns(headers_of(releases), mapping, targets, dropped)
