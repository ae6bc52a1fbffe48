"""Releases whose columns drift, stacked under one target schema.

Column resolution works on names alone and happens on the driver; the result is one
lazy plan, a projection per release under a union, without any shuffle. A filter on
the release or on a target column reaches each release's scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

YEAR = "SOURCE_YEAR"
REJECTED = "_rejected"

# Columns of the 2015 release that are dropped without a report.
IGNORED_COLUMNS = {
    2015: (
        "CASE_ASSIGNED_TO_ANALYST",
        "CASE_SENT_TO_CO_FOR_APPROVAL",
        "DATE_REDETERMINATION_RECEIVED",
        "VOIDED_DATE",
        "PW_TRACKING_NUMBER",
        "TYPE_DBA_SCA",
    )
}


@dataclass
class Resolution:
    """Where the columns of one release go."""

    year: int
    sources: dict[str, list[int]] = field(default_factory=dict)
    unmapped: list[str] = field(default_factory=list)
    off_target: dict[str, str] = field(default_factory=dict)

    def collisions(self) -> dict[str, list[int]]:
        return {t: s for t, s in self.sources.items() if len(s) > 1}


def resolve_columns(
    year: int,
    columns: Iterable[str],
    mapping: Mapping[str, str],
    targets: Iterable[str],
    ignored: Iterable[str] = (),
    identity: bool = False,
) -> Resolution:
    """Match column names, case and all, with the mapping and the target schema.

    A name the mapping lacks is unmapped even if the target has it, unless `identity`
    is set; so is a name mapped to something the target lacks. Ignored names are
    neither kept nor reported.
    """
    result, targets, ignored = Resolution(year), set(targets), set(ignored)
    for place, name in enumerate(columns):
        if name in ignored:
            continue
        final = mapping.get(name, name if identity else None)
        if final in targets:
            result.sources.setdefault(final, []).append(place)
            continue
        result.unmapped.append(name)
        if final is not None:
            result.off_target[name] = final
    return result


def _cell(places: list[int], types: list[T.DataType], target: T.DataType) -> str:
    """SQL of one target column from its source columns, the first non-null wins."""
    ddl = target.simpleString()
    if not places:
        return f"CAST(NULL AS {ddl})"
    parts = [f"c{p}" if types[p] == target else f"TRY_CAST(c{p} AS {ddl})" for p in places]
    return parts[0] if len(parts) == 1 else f"COALESCE({', '.join(parts)})"


def _rejects(resolution: Resolution, types: list[T.DataType], target: T.StructType) -> str:
    """SQL of the list of target columns that lost a value of this row to its type."""
    checks = [
        f"CASE WHEN c{p} IS NOT NULL AND TRY_CAST(c{p} AS {f.dataType.simpleString()}) IS NULL THEN '{_quoted(f.name)}' END"
        for f in target
        for p in resolution.sources.get(f.name, [])
        if types[p] != f.dataType
    ]
    if not checks:
        return "CAST(ARRAY() AS ARRAY<STRING>)"
    return f"ARRAY_COMPACT(ARRAY({', '.join(checks)}))"


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def align(data: DataFrame, resolution: Resolution, target: T.StructType, audit: bool = False) -> DataFrame:
    """One release under the target schema, tagged with its year."""
    types = [f.dataType for f in data.schema]
    # By place, so that names differing in case only, or holding dots, do no harm.
    placed = data.toDF(*[f"c{i}" for i in range(len(types))])
    cells = [f"{_cell(resolution.sources.get(f.name, []), types, f.dataType)} AS `{f.name.replace('`', '``')}`" for f in target]
    cells.append(f"{resolution.year} AS {YEAR}")
    if audit:
        cells.append(f"{_rejects(resolution, types, target)} AS {REJECTED}")
    return placed.selectExpr(*cells)


def harmonise(
    releases: Mapping[int, DataFrame],
    mapping: Mapping[str, str],
    target: T.StructType,
    ignored: Mapping[int, Iterable[str]] = IGNORED_COLUMNS,
    identity: bool = False,
    audit: bool = False,
) -> DataFrame:
    """All releases as one table: the target columns in order, then ``SOURCE_YEAR``.

    A target column a release lacks is null. Two columns of a release with one target
    are coalesced in file order. A value that does not fit the target type becomes
    null; with `audit`, ``_rejected`` lists the columns where that happened.
    """
    parts = [
        align(
            data,
            resolve_columns(year, data.columns, mapping, target.names, ignored.get(year, ()), identity),
            target,
            audit,
        )
        for year, data in releases.items()
    ]
    if not parts:
        return SparkSession.active().createDataFrame([], harmonised_schema(target, audit))
    return reduce(DataFrame.unionByName, parts)


def harmonised_schema(target: T.StructType, audit: bool = False) -> T.StructType:
    schema = T.StructType([*target.fields, T.StructField(YEAR, T.IntegerType(), False)])
    return schema.add(REJECTED, T.ArrayType(T.StringType())) if audit else schema


def reject_counts(audited: DataFrame) -> DataFrame:
    """Values lost to type reconciliation: SOURCE_YEAR, column_name, rejected."""
    return (
        audited.select(YEAR, F.explode(REJECTED).alias("column_name"))
        .groupBy(YEAR, "column_name")
        .agg(F.count(F.lit(1)).alias("rejected"))
    )


def release_volumes(harmonised: DataFrame) -> DataFrame:
    """Rows per release and the number of columns of the table."""
    return harmonised.groupBy(YEAR).agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(len(harmonised.columns)).alias("column_count")
    )
