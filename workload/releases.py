"""Harmonisation queries: yearly slices of `orders` play the releases."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.audit import audit_columns, effective_mapping, on_target, pick_release_files, unmapped_report
from tidemark.operators.harmonise import harmonise, reject_counts, release_volumes
from tidemark.session import shared_dir
from tidemark.sources.schemas import INT, LONG, TEXT, table as layout
from tidemark.sources.tables import write_harmonised
from workload.data import table

CASES = layout(CASE_ID=LONG, CASE_STATUS=TEXT, PRIORITY=TEXT, CUSTOMER=LONG, TOTAL=T.DoubleType())
CASE_MAPPING = {
    "CASE_NO": "CASE_ID",
    "CASE_NUMBER": "CASE_ID",
    "CASE_ID": "CASE_ID",
    "STATUS": "CASE_STATUS",
    "CASE_STATUS": "CASE_STATUS",
    "PRIORITY": "PRIORITY",
    "CUSTOMER": "CUSTOMER",
    "CUSTOMER_KEY": "CUSTOMER",
    "TOTAL": "TOTAL",
}


def years(spark, sf):
    """The years that `orders` holds; one number per release."""
    found = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return sorted(r["year"] for r in found.collect())


def slices(spark, sf, columns):
    """One release per year of `orders`; `columns` gives the SQL columns of a year."""
    orders = table(spark, sf, "orders")
    return {
        y: orders.where(
            f"o_orderdate >= timestamp_ntz'{y}-01-01' and o_orderdate < timestamp_ntz'{y + 1}-01-01'"
        ).selectExpr(*columns(y))
        for y in years(spark, sf)
    }


def _drifted(year):
    key = "CASE_NO" if year <= 1997 else "CASE_NUMBER" if year <= 1999 else "CASE_ID"
    names = [f"o_orderkey AS {key}", f"o_orderstatus AS {'STATUS' if year <= 1999 else 'CASE_STATUS'}"]
    if year >= 1998:
        names.append("o_orderpriority AS PRIORITY")
    if year in (1996, 1999):
        names.append("o_orderdate AS VOIDED_DATE")
    names.append(f"o_custkey AS {'CUSTOMER_KEY' if year % 2 else 'CUSTOMER'}")
    return [*names, "o_totalprice AS TOTAL"]


def drifted_cases(spark, sf):
    return harmonise(slices(spark, sf, _drifted), CASE_MAPPING, CASES)


def harmonise_parties(spark, sf):
    parties = {2024: table(spark, sf, "customer"), 2025: table(spark, sf, "supplier")}
    mapping = {
        "c_custkey": "PARTY_ID", "s_suppkey": "PARTY_ID", "c_name": "NAME", "s_name": "NAME",
        "c_nationkey": "NATION", "s_nationkey": "NATION", "c_acctbal": "BALANCE", "s_acctbal": "BALANCE",
        "c_mktsegment": "SEGMENT",
    }
    target = layout(PARTY_ID=LONG, NAME=TEXT, NATION=INT, BALANCE=T.DoubleType(), SEGMENT=TEXT)
    return harmonise(parties, mapping, target)


def _clashing(year):
    customer = "CASE WHEN o_orderkey % 7 = 0 THEN concat('C', o_custkey) ELSE cast(o_custkey AS STRING) END"
    return ["o_orderkey AS CASE_ID", f"{customer if year % 2 else 'o_custkey'} AS CUSTOMER"]


def _clash(spark, sf):
    return harmonise(
        slices(spark, sf, _clashing), CASE_MAPPING, layout(CASE_ID=LONG, CUSTOMER=LONG), audit=True
    )


def harmonise_collision(spark, sf):
    def columns(year):
        return ["if(o_orderkey % 3 = 0, null, o_orderkey) AS CASE_NO", "-o_orderkey AS CASE_NUMBER", "o_orderstatus AS STATUS"]

    return harmonise(slices(spark, sf, columns), CASE_MAPPING, layout(CASE_ID=LONG, CASE_STATUS=TEXT))


def harmonised_sink(spark, sf):
    path = shared_dir(spark, "harmonised")
    write_harmonised(drifted_cases(spark, sf), path)
    stored = spark.read.parquet(path)
    return (
        stored.groupBy("SOURCE_YEAR", "CASE_STATUS")
        .agg(F.count("PRIORITY").alias("priorities"), F.max("CASE_ID").alias("last_case"))
    )


def _headers(spark, sf):
    return table(spark, sf, "orders").select(
        F.year("o_orderdate").alias("release"), F.concat_ws("_", "o_orderstatus", "o_custkey").alias("column_name")
    )


def _header_mapping(spark, sf):
    return table(spark, sf, "customer").select(
        F.format_string(" O_%d ", "c_custkey").alias("original"),
        F.concat_ws("_", "c_mktsegment", "c_nationkey").alias("final"),
        F.col("c_custkey").alias("line_no"),
    )


def _header_targets(spark, sf):
    return table(spark, sf, "nation").select(F.concat_ws("_", F.lit("BUILDING"), "n_nationkey").alias("column_name"))


def unmapped_columns(spark, sf):
    headers = _headers(spark, sf)
    ignored = headers.where("release = 1996 and column_name like 'P%'").distinct()
    return unmapped_report(
        audit_columns(headers, _header_mapping(spark, sf), _header_targets(spark, sf), ignored)
    )


def mapping_on_target(spark, sf):
    return on_target(effective_mapping(_header_mapping(spark, sf)), _header_targets(spark, sf))


def mapping_last_wins(spark, sf):
    lines = table(spark, sf, "orders").select(
        F.format_string("\t C%d ", "o_custkey").alias("original"),
        F.concat("o_orderpriority", F.lit("  ")).alias("final"),
        F.col("o_orderkey").alias("line_no"),
    )
    return effective_mapping(lines)


def release_file_pick(spark, sf):
    kind = F.col("p_partkey") % 5
    name = (
        F.when(kind == 0, F.format_string("data_%d.xlsx", "p_partkey"))
        .when(kind == 1, F.format_string("PW_Disclosure_Data_%d.xlsx", "p_partkey"))
        .when(kind == 2, F.format_string("PW_Disclosure_Data_%d_New_Form.xlsx", "p_partkey"))
        .when(kind == 3, F.format_string("notes_%d.csv", "p_partkey"))
        .otherwise(F.format_string("PW_Disclosure_Data_%d_revised_form.XLSX", "p_partkey"))
    )
    listing = table(spark, sf, "part").select(
        F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand"))
        .otherwise(F.format_string("y%d", F.floor(F.col("p_partkey") / 8)))
        .alias("release"),
        name.alias("file_name"),
    )
    return pick_release_files(listing)


QUERIES = {
    "harmonise_orders_by_year": drifted_cases,
    "harmonise_parties": harmonise_parties,
    "harmonise_type_clash": lambda spark, sf: _clash(spark, sf).drop("_rejected"),
    "harmonise_rejects": lambda spark, sf: reject_counts(_clash(spark, sf)),
    "harmonise_collision": harmonise_collision,
    "source_year_counts": lambda spark, sf: release_volumes(drifted_cases(spark, sf)),
    "harmonised_sink": harmonised_sink,
    "unmapped_columns": unmapped_columns,
    "mapping_on_target": mapping_on_target,
    "mapping_last_wins": mapping_last_wins,
    "release_file_pick": release_file_pick,
}

_CASES = """
    SELECT o_orderkey AS "CASE_ID", o_orderstatus AS "CASE_STATUS",
           CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS "PRIORITY",
           o_custkey AS "CUSTOMER", o_totalprice AS "TOTAL", CAST(year(o_orderdate) AS INTEGER) AS "SOURCE_YEAR"
    FROM orders"""

ORACLE = {
    "harmonise_orders_by_year": _CASES,
    "harmonise_parties": """
        SELECT c_custkey AS "PARTY_ID", c_name AS "NAME", c_nationkey AS "NATION", c_acctbal AS "BALANCE",
               c_mktsegment AS "SEGMENT", 2024 AS "SOURCE_YEAR" FROM customer
        UNION ALL
        SELECT s_suppkey, s_name, s_nationkey, s_acctbal, CAST(NULL AS VARCHAR), 2025 FROM supplier""",
    "harmonise_type_clash": """
        SELECT o_orderkey AS "CASE_ID",
               CASE WHEN year(o_orderdate) % 2 = 1 AND o_orderkey % 7 = 0 THEN NULL ELSE o_custkey END AS "CUSTOMER",
               CAST(year(o_orderdate) AS INTEGER) AS "SOURCE_YEAR" FROM orders""",
    "harmonise_rejects": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS "SOURCE_YEAR", 'CUSTOMER' AS column_name, count(*) AS rejected
        FROM orders WHERE year(o_orderdate) % 2 = 1 AND o_orderkey % 7 = 0 GROUP BY ALL""",
    "harmonise_collision": """
        SELECT CASE WHEN o_orderkey % 3 = 0 THEN -o_orderkey ELSE o_orderkey END AS "CASE_ID",
               o_orderstatus AS "CASE_STATUS", CAST(year(o_orderdate) AS INTEGER) AS "SOURCE_YEAR" FROM orders""",
    "source_year_counts": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS "SOURCE_YEAR", count(*) AS row_count, 6 AS column_count
        FROM orders GROUP BY 1""",
    "harmonised_sink": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS "SOURCE_YEAR", o_orderstatus AS "CASE_STATUS",
               count(CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END) AS priorities, max(o_orderkey) AS last_case
        FROM orders GROUP BY 1, 2""",
    "unmapped_columns": """
        SELECT o_orderstatus || '_' || o_custkey AS "COLUMN_NAME",
               string_agg(DISTINCT CAST(year(o_orderdate) AS VARCHAR), ', ' ORDER BY CAST(year(o_orderdate) AS VARCHAR))
                   AS "YEARS_APPEARED"
        FROM orders
        WHERE NOT (year(o_orderdate) = 1996 AND o_orderstatus = 'P')
          AND NOT (o_orderstatus = 'O' AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
        GROUP BY 1""",
    "mapping_on_target": """
        SELECT 'O_' || c_custkey AS original, c_mktsegment || '_' || c_nationkey AS final
        FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "mapping_last_wins": """
        SELECT 'C' || o_custkey AS original, arg_max(o_orderpriority, o_orderkey) AS final FROM orders GROUP BY 1""",
    "release_file_pick": """
        WITH listing AS (
            SELECT CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE 'y' || (p_partkey // 8) END AS release,
                   CASE p_partkey % 5 WHEN 0 THEN 'data_' || p_partkey || '.xlsx'
                        WHEN 1 THEN 'PW_Disclosure_Data_' || p_partkey || '.xlsx'
                        WHEN 2 THEN 'PW_Disclosure_Data_' || p_partkey || '_New_Form.xlsx'
                        WHEN 3 THEN 'notes_' || p_partkey || '.csv'
                        ELSE 'PW_Disclosure_Data_' || p_partkey || '_revised_form.XLSX' END AS file_name
            FROM part),
        books AS (
            SELECT *, count(*) OVER (PARTITION BY release) AS n FROM listing WHERE file_name LIKE '%.xlsx'),
        ranked AS (
            SELECT release, file_name,
                   row_number() OVER (PARTITION BY release ORDER BY file_name NOT LIKE '%New_Form%', file_name) AS rn
            FROM books WHERE n = 1 OR file_name LIKE '%Disclosure_Data%')
        SELECT DISTINCT l.release, r.file_name
        FROM listing l LEFT JOIN ranked r ON r.release = l.release AND r.rn = 1""",
}
