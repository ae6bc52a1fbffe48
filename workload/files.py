"""Queries over files written from the tables: listed, probed, read and reported again."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.audit import effective_mapping, unmapped_report
from tidemark.operators.inventory import list_paths
from tidemark.operators.ledger import register_existing
from tidemark.operators.links import page_anchors
from tidemark.plans.harmonise_run import harmonise_files, release_files
from tidemark.session import shared_dir
from tidemark.sources.binary import file_system, normal_folder
from tidemark.sources.schemas import LONG, TEXT, table as layout
from tidemark.sources.tables import read_mapping, release_schema, stored_megabytes, write_unmapped_report
from workload.data import table
from workload.releases import CASE_MAPPING, years

SOURCE = "yearbook"


def _store(files):
    """Write `files` (path, text), each as a file of its own."""

    def write(batches):
        for batch in batches:
            for path, text in zip(batch["path"], batch["text"], strict=True):
                system, inner = file_system(path)
                system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(inner) as out:
                    out.write(text.encode())
            yield pd.DataFrame({"path": batch["path"]})

    files.select("path", "text").mapInPandas(write, "path STRING").write.format("noop").mode("overwrite").save()


def stored_documents(spark, sf):
    """Every document as a file of its own, below a folder per language: the folder."""
    folder = normal_folder(spark, shared_dir(spark, "files"))
    path = F.format_string("%s/%s/%d.txt", F.lit(folder), "lang", "doc_id")
    _store(table(spark, sf, "documents").withColumn("path", path))
    return folder


def stored_size(spark, sf):
    return stored_megabytes(list_paths(spark, stored_documents(spark, sf)).where("NOT is_dir"))


def chosen_releases(spark, sf):
    """Main files of the even years' release folders; a file per year and status, those of one status in the new form."""
    folder = normal_folder(spark, shared_dir(spark, "folders"))
    files = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("year"), "o_orderstatus").agg(F.count("*").cast("string").alias("text"))
    name = F.expr("concat('Disclosure_Data_', o_orderstatus, if(o_orderstatus = 'P', '_New_Form', ''), if(year % 4 = 0 AND o_orderstatus = 'F', '.csv', '.xlsx'))")
    _store(files.withColumn("path", F.concat_ws("/", F.lit(folder), "year", name)))
    found = release_files(spark, folder, releases=[y for y in years(spark, sf) if y % 2 == 0])
    return spark.createDataFrame([(y, p.rsplit("/", 1)[1]) for y, p in found.items()], "release INT, file_name STRING")


def listed_files(spark, sf):
    folder = stored_documents(spark, sf)
    found = list_paths(spark, folder)
    return found.select(F.substring("path", len(folder) + 2, 1000).alias("path"), "is_dir", "length")


def registered_files(spark, sf):
    """Files found at their expected places and hashed there; labelled documents are known already,
    and every part is a link whose file is not there."""
    folder = stored_documents(spark, sf)
    links = table(spark, sf, "documents").selectExpr(
        "lang AS period", "concat('https://docs.example.org/', source, '/', doc_id, '.TXT') AS url", "concat(doc_id, '.txt') AS filename", "doc_id"
    )
    absent = table(spark, sf, "part").selectExpr(
        "'en' AS period", "concat('https://docs.example.org/absent/', p_partkey) AS url", "concat('absent-', p_partkey, '.txt') AS filename", "cast(null AS BIGINT) AS doc_id"
    )
    links = links.unionByName(absent)
    known = links.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").select("period", "url")
    files = list_paths(spark, f"file:{folder}" if folder.startswith("/") else folder).where("NOT is_dir").select("path")
    return register_existing(links.drop("doc_id"), known, files, folder, SOURCE).select("period", "url", "filename", "bytes", "sha256", "version")


def _release_columns(year):
    """Names drift, and one column comes and goes."""
    key = "CASE_NO" if year <= 1997 else "CASE_ID"
    columns = [f"o_orderkey AS {key}", "o_orderstatus AS STATUS", "o_orderdate AS RECEIVED", "o_totalprice AS TOTAL"]
    return [*columns, "if(o_orderkey % 9 = 0, 'n/a', cast(o_custkey AS STRING)) AS CUSTOMER"] if year % 2 else columns


def csv_releases(spark, sf):
    """A CSV release per year of `orders`: year and path."""
    folder = shared_dir(spark, "releases")
    orders = table(spark, sf, "orders")
    paths = {}
    for year in years(spark, sf):
        paths[year] = f"{folder}/{year}.csv"
        of_year = orders.where(F.year("o_orderdate") == year).selectExpr(*_release_columns(year))
        of_year.write.option("header", True).csv(paths[year])
    return paths


def release_headers(spark, sf):
    """Column names of every CSV release, from the headers alone."""
    names = [(y, i, f.name) for y, p in csv_releases(spark, sf).items() for i, f in enumerate(release_schema(spark, p).fields)]
    return spark.createDataFrame(names, "release INT, pos BIGINT, column_name STRING")


_TARGET = layout(CASE_ID=LONG, CASE_STATUS=TEXT, RECEIVED=T.DateType(), TOTAL=T.DoubleType(), CUSTOMER=LONG)


def _harmonised(spark, sf):
    """CSV releases harmonised file by file under a declared target: output folder, unmapped report, what was observed."""
    mapping = shared_dir(spark, "mapping")
    lines = [*CASE_MAPPING.items(), ("TOTAL", "NOWHERE"), (" TOTAL", "TOTAL "), ("RECEIVED", "RECEIVED, or not"), ("RECEIVED", "RECEIVED")]
    columns = spark.createDataFrame([(i, *line) for i, line in enumerate(lines)], "i INT, ORIGINAL STRING, FINAL STRING")
    columns.coalesce(1).orderBy("i").drop("i").write.option("header", True).csv(mapping)
    output, report = shared_dir(spark, "harmonised"), shared_dir(spark, "unmapped")
    files = csv_releases(spark, sf)
    target = T.StructType([f for f in _TARGET if f.name != "CUSTOMER"])
    seen = harmonise_files(spark, files, mapping, max(files), output, report, target)
    return output, report, seen


def harmonised_files(spark, sf):
    return spark.read.parquet(_harmonised(spark, sf)[0]).select("CASE_ID", "CASE_STATUS", "RECEIVED", "TOTAL", "SOURCE_YEAR")


def observed_counts(spark, sf):
    """Rows per release as they were observed while the table was written."""
    seen = _harmonised(spark, sf)[2]
    return spark.createDataFrame([(y, n) for y, n in seen.rows_by_release.items()], "SOURCE_YEAR INT, row_count BIGINT")


def unmapped_file(spark, sf):
    """The report of columns without a home, written and read back."""
    return spark.read.option("header", True).csv(_harmonised(spark, sf)[1])


def _drifting(spark, sf):
    """Harmonising without a declared target: the table's types come from the cells of all releases."""
    mapping, output = shared_dir(spark, "mapping"), shared_dir(spark, "harmonised")
    lines = [("CASE_NO", "CASE_ID"), ("TOTAL", "TOTAL")]
    # Columns in another order, one more, and the final name's as the mapping file calls it; other names stay.
    columns = spark.createDataFrame([(i, "x", final, original) for i, (original, final) in enumerate(lines)], "i INT, NOTE STRING, FINAL_2025 STRING, ORIGINAL STRING")
    columns.coalesce(1).orderBy("i").drop("i").write.option("header", True).csv(mapping)
    files = csv_releases(spark, sf)
    # The newest release with a column for every target decides their names.
    harmonise_files(spark, files, mapping, max(y for y in files if y % 2), output, infer=True, identity=True)
    return spark.read.parquet(output)


def inferred_types(spark, sf):
    found = _drifting(spark, sf).schema
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in found], "column_name STRING, type STRING")


def inferred_releases(spark, sf):
    return _drifting(spark, sf).select("CASE_ID", "STATUS", "RECEIVED", "TOTAL", "CUSTOMER", "SOURCE_YEAR")


def mapping_shuffled(spark, sf):
    """A long mapping in two folders' worth of files whose headers differ in order and columns."""
    folder = shared_dir(spark, "mapping")
    lines = table(spark, sf, "orders").selectExpr("o_orderkey", "concat('C', o_custkey) AS ORIGINAL", "concat(o_orderpriority, ', x') AS FINAL_2025", "o_orderstatus AS CLERK")
    kept = {"header": True, "escape": '"'}
    for name, columns in (("a", ["CLERK", "FINAL_2025", "ORIGINAL"]), ("b", ["ORIGINAL", "FINAL_2025"])):
        part = lines.where(F.col("o_orderkey") % 2 == int(name == "b")).repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey")
        part.select(*columns).write.options(**kept).csv(f"{folder}/{name}")
    return read_mapping(spark, f"{folder}/*").groupBy("original", "final").agg(F.count("*").alias("line_count"))


def mapping_file(spark, sf):
    """A long mapping written as CSV with quotes and commas, and read back in order."""
    folder = shared_dir(spark, "mapping")
    lines = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "concat('\"C\", ', o_custkey) AS ORIGINAL", "concat(o_orderpriority, ' \"x\"') AS FINAL"
    )
    lines.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").drop("o_orderkey").write.options(header=True, escape='"').csv(folder)
    return effective_mapping(read_mapping(spark, folder))


def report_file(spark, sf):
    """Customers' orders by year as an audit, written as a report and read back."""
    audit = table(spark, sf, "orders").groupBy(F.format_string("c%d", "o_custkey").alias("column_name")).agg(F.sort_array(F.collect_set(F.year("o_orderdate"))).alias("years"))
    folder = shared_dir(spark, "report")
    write_unmapped_report(unmapped_report(audit), folder)
    return spark.read.option("header", True).csv(folder)


def odd_page_anchors(spark, sf):
    """A page per part, of four kinds: plain, with a template, with a bare href, with rare references."""
    link = "concat('<a href=\"/p/', p_partkey, '.pdf\">')"
    pages = table(spark, sf, "part").selectExpr(
        "p_partkey AS page_id",
        f"""CASE p_partkey % 4
            WHEN 0 THEN concat('<p>', {link}, p_name, '</a></p>')
            WHEN 1 THEN concat('<template>', {link}, 'T</a></template>', {link}, p_name, '<template>no</template></a>')
            WHEN 2 THEN concat('<a href>', p_name, '</a>', {link}, 'x</a>')
            ELSE concat('<template>', {link}, 'T</a></template>&copy;', {link}, p_name, ' &eacute;</a>') END AS html""",
    )
    return page_anchors(pages, ["page_id"]).select("page_id", F.col("pos").cast("long").alias("pos"), "href", "title")


QUERIES = {
    "listed_files": listed_files,
    "registered_files": registered_files,
    "stored_size": stored_size,
    "chosen_releases": chosen_releases,
    "release_headers": release_headers,
    "harmonised_files": harmonised_files,
    "observed_counts": observed_counts,
    "unmapped_file": unmapped_file,
    "mapping_file": mapping_file,
    "mapping_shuffled": mapping_shuffled,
    "inferred_types": inferred_types,
    "inferred_releases": inferred_releases,
    "report_file": report_file,
    "odd_page_anchors": odd_page_anchors,
}

_YEAR = "CAST(year(o_orderdate) AS INTEGER)"
_HREF = "'/p/' || p_partkey || '.pdf'"

ORACLE = {
    "listed_files": """
        SELECT lang || '/' || doc_id || '.txt' AS path, false AS is_dir, octet_length(encode(text)) AS length FROM documents
        UNION ALL SELECT DISTINCT lang, true, CAST(NULL AS BIGINT) FROM documents""",
    "registered_files": """
        SELECT lang AS period, 'https://docs.example.org/' || source || '/' || doc_id || '.TXT' AS url, doc_id || '.txt' AS filename,
               octet_length(encode(text)) AS bytes, sha256(text) AS sha256, 1 AS version
        FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "stored_size": "SELECT round(coalesce(sum(octet_length(encode(text))), 0) / 1048576, 2) AS size_mb FROM documents",
    "chosen_releases": """
        WITH named AS (
            SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS release, o_orderstatus = 'P' AS favoured,
                   'Disclosure_Data_' || o_orderstatus || CASE WHEN favoured THEN '_New_Form' ELSE '' END || '.xlsx' AS file_name
            FROM orders WHERE year(o_orderdate) % 2 = 0 AND NOT (year(o_orderdate) % 4 = 0 AND o_orderstatus = 'F'))
        SELECT release, coalesce(min(file_name) FILTER (favoured), min(file_name)) AS file_name FROM named GROUP BY release""",
    "release_headers": f"""
        WITH y AS (SELECT DISTINCT {_YEAR} AS release FROM orders),
        named AS (SELECT release, unnest([CASE WHEN release <= 1997 THEN 'CASE_NO' ELSE 'CASE_ID' END, 'STATUS', 'RECEIVED', 'TOTAL', 'CUSTOMER']) AS column_name,
                         unnest([0, 1, 2, 3, 4]) AS pos FROM y)
        SELECT release, CAST(pos AS BIGINT) AS pos, column_name FROM named WHERE pos < 4 OR release % 2 = 1""",
    "harmonised_files": f"""
        SELECT o_orderkey AS "CASE_ID", o_orderstatus AS "CASE_STATUS", CAST(o_orderdate AS DATE) AS "RECEIVED", o_totalprice AS "TOTAL",
               {_YEAR} AS "SOURCE_YEAR" FROM orders""",
    "observed_counts": f"""SELECT {_YEAR} AS "SOURCE_YEAR", count(*) AS row_count FROM orders GROUP BY 1""",
    "unmapped_file": f"""
        SELECT 'CUSTOMER' AS "COLUMN_NAME", string_agg(DISTINCT CAST({_YEAR} AS VARCHAR), ', ' ORDER BY CAST({_YEAR} AS VARCHAR)) AS "YEARS_APPEARED"
        FROM orders WHERE year(o_orderdate) % 2 = 1""",
    "mapping_file": """
        SELECT '"C", ' || o_custkey AS original, arg_max(o_orderpriority, o_orderkey) || ' "x"' AS final FROM orders GROUP BY o_custkey""",
    "mapping_shuffled": """
        SELECT 'C' || o_custkey AS original, o_orderpriority || ', x' AS final, count(*) AS line_count FROM orders GROUP BY ALL""",
    "inferred_types": r"""
        SELECT unnest(['CASE_ID', 'STATUS', 'RECEIVED', 'TOTAL', 'CUSTOMER', 'SOURCE_YEAR']) AS column_name,
               unnest(['bigint', 'string', CASE WHEN bool_and(o_orderdate = CAST(o_orderdate AS DATE)) AND min(typeof(o_orderdate)) = 'DATE' THEN 'date' ELSE 'timestamp' END,
                       'double', CASE WHEN bool_or(year(o_orderdate) % 2 = 1 AND o_orderkey % 9 = 0) THEN 'string' ELSE 'bigint' END, 'int']) AS type
        FROM orders""",
    "inferred_releases": f"""
        SELECT o_orderkey AS "CASE_ID", o_orderstatus AS "STATUS", o_orderdate AS "RECEIVED", o_totalprice AS "TOTAL",
               CASE WHEN year(o_orderdate) % 2 = 1 THEN CASE WHEN o_orderkey % 9 = 0 THEN 'n/a' ELSE CAST(o_custkey AS VARCHAR) END END AS "CUSTOMER",
               {_YEAR} AS "SOURCE_YEAR" FROM orders""",
    "report_file": f"""
        SELECT 'c' || o_custkey AS "COLUMN_NAME", string_agg(DISTINCT CAST({_YEAR} AS VARCHAR), ', ' ORDER BY CAST({_YEAR} AS VARCHAR)) AS "YEARS_APPEARED"
        FROM orders GROUP BY o_custkey""",
    "odd_page_anchors": f"""
        SELECT p_partkey AS page_id, 0 AS pos, {_HREF} AS href, p_name AS title FROM part WHERE p_partkey % 4 = 0
        UNION ALL SELECT p_partkey, 0, {_HREF}, '' FROM part WHERE p_partkey % 4 IN (1, 3)
        UNION ALL SELECT p_partkey, 1, {_HREF}, p_name || CASE WHEN p_partkey % 4 = 3 THEN ' é' ELSE '' END FROM part WHERE p_partkey % 4 IN (1, 3)
        UNION ALL SELECT p_partkey, 0, '', p_name FROM part WHERE p_partkey % 4 = 2
        UNION ALL SELECT p_partkey, 1, {_HREF}, 'x' FROM part WHERE p_partkey % 4 = 2""",
}
