"""Page queries: `pages` as they are, and pages rendered from a table, so that the
oracle can answer from that table and never reads HTML."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.names import stored_name
from tidemark.functions.url import last_segment, resolve_url, url_path
from tidemark.operators.links import (
    CATEGORY_HEADER,
    discover_releases,
    extract_links,
    link_volumes,
    newest_first,
    page_anchors,
    with_extension,
    without_keywords,
)
from workload.data import table

SITE = "https://stats.example.org"
INDEX = f"{SITE}/topics/yearbook"
EXCLUDED = ["Promo", "rod"]
# A rendered page holds so many rows; more data makes more pages, not larger ones.
ROWS_PER_PAGE = 100


def anchors(spark, sf):
    return page_anchors(table(spark, sf, "pages"), ["page_id"]).select(
        "page_id", F.col("pos").cast("long").alias("pos"), "href", "title"
    )


def page_links_resolved(spark, sf):
    found = page_anchors(table(spark, sf, "pages"))
    return found.select(
        "page_id", F.col("pos").cast("long").alias("pos"), F.expr(resolve_url("url", "href")).alias("link")
    )


def url_parts(spark, sf):
    pages = table(spark, sf, "pages")
    path = f"lower({url_path('url')})"
    return pages.select(
        "page_id",
        F.expr(path).alias("path"),
        F.expr(last_segment(path)).alias("filename"),
        stored_name(F.col("url"), F.col("page_id").cast("string")).alias("stored_name"),
    )


def index_pages(spark, sf):
    """An index page per customer, linking the years they ordered in (seven at most)."""
    years = (
        table(spark, sf, "orders")
        .select(F.col("o_custkey").alias("page_id"), F.year("o_orderdate").alias("year"))
        .groupBy("page_id")
        .agg(F.sort_array(F.collect_set("year")).alias("years"))
    )
    by_url = "concat('<p><a href=\"/old/', y, '\">Yearbook ', y, '</a><a href=\"/topics/yearbook/', y, '\">Tables</a></p>')"
    twice = "concat('<a href=\"a/yearbook/1998-1999\">A</a><a href=\" ../b/yearbook/1998/ \">B</a>')"
    by_text = (
        "concat('<li><a href=\"first/', y, '\">Statistical <i>yearbook ', y, '</i> to ', y + 1, '</a>',"
        "'<a href=\"second/', y, '\">Yearbook ', y, '</a></li>')"
    )
    body = f"transform(years, y -> CASE WHEN y = 1998 THEN {twice} WHEN y % 2 = 0 THEN {by_url} ELSE {by_text} END)"
    return years.select(
        "page_id", F.expr(f"concat('<html><!-- <a href=\"/x/yearbook/1900\"></a> -->', array_join({body}, ''), '</html>')").alias("html")
    )


def release_discovery(spark, sf):
    return discover_releases(index_pages(spark, sf), INDEX)


def release_pages(spark, sf):
    """A release page per `ROWS_PER_PAGE` parts, a table row per part."""
    href = F.concat(
        F.lit("/files/"),
        F.col("p_partkey").cast("string"),
        F.element_at(
            F.array(*map(F.lit, (".pdf", ".xlsx", ".xls", ".ZIP", ".html", ".pdf?x=1&amp;y=2"))),
            (F.col("p_partkey") % 6 + 1).cast("int"),
        ),
    )
    link = F.concat(F.lit('<a class="f" href="'), href, F.lit('">'))
    real = F.concat(link, F.lit(" <b>"), F.col("p_name"), F.lit("</b> </a>"))
    cells = (
        F.when(F.col("p_partkey") % 20 == 0, F.concat(link, F.lit("promotion</a>"), real))
        .when(F.col("p_partkey") % 20 == 10, F.concat(real, link, F.lit("again</a>")))
        .otherwise(real)
    )
    row = F.concat(
        F.lit(f'<tr><td headers="{CATEGORY_HEADER}">'), F.col("p_type"), F.lit(' &amp; more</td><td headers="x">'), cells, F.lit("</td></tr>")
    )
    rows = table(spark, sf, "part").select(
        F.floor(F.col("p_partkey") / ROWS_PER_PAGE).alias("page_id"), F.struct("p_partkey", row.alias("row")).alias("row")
    )
    return rows.groupBy("page_id").agg(
        F.concat(
            F.lit("<html><body><table>"),
            F.array_join(F.transform(F.sort_array(F.collect_list("row")), lambda r: r["row"]), "\n"),
            F.lit("</table></body></html>"),
        ).alias("html")
    )


def link_extraction(spark, sf):
    return extract_links(release_pages(spark, sf), SITE, ["page_id"], excluded=EXCLUDED).drop("pos")


def _part_links(spark, sf):
    ext = F.element_at(
        F.array(*map(F.lit, (".pdf", ".XLSX?v=1", ".html", ".zip#top", ".pdf.txt", ".xls;v=2"))),
        (F.col("p_partkey") % 6 + 1).cast("int"),
    )
    return table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit("d/"), F.col("p_type"), F.lit("/"), F.col("p_partkey").cast("string"), ext).alias("href"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
    )


QUERIES = {
    "page_anchors": anchors,
    "page_links_resolved": page_links_resolved,
    "url_parts": url_parts,
    "release_discovery": release_discovery,
    "releases_newest_first": lambda spark, sf: newest_first(release_discovery(spark, sf)),
    "link_extraction": link_extraction,
    "link_volumes": lambda spark, sf: link_volumes(link_extraction(spark, sf), ["page_id"]),
    "extension_filter": lambda spark, sf: with_extension(_part_links(spark, sf)).select("p_partkey", "path"),
    "keyword_exclusion": lambda spark, sf: without_keywords(_part_links(spark, sf), EXCLUDED).select(
        "p_partkey", "title", "category"
    ),
}

_VISIBLE = "regexp_replace(regexp_replace(html, '<script.*?</script>', '', 'gs'), '<!--.*?-->', '', 'gs')"
_ANCHORS = f"""
    SELECT page_id, url, unnest(a) AS anchor, generate_subscripts(a, 1) - 1 AS pos
    FROM (SELECT page_id, url, regexp_extract_all({_VISIBLE}, '<a href="[^"]*">[^<]*</a>') AS a FROM pages)"""
_DISCOVERED = """
    SELECT DISTINCT o_custkey AS page_id, CAST(year(o_orderdate) AS INTEGER) AS year,
           CASE WHEN year(o_orderdate) = 1998 THEN 'https://stats.example.org/b/yearbook/1998/'
                WHEN year(o_orderdate) % 2 = 0 THEN 'https://stats.example.org/topics/yearbook/' || year(o_orderdate)
                ELSE 'https://stats.example.org/topics/first/' || year(o_orderdate) END AS url
    FROM orders"""

ORACLE = {
    "page_anchors": f"""
        SELECT page_id, pos, regexp_extract(anchor, 'href="([^"]*)"', 1) AS href,
               trim(regexp_extract(anchor, '>([^<]*)</a>', 1)) AS title
        FROM ({_ANCHORS})""",
    "page_links_resolved": f"""
        SELECT page_id, pos, regexp_extract(url, '^https?://[^/]*') || regexp_extract(anchor, 'href="([^"]*)"', 1) AS link
        FROM ({_ANCHORS})""",
    "url_parts": """
        WITH p AS (SELECT page_id, url, lower(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)) AS path FROM pages)
        SELECT page_id, path, split_part(rtrim(path, '/'), '/', -1) AS filename,
               split_part(rtrim(split_part(url, '?', 1), '/'), '/', -1) AS stored_name FROM p""",
    # 1998 is first named as a range 1998-1999 and then by itself; the last link counts.
    "release_discovery": _DISCOVERED,
    "releases_newest_first": _DISCOVERED,
    "link_volumes": """
        SELECT p_partkey // 100 AS page_id, count(*) AS link_count FROM part
        WHERE p_partkey % 6 <> 4 AND NOT regexp_matches(lower(p_type), 'promo|rod')
          AND (p_partkey % 20 = 10 OR NOT regexp_matches(lower(p_name), 'promo|rod'))
        GROUP BY 1""",
    "link_extraction": """
        WITH shown AS (
            SELECT *, p_partkey % 20 = 10 AS twice,
                   regexp_matches(lower(p_name), 'promo|rod') AS bad_name,
                   regexp_matches(lower(p_type), 'promo|rod') AS bad_type FROM part)
        SELECT p_partkey // 100 AS page_id,
               'https://stats.example.org/files/' || p_partkey
                   || (['.pdf', '.xlsx', '.xls', '.ZIP', '.html', '.pdf?x=1&y=2'])[p_partkey % 6 + 1] AS url,
               p_partkey || (['.pdf', '.xlsx', '.xls', '.zip', '.html', '.pdf'])[p_partkey % 6 + 1] AS filename,
               CASE WHEN bad_name THEN 'again' ELSE p_name END AS title,
               p_type || ' & more' AS category
        FROM shown WHERE p_partkey % 6 <> 4 AND NOT bad_type AND (NOT bad_name OR twice)""",
    "extension_filter": """
        SELECT p_partkey, lower('d/' || p_type || '/' || p_partkey || (['.pdf', '.xlsx', '', '.zip', '', '.xls'])[p_partkey % 6 + 1]) AS path
        FROM part WHERE p_partkey % 6 IN (0, 1, 3, 5)""",
    "keyword_exclusion": """
        SELECT p_partkey, p_name AS title, p_type AS category FROM part
        WHERE NOT regexp_matches(lower(p_name || ' ' || p_type), 'promo|rod')""",
}
