"""From a table of crawled pages to releases and their file links.

Reading a page is narrow. The only shuffles are the final dedupes, on a few short
columns of the links that passed the filters, and they combine on the map side, so a
page or a URL that holds a large share of all links is reduced before it travels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import html as H
from tidemark.functions.text import contains_any, ends_with_any
from tidemark.functions.url import last_segment, resolve_url, url_path

# What the yearbook pages use.
CATEGORY_HEADER = "view-field-data-categories-table-column"
FILE_EXTENSIONS = (".pdf", ".xlsx", ".xls", ".zip")
EXCLUDED_KEYWORDS = ("enforcement", "refugee", "asylee")
YEAR_IN_URL = r"/yearbook/(\d{4})(?:-\d{4})?/?\z"
YEAR_IN_TEXT = r"(?iU)Yearbook\s+(\d{4})(?:\s+to\s+\d{4})?"


def page_anchors(
    pages: DataFrame, keys=("page_id", "url"), html: str = "html", category_header: str = CATEGORY_HEADER
) -> DataFrame:
    """One row per anchor with an href: `keys`, pos, href, title, category."""
    keys = list(keys)
    cut = pages.select(*keys, F.col(html).alias("_html")).where("_html IS NOT NULL").withColumn(
        "_segments", F.expr(H.page_segments("_html", category_header))
    )
    # A column of its own, so that the test runs once per page; only what the parser reads goes on as HTML.
    tested = cut.withColumn("_odd", F.when(F.expr(H.needs_parser("_html", "_segments")), F.col("_html"))).drop("_html")
    parsed = tested.withColumn("_parsed", H.parsed_anchors(F.col("_odd"), category_header))
    anchors = F.coalesce(F.col("_parsed"), F.expr(H.plain_anchors("_segments")))
    return parsed.select(*keys, F.posexplode(anchors).alias("pos", "_anchor")).select(
        *keys, "pos", "_anchor.href", "_anchor.title", "_anchor.category"
    )


def with_extension(links: DataFrame, extensions=FILE_EXTENSIONS) -> DataFrame:
    """Links whose lowercased URL path ends in one of `extensions`; adds `path`."""
    return links.withColumn("path", F.expr(f"lower({url_path('href')})")).where(
        ends_with_any(F.col("path"), extensions)
    )


def without_keywords(links: DataFrame, keywords=EXCLUDED_KEYWORDS) -> DataFrame:
    """Links whose title and category hold none of `keywords`."""
    return links.where(~contains_any(F.concat_ws(" ", "title", "category"), keywords))


def first_per_url(links: DataFrame, keys) -> DataFrame:
    """Each URL once per `keys`, in the form it took first on the page."""
    rest = [c for c in links.columns if c not in (*keys, "url_to", "pos")]
    return (
        links.groupBy(*keys, "url_to")
        .agg(F.min(F.struct("pos", *rest)).alias("_first"))
        .select(*keys, "url_to", "_first.pos", *[F.col(f"_first.{c}").alias(c) for c in rest])
    )


def allowed_links(
    pages: DataFrame,
    site_root: str,
    keys=("page_id",),
    extensions=FILE_EXTENSIONS,
    excluded=EXCLUDED_KEYWORDS,
    category_header: str = CATEGORY_HEADER,
) -> DataFrame:
    """Every mention of a file on a page, by extension and keywords. Narrow."""
    anchors = page_anchors(pages, keys, category_header=category_header)
    allowed = without_keywords(with_extension(anchors, extensions), excluded)
    return allowed.select(
        *keys,
        "pos",
        F.expr(resolve_url(site_root, "href", base_is_literal=True)).alias("url_to"),
        F.expr(last_segment("path")).alias("filename"),
        "title",
        "category",
    )


def extract_links(pages: DataFrame, site_root: str, keys=("page_id",), **options) -> DataFrame:
    """File links of all pages, each URL once per `keys`: url, filename, title, category, pos.

    A link is filtered before duplicates fall away, so an excluded first mention of
    a URL does not hide a later allowed one. Options as for `allowed_links`.
    """
    keys = list(keys)
    return first_per_url(allowed_links(pages, site_root, keys, **options), keys).withColumnRenamed("url_to", "url")


def discover_releases(
    pages: DataFrame,
    base: str,
    keys=("page_id",),
    year_in_url: str = YEAR_IN_URL,
    year_in_text: str = YEAR_IN_TEXT,
) -> DataFrame:
    """Release pages an index page links to: `keys`, year, url.

    A year read from the URL beats one read from the link text; of several URL hits
    the last counts, of several text hits the first. `base` is the index address, or
    the name of a column among `keys` that holds it.
    """
    keys = list(keys)
    anchors = page_anchors(pages, keys)
    by_url = F.nullif(F.regexp_extract("href", year_in_url, 1), F.lit("")).try_cast("int")
    by_text = F.nullif(F.regexp_extract("title", year_in_text, 1), F.lit("")).try_cast("int")
    found = anchors.select(
        *keys,
        F.coalesce(by_url, by_text).alias("year"),
        F.struct(
            by_url.isNotNull().alias("by_url"), F.when(by_url.isNotNull(), F.col("pos")).otherwise(-F.col("pos")).alias("place")
        ).alias("_rank"),
        "href",
    ).where("year is not null")
    chosen = found.groupBy(*keys, "year").agg(F.max_by("href", "_rank").alias("href"))
    address = resolve_url(f"`{base}`", "href") if base in keys else resolve_url(base, "href", base_is_literal=True)
    return chosen.select(*keys, "year", F.expr(address).alias("url"))


def link_volumes(links: DataFrame, keys=("period",)) -> DataFrame:
    """Number of links per release: `keys`, link_count."""
    return links.groupBy(*keys).agg(F.count(F.lit(1)).alias("link_count"))


def newest_first(releases: DataFrame) -> DataFrame:
    """Release list for reading, newest year first."""
    return releases.orderBy(F.desc("year"))
