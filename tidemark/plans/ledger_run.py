"""One incremental run of the ledger over a crawl."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import folder_of_archive
from tidemark.operators.inventory import reconcile_status
from tidemark.operators.ledger import SAFE, apply_changes, new_rows, plan_changes, repoint, run_summary
from tidemark.operators.links import allowed_links, discover_releases, extract_links, first_per_url
from tidemark.operators.reassign import moves_for_ledger, reassign_periods
from tidemark.operators.skew import skew_join
from tidemark.session import fits, materialise
from tidemark.sources.archives import expand_archives, moves_of_archives
from tidemark.sources.binary import normal_path
from tidemark.sources.ledger_store import LedgerStore


@dataclass
class ReleaseRun:
    """What a whole run did: counters, rows the cleanup kept or not, releases without a page, moves."""

    summary: DataFrame
    cleaned: DataFrame
    failed: DataFrame
    members: DataFrame | None = None
    moves: DataFrame | None = None


@dataclass
class LedgerRun:
    """What a run did, as tables."""

    applied: DataFrame
    summary: DataFrame


def links_of_crawl(
    index_pages: DataFrame, release_pages: DataFrame, index_url: str, site_root: str, **options
) -> DataFrame:
    """Links of every release the index pages name: period, url, filename, title, …

    Both inputs are (page_id, url, html); all release pages are read in one job, and
    their HTML is never shuffled: a short list of releases is broadcast to the pages,
    a long one is joined to the links found. Options as for `allowed_links`.
    """
    releases = discover_releases(index_pages, index_url)
    named = materialise(releases.select(F.col("year").cast("string").alias("period"), F.col("url").alias("page_url")).distinct())
    pages = release_pages.select(F.col("url").alias("page_url"), "html")
    if fits(named):
        of_release = pages.join(F.broadcast(named), "page_url").select("period", "html")
        return extract_links(of_release, site_root, ["period"], **options)
    found = skew_join(allowed_links(pages, site_root, ["page_url"], **options), named, ["page_url"], "inner")
    return first_per_url(found.drop("page_url"), ["period"]).withColumnRenamed("url_to", "url")


def clean_ledger(store: LedgerStore, paths: DataFrame) -> DataFrame:
    """Reconcile the stored ledger with `paths` (path, is_dir); returns status counts.

    The ledger is judged once; what is written anew are the periods in which a row was
    removed or repaired, and none if all is well.
    """
    layout = "status STRING, row_count BIGINT"
    if not store.state().rows:
        return store.spark.createDataFrame([], layout)
    counts = materialise(reconcile_status(store.read(), paths).groupBy("period", "status").agg(F.count("*").alias("row_count")))
    touched = [r["period"] for r in counts.where("status <> 'kept'").select("period").distinct().collect()]
    if touched:
        judged = reconcile_status(store.read(periods=touched), paths)
        store.rewrite(judged.where("status <> 'removed'").drop("status"), touched)
    return counts.groupBy("status").agg(F.sum("row_count").alias("row_count"))


def follow_moves(store: LedgerStore, moves: DataFrame) -> None:
    """Re-point the stored ledger's keys in `moves` (period, url, new_path); only their periods are written."""
    touched = [r["period"] for r in moves.select("period").distinct().collect()]
    if touched:
        store.rewrite(repoint(store.read(periods=touched), moves), touched)


def run_ledger(
    store: LedgerStore,
    links: DataFrame,
    observations: DataFrame,
    base_dir: str,
    source_id: str,
    batch: int,
    files: DataFrame | None = None,
    mode: str = SAFE,
) -> LedgerRun:
    """Plan and apply one batch of links, and append what is new.

    `links` is (period, url, filename), each key once. Links and the classified batch
    are stored once, since both are read more than once. Running a batch again
    replaces its rows.
    """
    links = materialise(links)
    known = store.latest(links, before=batch)
    planned = plan_changes(links, known, observations, mode, manifest_latest=True)
    if files is not None:
        planned = materialise(planned)
    applied = materialise(apply_changes(planned, base_dir, files, mode))
    store.append(new_rows(applied, base_dir, source_id, batch), batch)
    return LedgerRun(applied, run_summary(applied))


def unpack_archives(store: LedgerStore, archives: DataFrame, batch: int | None = None) -> DataFrame:
    """Members of `archives` (path, maybe content); the stored ledger points to their folders.

    With `batch` only archives are opened that this batch of the ledger brought in.
    """
    if batch is not None:
        brought = store.read().where((F.col("seq") == batch) & folder_of_archive(F.col("saved_path")).isNotNull())
        wanted = brought.select(normal_path(F.col("saved_path")).alias("path")).distinct()
        archives = archives.withColumn("path", normal_path(F.col("path"))).join(wanted, "path", "left_semi")
    members = materialise(expand_archives(archives))
    follow_moves(store, materialise(moves_of_archives(store.read(), members)))
    return members


def refile_combined(store: LedgerStore, inventory: DataFrame, base_dir: str, **options) -> DataFrame:
    """Move list of the combined release; the stored ledger follows it."""
    moves = materialise(reassign_periods(inventory, base_dir, **options))
    follow_moves(store, materialise(moves_for_ledger(store.read(), moves)))
    return moves


def run_release_ledger(
    store: LedgerStore,
    index_pages: DataFrame,
    release_pages: DataFrame,
    observations: DataFrame,
    index_url: str,
    site_root: str,
    base_dir: str,
    source_id: str,
    batch: int,
    paths: DataFrame,
    archives: DataFrame | None = None,
    combined: str | None = None,
    mode: str = SAFE,
    **options,
) -> ReleaseRun:
    """One run from the crawled pages to the ledger.

    Cleanup against `paths` (path, is_dir), discovery, links, plan, appending what is new,
    unpacking the `archives` that this batch brought in and following them, the summary,
    and re-filing of the `combined` release. A release whose page is missing or empty is
    reported in `failed` (period, url) and the others go on. The ledger changes in one commit at
    the end, so a run that fails leaves it as it was; running it again over the same pages and
    observations changes nothing.
    """
    with store.run():
        return _release_run(
            store, index_pages, release_pages, observations, index_url, site_root, base_dir, source_id, batch, paths, archives, combined, mode, options
        )


def _release_run(store, index_pages, release_pages, observations, index_url, site_root, base_dir, source_id, batch, paths, archives, combined, mode, options) -> ReleaseRun:
    cleaned = clean_ledger(store, paths)
    releases = discover_releases(index_pages, index_url)
    named = releases.select(F.col("year").cast("string").alias("period"), "url").distinct()
    fetched = release_pages.where("html IS NOT NULL AND html <> ''").select("url").distinct()
    failed = materialise(named.join(fetched, "url", "left_anti"))
    found = links_of_crawl(index_pages, release_pages, index_url, site_root, **options)
    found = found.groupBy("period", "url").agg(F.min("filename").alias("filename"))
    files = paths.where("NOT is_dir").select("path")
    done = run_ledger(store, found, observations, base_dir, source_id, batch, files, mode)
    members = unpack_archives(store, archives, batch) if archives is not None else None
    moves = refile_combined(store, paths, base_dir, combined=combined) if combined else None
    store.compact()
    return ReleaseRun(done.summary, cleaned, failed, members, moves)
