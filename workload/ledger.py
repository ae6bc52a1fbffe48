"""Ledger queries: `events` play the versions of files and later sightings of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.ledger import (
    apply_changes,
    fingerprint,
    fingerprint_wanted,
    latest_manifest,
    new_rows,
    plan_changes,
    register_existing,
    repoint,
    run_summary,
    to_fetch,
)
from tidemark.plans.ledger_run import follow_moves, links_of_crawl, run_ledger, run_release_ledger
from tidemark.session import materialise, shared_dir
from tidemark.sources.ledger_store import LedgerStore
from tidemark.sources.tables import read_text_manifest, write_text_manifest
from tidemark.sources.schemas import MANIFEST_TEXT, text_manifest, typed_manifest
from workload.data import table
from workload.links import ROWS_PER_PAGE, SITE, release_pages

BASE = "/data"
SOURCE = "yearbook"
# Sightings start here; earlier events are ledger rows.
SPLIT = "timestamp_ntz'2024-01-16'"
_URL = "concat('https://files.example.org/u', user_id, '.json')"
_ETAG = "md5(cast(user_id % 3 + event_id % 4 AS STRING))"
_CHANGED = "concat('day ', cast(floor(value) AS BIGINT) % 3)"


def manifest(spark, sf):
    """Ledger rows; the day is the version, so that versions tie and `seq` decides."""
    return (
        table(spark, sf, "events")
        .where(f"ts < {SPLIT}")
        .selectExpr(
            f"'{SOURCE}' AS source_id",
            "event_type AS period",
            f"{_URL} AS url",
            "concat('u', user_id, '.json') AS filename",
            f"concat('{BASE}/', event_type, '/u', user_id, '.json') AS saved_path",
            "cast(length(props) AS BIGINT) AS bytes",
            "sha2(props, 256) AS sha256",
            f"{_ETAG} AS etag",
            f"{_CHANGED} AS last_modified",
            "dayofmonth(ts) AS version",
            "cast(ts AS TIMESTAMP) AS downloaded_at",
            "event_id AS seq",
        )
    )


def observations(spark, sf):
    """Sightings with every kind of gap; some of users the ledger has never seen."""
    kind = "event_id % 10"
    return (
        table(spark, sf, "events")
        .where(f"ts >= {SPLIT}")
        .withColumn("user_id", F.expr("if(user_id % 10 = 0, user_id + 1000000, user_id)"))
        .selectExpr(
            "event_type AS period",
            f"{_URL} AS url",
            f"{kind} <> 0 AS head_ok",
            f"if({kind} = 1, '', {_ETAG}) AS etag",
            f"{_CHANGED} AS last_modified",
            f"if({kind} = 2, null, cast(length(props) AS BIGINT)) AS content_length",
            f"CASE {kind} WHEN 3 THEN 304 WHEN 4 THEN null ELSE 200 END AS cond_status",
            f"if({kind} = 6, 304, 200) AS get_status",
            f"if({kind} = 5, null, sha2(props, 256)) AS sha256",
            f"if({kind} = 5, null, cast(length(props) AS BIGINT)) AS bytes",
            "cast(ts AS TIMESTAMP) AS observed_at",
        )
    )


def links(spark, sf):
    return observations(spark, sf).selectExpr(
        "period", "url", "substring_index(url, '/', -1) AS filename"
    ).distinct()


def stored_files(spark, sf):
    """Files already on disk for some of the users the ledger has not seen."""
    return (
        table(spark, sf, "events")
        .where("user_id % 20 = 0")
        .groupBy("event_type", "user_id")
        .agg(F.min("props").alias("content"))
        .selectExpr(f"concat('{BASE}/', event_type, '/u', user_id + 1000000, '.json') AS path", "content")
    )


def planned(spark, sf, mode="safe"):
    return plan_changes(links(spark, sf), manifest(spark, sf), observations(spark, sf), mode)


def _decisions(mode):
    return lambda spark, sf: planned(spark, sf, mode).select("period", "url", "decision", "reason")


def applied(spark, sf):
    return apply_changes(materialise(planned(spark, sf)), BASE, stored_files(spark, sf))


def appended(spark, sf):
    return new_rows(applied(spark, sf), BASE, SOURCE).drop("downloaded_at", "seq")


def manifest_text(spark, sf):
    """Ledger lines as text, some with blank or broken numbers, typed and written back."""
    raw = manifest(spark, sf).selectExpr(
        *[c for c in MANIFEST_TEXT.names if c not in ("bytes", "version", "downloaded_at")],
        "CASE seq % 7 WHEN 0 THEN '' WHEN 1 THEN 'n/a' WHEN 2 THEN concat(' ', bytes) ELSE cast(bytes AS STRING) END AS bytes",
        "CASE seq % 5 WHEN 0 THEN '  ' WHEN 1 THEN 'v1' ELSE cast(version AS STRING) END AS version",
        "date_format(downloaded_at, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS downloaded_at",
        "seq",
    )
    typed = typed_manifest(raw)
    cells = text_manifest(typed)
    return cells.select("url", "bytes", "version", "downloaded_at").withColumn("source", F.lit("text")).unionByName(
        typed.where("problem is not null").select("url", F.lit("").alias("bytes"), F.col("problem").alias("version"), F.lit("").alias("downloaded_at"), F.lit("problem").alias("source"))
    )


def manifest_csv(spark, sf):
    """The safe plan, from a ledger written to CSV and read back; validators hold quotes, commas and line breaks."""

    def quoted(rows, column):
        return rows.withColumn(column, F.concat(F.lit('W/"a,\n'), column, F.lit('"')))

    folder = shared_dir(spark, "manifest")
    write_text_manifest(quoted(quoted(manifest(spark, sf), "etag"), "last_modified"), folder)
    known = typed_manifest(read_text_manifest(spark, folder)).drop("problem")
    sightings = observations(spark, sf)
    seen = quoted(quoted(sightings, "etag"), "last_modified").withColumn(
        "etag", F.when(F.col("etag") == 'W/"a,\n"', F.lit("")).otherwise(F.col("etag"))
    )
    return plan_changes(links(spark, sf), known, seen).select("period", "url", "decision", "reason")


def document_fingerprint(spark, sf):
    return fingerprint(table(spark, sf, "documents").select("doc_id", "text"), "text")


def wanted_fingerprints(spark, sf):
    """Only documents with a label have their text hashed."""
    return fingerprint_wanted(
        table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "labels"), ["doc_id"], "text"
    )


def register_existing_files(spark, sf):
    documents = table(spark, sf, "documents")
    found = documents.selectExpr(
        "lang AS period",
        "concat('https://docs.example.org/', source, '/', doc_id, '.TXT') AS url",
        "concat(doc_id, '.txt') AS filename",
    )
    # Links of parts, whose files are not there.
    found = found.unionByName(
        table(spark, sf, "part").selectExpr("'en' AS period", "concat('https://docs.example.org/absent/', p_partkey) AS url", "concat('absent-', p_partkey, '.txt') AS filename")
    )
    files = documents.select(
        F.format_string(f"{BASE}/%s/%d.txt", "lang", "doc_id").alias("path"), F.col("text").alias("content")
    )
    known = documents.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").selectExpr(
        "lang AS period", "concat('https://docs.example.org/', source, '/', doc_id, '.TXT') AS url"
    )
    return register_existing(found, known, files, BASE, SOURCE).select(
        "period", "url", "filename", "saved_path", "bytes", "sha256", "version"
    )


def _moves(spark, sf):
    return table(spark, sf, "customer").selectExpr(
        "'click' AS period",
        "concat('https://files.example.org/u', c_custkey, '.json') AS url",
        "concat('/archive/', c_nationkey, '/c', c_custkey) AS new_path",
    )


def _repointed(latest_only):
    def query(spark, sf):
        followed = repoint(manifest(spark, sf), _moves(spark, sf), latest_only)
        return followed.select("seq", "period", "url", "saved_path", "filename")

    return query


def ledger_store(spark, sf):
    """The ledger appended in two batches, one of them twice, then rewritten."""
    store = LedgerStore(spark, shared_dir(spark, "ledger"))
    rows = manifest(spark, sf)
    store.append(rows.where("seq % 2 = 0"), 0)
    store.append(rows.where("seq % 2 = 1"), 1)
    store.append(rows.where("seq % 2 = 1"), 1)
    store.replace(store.read().where("version > 3"))
    # Batch 1 once more, as after a restart: its rows in the rewritten ledger give way.
    store.append(rows.where("seq % 2 = 1 AND version > 3"), 1)
    store.append(rows.where("version <= 3"), 2)
    return store.read().select("seq", "period", "url", "version", "sha256", "bytes")


def manifest_shuffled(spark, sf):
    """The safe plan from a ledger in CSV files whose columns are in another order, beside others, or missing."""
    folder = shared_dir(spark, "manifest")
    cells = text_manifest(manifest(spark, sf)).withColumn("NOTE", F.lit('not "this", one'))
    orders = {"a": sorted([*MANIFEST_TEXT.names, "NOTE"], reverse=True), "b": [c for c in MANIFEST_TEXT.names if c not in ("filename", "saved_path")]}
    for name, columns in orders.items():
        part = cells.where(F.pmod(F.hash("period"), F.lit(2)) == int(name == "b"))
        # In order of the ledger, which decides between equal versions.
        ordered = part.repartitionByRange("downloaded_at").sortWithinPartitions("downloaded_at")
        ordered.select(*columns).write.options(header=True, quote='"', escape='"', emptyValue="").csv(f"{folder}/{name}")
    known = typed_manifest(read_text_manifest(spark, f"{folder}/*")).drop("problem")
    return plan_changes(links(spark, sf), known, observations(spark, sf)).select("period", "url", "decision")


def ledger_index(spark, sf):
    """Latest rows by the store's index after batches, a batch applied again, and a rewritten period."""
    store = LedgerStore(spark, shared_dir(spark, "ledger"))
    rows = manifest(spark, sf)
    # A batch for each third of the versions; the second one brings too much at first.
    for batch in range(3):
        store.append(rows.where(f"version % 3 = {batch}" + (" OR version = 15" if batch == 1 else "")), batch)
    store.append(rows.where("version % 3 = 1"), 1)
    store.rewrite(store.read(periods=["click"]).where("version <> 14"), ["click"])
    return store.latest().select("period", "url", "version", "seq")


def _one_period(spark, sf):
    """A ledger of a period per month, in which the moves of one month's keys are followed."""
    store = LedgerStore(spark, shared_dir(spark, "ledger"))
    rows = table(spark, sf, "orders").selectExpr(
        f"'{SOURCE}' AS source_id", "date_format(o_orderdate, 'yyyy-MM') AS period", "concat('https://files.example.org/o', o_orderkey) AS url",
        "concat(o_orderkey, '.pdf') AS filename", f"concat('{BASE}/', date_format(o_orderdate, 'yyyy-MM'), '/', o_orderkey, '.pdf') AS saved_path",
        "cast(o_custkey AS BIGINT) AS bytes", "md5(cast(o_orderkey AS STRING)) AS sha256", "cast(null AS STRING) AS etag", "cast(null AS STRING) AS last_modified",
        "1 AS version", "cast(o_orderdate AS TIMESTAMP) AS downloaded_at", "cast(0 AS BIGINT) AS seq",
    )
    store.append(rows, 0)
    before = store.state()
    moves = rows.where("period = '1997-05' AND bytes % 2 = 0").selectExpr("period", "url", "concat('/moved/', filename) AS new_path")
    follow_moves(store, materialise(moves))
    return store, before


def repointed_store(spark, sf):
    return _one_period(spark, sf)[0].read().select("period", "url", "saved_path")


def repointed_folders(spark, sf):
    """Per period, whether its folders are those from before the moves."""
    store, before = _one_period(spark, sf)
    old = {(p.period, p.folder) for p in before.rows}
    return spark.createDataFrame([(p.period, (p.period, p.folder) in old) for p in store.state().rows], "period STRING, untouched BOOLEAN")


# --- a whole run -----------------------------------------------------------------

# Release pages share a few years; an index page names every year once.
_YEARS = 20
_PAGE_URL = f"concat('{SITE}/topics/', page_id, '/yearbook/', 1900 + page_id % {_YEARS})"


def crawl(spark, sf):
    """Index pages, each naming a release of every year, and the release pages."""
    pages = release_pages(spark, sf).selectExpr("page_id", f"{_PAGE_URL} AS url", "html")
    index = (
        table(spark, sf, "part")
        .select(F.floor(F.col("p_partkey") / ROWS_PER_PAGE).alias("page_id"))
        .distinct()
        .selectExpr(f"cast(floor(page_id / {_YEARS}) AS BIGINT) AS index_id", f"{_PAGE_URL} AS url")
        .groupBy("index_id")
        .agg(F.array_join(F.collect_set(F.concat(F.lit('<a href="'), "url", F.lit('">open</a>'))), " ").alias("html"))
        .withColumnRenamed("index_id", "page_id")
    )
    return index, pages


def crawl_links(spark, sf):
    index, pages = crawl(spark, sf)
    found = links_of_crawl(index, pages, f"{SITE}/topics/yearbook", SITE)
    return found.select("period", "url", "filename")


def _sightings(found, run: int):
    """What each run sees: in the second one every fourth file has new content."""
    number = "cast(regexp_extract(url, '/([0-9]+)[.]', 1) AS BIGINT)"
    content = f"concat('file ', {number}, if({run} = 1 AND {number} % 4 = 0, ' new', ''))"
    return found.selectExpr(
        "period", "url", f"{number} % 9 <> 8 AS head_ok",
        f"md5({content}) AS etag", "cast(null AS STRING) AS last_modified", f"cast(length({content}) AS BIGINT) AS content_length",
        "200 AS cond_status", "200 AS get_status", f"if({number} % 50 = 7 AND {run} = 0, null, sha2({content}, 256)) AS sha256",
        f"cast(length({content}) AS BIGINT) AS bytes", f"timestamp'2024-0{run + 1}-01 00:00:00' AS observed_at",
    )


def _two_runs(spark, sf):
    store = LedgerStore(spark, shared_dir(spark, "ledger"))
    found = materialise(crawl_links(spark, sf))
    return store, [run_ledger(store, found, _sightings(found, r), BASE, SOURCE, r) for r in (0, 1)]


def incremental_ledger(spark, sf):
    store, _ = _two_runs(spark, sf)
    return store.read().select("period", "url", "version", "filename", "saved_path", "sha256", "seq")


def incremental_summary(spark, sf):
    _, runs = _two_runs(spark, sf)
    return runs[0].summary.withColumn("run", F.lit(0)).unionByName(runs[1].summary.withColumn("run", F.lit(1)))


def release_run(spark, sf):
    """Two whole runs over the same crawl and files; every seventh page was not fetched.

    The second run finds nothing new. What is given are both runs' counters, the ledger's
    rows after each, and the releases that failed.
    """
    index, pages = crawl(spark, sf)
    pages = pages.withColumn("html", F.when(F.col("page_id") % 7 != 3, F.col("html")))
    store = LedgerStore(spark, shared_dir(spark, "ledger"))
    sightings = materialise(_sightings(crawl_links(spark, sf), 0))
    out = None
    for run in (0, 1):
        there = materialise(store.read().select(F.col("saved_path").alias("path"), F.lit(False).alias("is_dir")))
        done = run_release_ledger(store, index, pages, sightings, f"{SITE}/topics/yearbook", SITE, BASE, SOURCE, run, there)
        counted = done.summary.select(F.lit(run).alias("run"), "*").crossJoin(store.read().agg(F.count("*").alias("row_count")))
        counted = counted.crossJoin(done.failed.agg(F.count("*").alias("failed")))
        out = materialise(counted) if out is None else out.unionByName(materialise(counted))
    return out


QUERIES = {
    "manifest_latest": lambda spark, sf: latest_manifest(manifest(spark, sf)).select("period", "url", "version", "seq", "etag"),
    "plan_fast": _decisions("fast"),
    "plan_safe": _decisions("safe"),
    "links_to_fetch": lambda spark, sf: to_fetch(planned(spark, sf)).select("period", "url"),
    "apply_outcomes": lambda spark, sf: applied(spark, sf).select("period", "url", "outcome"),
    "next_version_rows": appended,
    "run_summary": lambda spark, sf: run_summary(applied(spark, sf)),
    "manifest_text": manifest_text,
    "manifest_csv": manifest_csv,
    "document_fingerprint": document_fingerprint,
    "wanted_fingerprints": wanted_fingerprints,
    "register_existing": register_existing_files,
    "repoint_paths": _repointed(False),
    "repoint_latest": _repointed(True),
    "manifest_shuffled": manifest_shuffled,
    "ledger_store": ledger_store,
    "ledger_index": ledger_index,
    "repointed_store": repointed_store,
    "repointed_folders": repointed_folders,
    "crawl_links": crawl_links,
    "incremental_ledger": incremental_ledger,
    "incremental_summary": incremental_summary,
    "release_run": release_run,
}

_LEDGER = f"""
    ledger AS (
        SELECT event_type AS period, 'https://files.example.org/u' || user_id || '.json' AS url,
               'u' || user_id || '.json' AS filename, '/data/' || event_type || '/u' || user_id || '.json' AS saved_path,
               length(props) AS bytes, sha256(props) AS sha256, md5(CAST(user_id % 3 + event_id % 4 AS VARCHAR)) AS etag,
               'day ' || (CAST(floor(value) AS BIGINT) % 3) AS last_modified, CAST(day(ts) AS INTEGER) AS version,
               ts AS downloaded_at, event_id AS seq
        FROM events WHERE ts < TIMESTAMP '2024-01-16'),
    latest AS (
        SELECT * FROM ledger
        QUALIFY row_number() OVER (PARTITION BY period, url ORDER BY version DESC, seq DESC) = 1)"""
_SEEN = """
    seen AS (
        SELECT event_type AS period, event_id % 10 AS kind, props, value,
               CASE WHEN user_id % 10 = 0 THEN user_id + 1000000 ELSE user_id END AS uid,
               'https://files.example.org/u' || uid || '.json' AS url, 'u' || uid || '.json' AS filename,
               CASE WHEN kind = 1 THEN NULL ELSE md5(CAST(uid % 3 + event_id % 4 AS VARCHAR)) END AS etag,
               'day ' || (CAST(floor(value) AS BIGINT) % 3) AS last_modified,
               CASE WHEN kind = 2 THEN NULL ELSE length(props) END AS size,
               CASE WHEN kind = 5 THEN NULL ELSE sha256(props) END AS sha256, ts
        FROM events WHERE ts >= TIMESTAMP '2024-01-16'
        QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC) = 1)"""
_PLAN = f"""{_LEDGER}, {_SEEN},
    plan AS (
        SELECT s.*, l.version AS old_version, l.sha256 AS old_sha256,
               CASE WHEN l.url IS NULL THEN 'unseen'
                    WHEN s.kind = 0 THEN 'head-failed'
                    WHEN s.etag = l.etag THEN 'etag-match'
                    WHEN s.last_modified = l.last_modified AND (s.size IS NULL OR s.size = l.bytes) THEN 'last-modified-match'
                    WHEN s.kind = 3 THEN 'not-modified'
                    WHEN s.kind = 4 THEN 'head-failed'
                    ELSE 'content-may-differ' END AS reason,
               CASE WHEN reason = 'unseen' THEN 'download'
                    WHEN reason IN ('etag-match', 'last-modified-match', 'not-modified') THEN 'skip'
                    ELSE 'version' END AS decision
        FROM seen s LEFT JOIN latest l USING (period, url))"""
_APPLY = f"""{_PLAN},
    disk AS (
        SELECT event_type AS period, 'https://files.example.org/u' || (user_id + 1000000) || '.json' AS url, min(props) AS content
        FROM events WHERE user_id % 20 = 0 GROUP BY ALL),
    done AS (
        SELECT p.*, d.content,
               CASE WHEN decision = 'skip' THEN 'skipped'
                    WHEN decision = 'download' AND d.content IS NOT NULL THEN 'registered'
                    WHEN kind = 6 THEN 'unchanged'
                    WHEN sha256 IS NULL THEN 'errors'
                    WHEN sha256 = old_sha256 THEN 'unchanged'
                    WHEN decision = 'version' THEN 'versioned'
                    ELSE 'downloaded' END AS outcome
        FROM plan p LEFT JOIN disk d USING (period, url))"""
_REPOINT = f"""WITH {_LEDGER}
    SELECT l.seq, l.period, l.url,
           CASE WHEN moved THEN '/archive/' || c_nationkey || '/c' || c_custkey ELSE l.saved_path END AS saved_path,
           CASE WHEN moved THEN 'c' || c_custkey ELSE l.filename END AS filename
    FROM (SELECT l.*, c.*, c_custkey IS NOT NULL AND {{only}} AS moved
          FROM ledger l LEFT JOIN customer c
            ON l.period = 'click' AND l.url = 'https://files.example.org/u' || c_custkey || '.json') l"""
_CRAWLED = """
    found AS (
        SELECT CAST(1900 + (p_partkey // 100) % 20 AS VARCHAR) AS period, p_partkey,
               'https://stats.example.org/files/' || p_partkey
                   || (['.pdf', '.xlsx', '.xls', '.ZIP', '.html', '.pdf?x=1&y=2'])[p_partkey % 6 + 1] AS url,
               p_partkey || (['.pdf', '.xlsx', '.xls', '.zip', '.html', '.pdf'])[p_partkey % 6 + 1] AS filename
        FROM part WHERE p_partkey % 6 <> 4),
    -- Run 0 cannot fetch a few files; run 1 sees new content for every fourth one.
    versions AS (
        SELECT *, 1 AS version, CASE WHEN p_partkey % 50 = 7 THEN 1 ELSE 0 END AS seq,
               'file ' || p_partkey || CASE WHEN seq = 1 AND p_partkey % 4 = 0 THEN ' new' ELSE '' END AS content
        FROM found
        UNION ALL
        SELECT *, 2, 1, 'file ' || p_partkey || ' new' FROM found WHERE p_partkey % 4 = 0 AND p_partkey % 50 <> 7)"""

ORACLE = {
    "manifest_latest": f"WITH {_LEDGER} SELECT period, url, version, seq, etag FROM latest",
    "plan_fast": f"""WITH {_PLAN}
        SELECT period, url, CASE WHEN reason = 'unseen' THEN 'download' ELSE 'skip' END AS decision,
               CASE WHEN reason = 'unseen' THEN 'unseen' ELSE 'seen-fast' END AS reason FROM plan""",
    "plan_safe": f"WITH {_PLAN} SELECT period, url, decision, reason FROM plan",
    "manifest_csv": f"WITH {_PLAN} SELECT period, url, decision, reason FROM plan",
    "manifest_shuffled": f"WITH {_PLAN} SELECT period, url, decision FROM plan",
    "ledger_index": f"""WITH {_LEDGER}
        SELECT period, url, version, CAST(version % 3 AS BIGINT) AS seq FROM ledger WHERE period <> 'click' OR version <> 14
        QUALIFY row_number() OVER (PARTITION BY period, url ORDER BY version DESC) = 1""",
    "repointed_store": """
        SELECT strftime(o_orderdate, '%Y-%m') AS period, 'https://files.example.org/o' || o_orderkey AS url,
               CASE WHEN period = '1997-05' AND o_custkey % 2 = 0 THEN '/moved/' ELSE '/data/' || period || '/' END || o_orderkey || '.pdf' AS saved_path
        FROM orders""",
    "repointed_folders": """
        SELECT strftime(o_orderdate, '%Y-%m') AS period, NOT bool_or(period = '1997-05' AND o_custkey % 2 = 0) AS untouched FROM orders GROUP BY 1""",
    "links_to_fetch": f"WITH {_PLAN} SELECT period, url FROM plan WHERE decision <> 'skip'",
    "apply_outcomes": f"WITH {_APPLY} SELECT period, url, outcome FROM done",
    "next_version_rows": f"""WITH {_APPLY}
        SELECT 'yearbook' AS source_id, period, url,
               CASE WHEN outcome = 'versioned' THEN 'u' || uid || '.v' || (old_version + 1) || '.json' ELSE filename END AS filename,
               '/data/' || period || '/'
                   || CASE WHEN outcome = 'versioned' THEN 'u' || uid || '.v' || (old_version + 1) || '.json' ELSE done.filename END
                   AS saved_path,
               length(CASE WHEN outcome = 'registered' THEN content ELSE props END) AS bytes,
               sha256(CASE WHEN outcome = 'registered' THEN content ELSE props END) AS sha256,
               CASE WHEN outcome <> 'registered' THEN etag END AS etag,
               CASE WHEN outcome <> 'registered' THEN last_modified END AS last_modified,
               CASE WHEN outcome = 'versioned' THEN old_version + 1 ELSE 1 END AS version
        FROM done WHERE outcome IN ('registered', 'downloaded', 'versioned')""",
    "run_summary": f"""WITH {_APPLY}
        SELECT count(*) FILTER (outcome IN ('downloaded', 'registered')) AS downloaded,
               count(*) FILTER (outcome = 'versioned') AS new_versions, count(*) FILTER (outcome = 'skipped') AS skipped,
               count(*) FILTER (outcome = 'unchanged') AS unchanged, count(*) FILTER (outcome = 'errors') AS errors
        FROM done""",
    "manifest_text": f"""WITH {_LEDGER}
        SELECT url, CASE WHEN seq % 7 IN (0, 1) THEN '' ELSE CAST(bytes AS VARCHAR) END AS bytes,
               CASE seq % 5 WHEN 0 THEN '1' WHEN 1 THEN '' ELSE CAST(version AS VARCHAR) END AS version,
               strftime(downloaded_at, '%Y-%m-%dT%H:%M:%SZ') AS downloaded_at, 'text' AS source FROM ledger
        UNION ALL
        SELECT url, '', CASE WHEN seq % 5 = 1 THEN 'version' ELSE 'bytes' END, '', 'problem'
        FROM ledger WHERE seq % 5 = 1 OR seq % 7 = 1""",
    "document_fingerprint": """
        SELECT doc_id, sha256(text) AS sha256, octet_length(encode(text)) AS bytes FROM documents""",
    "wanted_fingerprints": """
        SELECT doc_id, sha256(text) AS sha256, octet_length(encode(text)) AS bytes FROM documents
        WHERE doc_id IN (SELECT doc_id FROM labels)""",
    "register_existing": """
        SELECT lang AS period, 'https://docs.example.org/' || source || '/' || doc_id || '.TXT' AS url,
               doc_id || '.txt' AS filename, '/data/' || lang || '/' || doc_id || '.txt' AS saved_path,
               octet_length(encode(text)) AS bytes, sha256(text) AS sha256, 1 AS version
        FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
    "repoint_paths": _REPOINT.format(only="true"),
    "repoint_latest": _REPOINT.format(
        only="row_number() OVER (PARTITION BY l.period, l.url ORDER BY l.version DESC, l.seq DESC) = 1"
    ),
    "ledger_store": f"""WITH {_LEDGER}
        SELECT CASE WHEN version <= 3 THEN 2 ELSE seq % 2 END AS seq, period, url, version, sha256, bytes FROM ledger""",
    "crawl_links": f"WITH {_CRAWLED} SELECT period, url, filename FROM found",
    "incremental_ledger": f"""WITH {_CRAWLED}
        SELECT period, url, version, CASE WHEN version = 1 THEN name ELSE regexp_replace(name, '[.]', '.v2.') END AS filename,
               '/data/' || period || '/' || CASE WHEN version = 1 THEN name ELSE regexp_replace(name, '[.]', '.v2.') END AS saved_path,
               sha256(content) AS sha256, seq
        FROM (SELECT *, split_part(split_part(url, '?', 1), '/', -1) AS name FROM versions)""",
    "release_run": f"""WITH {_CRAWLED},
        fetched AS (SELECT * FROM found WHERE (p_partkey // 100) % 7 <> 3),
        lost AS (SELECT count(DISTINCT p_partkey // 100) AS failed FROM part WHERE (p_partkey // 100) % 7 = 3),
        kept AS (SELECT count(*) FILTER (p_partkey % 50 <> 7) AS good, count(*) FILTER (p_partkey % 50 = 7) AS bad,
                 count(*) FILTER (p_partkey % 50 <> 7 AND p_partkey % 9 = 8) AS unseen FROM fetched)
        SELECT 0 AS run, good AS downloaded, 0 AS new_versions, 0 AS skipped, 0 AS unchanged, bad AS errors, good AS row_count, failed
        FROM kept, lost
        UNION ALL SELECT 1, 0, 0, good - unseen, unseen, bad, good, failed FROM kept, lost""",
    "incremental_summary": f"""WITH {_CRAWLED}
        SELECT 0 AS run, count(*) FILTER (p_partkey % 50 <> 7) AS downloaded, 0 AS new_versions, 0 AS skipped, 0 AS unchanged,
               count(*) FILTER (p_partkey % 50 = 7) AS errors FROM found
        UNION ALL
        SELECT 1, count(*) FILTER (late), count(*) FILTER (NOT late AND p_partkey % 4 = 0),
               count(*) FILTER (NOT late AND p_partkey % 4 <> 0 AND p_partkey % 9 <> 8),
               count(*) FILTER (NOT late AND p_partkey % 4 <> 0 AND p_partkey % 9 = 8), 0
        FROM (SELECT *, p_partkey % 50 = 7 AS late FROM found)""",
}
