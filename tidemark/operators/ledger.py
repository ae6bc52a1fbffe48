"""The versioned ledger of files: latest versions, change decisions, new rows.

A key is (period, url). Whatever is joined here is first reduced to one row per key
with map-side combining, so a key with very many versions or sightings is small
before it travels. Links, latest versions and observations share one hash
partitioning by key, so that planning a run shuffles each of them once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.names import base_name, stored_name, versioned_name
from tidemark.functions.text import blank_to_null, strip, to_long
from tidemark.operators.skew import hot_keys, skew_join
from tidemark.session import BROADCAST_ROWS, fits
from tidemark.sources.binary import hash_files, normal_path
from tidemark.sources.schemas import KEY

SAFE, FAST = "safe", "fast"
# Periods that are written into a plan as a partition filter.
MOST_PERIODS = 1000


def _version(version: Column) -> Column:
    """Version number; blank counts as 1, what is no number as null."""
    text = strip(F.coalesce(version.cast("string"), F.lit("")))
    return F.when(text == "", F.lit(1)).otherwise(text.try_cast("int"))


def _text(value: Column) -> Column:
    return blank_to_null(value)


def of_keys(manifest: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows of the keys in `keys` (period, url), which is read more than once."""
    periods = keys.select("period").distinct()
    # One period per release of a run; beyond the limit only the join prunes.
    named = [r["period"] for r in periods.limit(MOST_PERIODS + 1).collect()]
    if len(named) <= MOST_PERIODS:
        manifest = manifest.where(F.col("period").isin([p for p in named if p is not None]))
    keys = keys.select(KEY)
    return manifest.join(F.broadcast(keys) if fits(keys, BROADCAST_ROWS) else keys, KEY, "left_semi")


def latest_manifest(manifest: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Latest row per key: the highest version, of equal ones the later row (`seq`).

    With `keys` (period, url) only those keys are looked at. Their periods prune the
    ledger's folders, and the keys filter its rows: broadcast if they were counted and are
    few, otherwise by a semi-join that shares its shuffle with what follows.
    """
    if keys is not None:
        manifest = of_keys(manifest, keys)
    order = F.struct(F.coalesce(_version(F.col("version")), F.lit(-1)), F.col("seq"))
    rest = [c for c in manifest.columns if c not in KEY]
    return (
        manifest.groupBy(*KEY)
        .agg(F.max_by(F.struct(*rest), order).alias("_row"))
        .select(*KEY, *[F.col("_row")[c].alias(c) for c in rest])
    )


def latest_observation(observations: DataFrame) -> DataFrame:
    """One observation per key, the last one made."""
    rest = ["observed_at", *[c for c in observations.columns if c not in (*KEY, "observed_at")]]
    return (
        observations.groupBy(*KEY)
        .agg(F.max(F.struct(*rest)).alias("_row"))
        .select(*KEY, *[F.col("_row")[c].alias(c) for c in rest])
    )


def plan_changes(
    links: DataFrame,
    manifest: DataFrame,
    observations: DataFrame,
    mode: str = SAFE,
    links_stored: bool = False,
    manifest_latest: bool = False,
) -> DataFrame:
    """Decide for every link whether to skip it, fetch it, or fetch a new version.

    `links` holds each key once; say `links_stored` if they are a written table, so
    that counting them is cheap and a short list can prune the manifest, and
    `manifest_latest` if the manifest holds each key once, as a store's index does. Adds
    ``decision`` and ``reason``, and keeps what later steps compare with: ``prev_*`` of
    the latest ledger row, ``obs_*`` of the sighting. A key whose stored size is no
    number is decided ``error`` in safe mode.
    """
    mode = mode.lower().strip()
    if mode not in (SAFE, FAST):
        raise ValueError(f"mode is {SAFE!r} or {FAST!r}")
    compared = ("bytes", "sha256", "etag", "last_modified", "version")
    rows = manifest.select(*KEY, *compared, "seq")
    prev = (rows if manifest_latest else latest_manifest(rows, links if links_stored else None)).select(
        *KEY, F.lit(True).alias("_seen"), *[F.col(c).alias(f"prev_{c}") for c in compared]
    )
    seen_now = latest_observation(observations)
    obs = seen_now.select(*KEY, *[F.col(c).alias(f"obs_{c}") for c in seen_now.columns if c not in KEY])
    joined = links.join(prev, KEY, "left").join(obs, KEY, "left").withColumn("seen", F.coalesce("_seen", F.lit(False)))

    size_text = _text(strip(F.col("prev_bytes").cast("string")))
    size_before = F.nullif(to_long(size_text), F.lit(0))
    size_now = to_long(F.col("obs_content_length"))
    etag_before, etag_now = _text(F.col("prev_etag")), _text(F.col("obs_etag"))
    changed_before, changed_now = _text(F.col("prev_last_modified")), _text(F.col("obs_last_modified"))

    def answer(decision: str, reason: str) -> Column:
        return F.struct(F.lit(decision).alias("decision"), F.lit(reason).alias("reason"))

    same_time = (changed_before == changed_now) & (size_before.eqNullSafe(size_now) | size_now.isNull())
    verdict = F.when(~F.col("seen"), answer("download", "unseen"))
    if mode == FAST:
        verdict = verdict.otherwise(answer("skip", "seen-fast"))
    else:
        verdict = (
            verdict.when(size_text.isNotNull() & to_long(size_text).isNull(), answer("error", "bad-size"))
            .when(~F.coalesce("obs_head_ok", F.lit(False)), answer("version", "head-failed"))
            .when(etag_before == etag_now, answer("skip", "etag-match"))
            .when(same_time, answer("skip", "last-modified-match"))
            .when(F.col("obs_cond_status") == 304, answer("skip", "not-modified"))
            .when(F.col("obs_cond_status").isNull(), answer("version", "head-failed"))
            .otherwise(answer("version", "content-may-differ"))
        )
    return joined.withColumn("_verdict", verdict).select("*", "_verdict.*").drop("_verdict", "_seen")


def to_fetch(planned: DataFrame) -> DataFrame:
    """Links that are not skipped, before any content is read."""
    return planned.where("decision <> 'skip'")


def fingerprint(files: DataFrame, content: str = "content") -> DataFrame:
    """Replace the content column by its SHA-256 and its length in bytes.

    Narrow, and done where the content is read: joins move the digest, never the bytes.
    """
    raw = F.col(content).cast("binary")
    rest = [c for c in files.columns if c != content]
    return files.select(*rest, F.sha2(raw, 256).alias("sha256"), F.octet_length(raw).cast("long").alias("bytes"))


def fingerprint_wanted(files: DataFrame, wanted: DataFrame, on, content: str = "content") -> DataFrame:
    """Fingerprints of the files whose key is in `wanted`.

    A counted, small list filters the files before their bytes are hashed; a long one
    is joined to the digests afterwards.
    """
    keys = wanted.select(*on)
    if fits(keys):
        return fingerprint(files.join(F.broadcast(keys), list(on), "left_semi"), content)
    return fingerprint(files, content).join(keys.distinct(), list(on), "left_semi")


def expected_path(base_dir: str) -> Column:
    return normal_path(F.concat_ws("/", F.lit(base_dir), "period", "filename"))


def _digests(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Digests of the `files` whose path is in `wanted` (path): path, file_sha256, file_bytes, file_there.

    Files without content are joined first, and only what is left is opened and hashed.
    """
    files = files.withColumn("path", normal_path(F.col("path")))
    if "sha256" in files.columns:
        digests = files
    elif "content" in files.columns:
        digests = fingerprint_wanted(files, wanted, ["path"])
    else:
        digests = hash_files(files.select("path").join(wanted.distinct(), "path", "left_semi"))
    return digests.select(
        "path", F.col("sha256").alias("file_sha256"), F.col("bytes").alias("file_bytes"), F.lit(True).alias("file_there")
    )


def apply_changes(planned: DataFrame, base_dir: str, files: DataFrame | None = None, mode: str = SAFE) -> DataFrame:
    """Classify every planned link; adds ``outcome`` and the row it would append.

    Outcomes: skipped, registered (unseen, but its file already lies at the expected
    path in `files`), unchanged (not modified, or the same content as the latest
    version), versioned, downloaded, errors (nothing could be fetched). With `files`,
    `planned` is read twice and should be a stored table.
    """
    unseen = F.col("decision") == "download"
    probed = planned.withColumn("path", F.when(unseen, expected_path(base_dir)))
    if files is not None:
        probed = skew_join(probed, _digests(files, probed.where("path IS NOT NULL").select("path")), ["path"], "left")
    else:
        probed = probed.withColumns(
            {"file_sha256": F.lit(None).cast("string"), "file_bytes": F.lit(None).cast("long"), "file_there": F.lit(False)}
        )
    same_content = F.lit(mode == SAFE) & F.col("seen") & (_text(F.col("prev_sha256")) == F.col("obs_sha256"))
    outcome = (
        F.when(F.col("decision") == "skip", "skipped")
        .when(F.col("decision") == "error", "errors")
        .when(unseen & F.coalesce("file_there", F.lit(False)), "registered")
        .when(F.col("obs_get_status") == 304, "unchanged")
        .when(F.col("obs_sha256").isNull(), "errors")
        .when(same_content, "unchanged")
        .when(F.col("decision") == "version", "versioned")
        .otherwise("downloaded")
    )
    return probed.withColumn("outcome", outcome)


def next_version(previous: Column) -> Column:
    """Version after `previous`; what is no number is followed by 2."""
    return F.coalesce(_version(previous), F.lit(1)) + 1


def new_rows(applied: DataFrame, base_dir: str, source_id: str, seq: Column | int = 0) -> DataFrame:
    """Ledger rows to append: one per downloaded, versioned or registered link."""
    outcome = F.col("outcome")
    registered, versioned = outcome == "registered", outcome == "versioned"
    plain = stored_name(F.col("url"), F.col("period"))
    version = F.when(versioned, next_version(F.col("prev_version"))).otherwise(F.lit(1)).cast("int")
    name = (
        F.when(registered, F.col("filename"))
        .when(versioned, versioned_name(plain, version))
        .otherwise(plain)
    )
    fetched = outcome.isin("downloaded", "versioned")
    return applied.where(outcome.isin("downloaded", "versioned", "registered")).select(
        F.lit(source_id).alias("source_id"),
        *KEY,
        name.alias("filename"),
        normal_path(F.concat_ws("/", F.lit(base_dir), "period", name)).alias("saved_path"),
        F.when(registered, F.col("file_bytes")).otherwise(F.col("obs_bytes")).cast("long").alias("bytes"),
        F.when(registered, F.col("file_sha256")).otherwise(F.col("obs_sha256")).alias("sha256"),
        F.when(fetched, _text(F.col("obs_etag"))).alias("etag"),
        F.when(fetched, _text(F.col("obs_last_modified"))).alias("last_modified"),
        version.alias("version"),
        F.coalesce("obs_observed_at", F.current_timestamp()).cast("timestamp").alias("downloaded_at"),
        (F.lit(seq) if isinstance(seq, int) else seq).cast("long").alias("seq"),
    )


def run_summary(applied: DataFrame) -> DataFrame:
    """One row of run counters; registered files count as downloaded."""

    def count(*outcomes: str) -> Column:
        return F.count_if(F.col("outcome").isin(*outcomes))

    return applied.agg(
        count("downloaded", "registered").alias("downloaded"),
        count("versioned").alias("new_versions"),
        count("skipped").alias("skipped"),
        count("unchanged").alias("unchanged"),
        count("errors").alias("errors"),
    )


def register_existing(
    links: DataFrame, manifest: DataFrame, files: DataFrame, base_dir: str, source_id: str, seq: int = 0
) -> DataFrame:
    """Ledger rows of files that lie at a link's expected path but were never recorded.

    `links` is (period, url, filename), each key once; `files` is a listing (path),
    (path, content) or (path, sha256, bytes). A key the ledger knows is left alone.
    """
    known = manifest.select(*KEY).distinct()
    probed = links.withColumn("path", expected_path(base_dir))
    unknown = probed.join(known, KEY, "left_anti")
    # Looked for among all links, so that the anti-join runs once.
    found = skew_join(unknown, _digests(files, unknown.select("path")), ["path"], "inner", hot=hot_keys(probed, ["path"]))
    return found.select(
        F.lit(source_id).alias("source_id"),
        *KEY,
        base_name(F.col("path")).alias("filename"),
        F.col("path").alias("saved_path"),
        F.col("file_bytes").alias("bytes"),
        F.col("file_sha256").alias("sha256"),
        F.lit(None).cast("string").alias("etag"),
        F.lit(None).cast("string").alias("last_modified"),
        F.lit(1).alias("version"),
        F.current_timestamp().alias("downloaded_at"),
        F.lit(seq).cast("long").alias("seq"),
    )


def repoint(manifest: DataFrame, moves: DataFrame, latest_only: bool = False) -> DataFrame:
    """Ledger with new paths for the keys in `moves` (period, url, new_path).

    Every version of a key follows, or only its latest row with `latest_only`. Keys
    the ledger lacks change nothing. Of several moves of a key the greatest path counts.
    """
    moved = moves.groupBy(*KEY).agg(F.max("new_path").alias("_path"))
    on = KEY
    if latest_only:
        on = [*KEY, "version", "seq"]
        moved = latest_manifest(manifest).select(on).join(moved, KEY)
    followed = skew_join(manifest, moved, on, "left")
    return followed.select(
        *[
            F.coalesce("_path", "saved_path").alias(c) if c == "saved_path"
            else F.coalesce(base_name(F.col("_path")), "filename").alias(c) if c == "filename"
            else F.col(c)
            for c in manifest.columns
        ]
    )
