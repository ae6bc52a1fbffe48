"""Streaming queries over `events`, run until all available input is read."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.inventory import reconcile
from tidemark.plans.ledger_run import run_ledger
from tidemark.session import shared_dir
from tidemark.sources.ledger_store import LedgerStore
from tidemark.streaming.incremental import (
    first_seen,
    observation_stream,
    read_running_latest,
    run_incremental,
    write_first_seen,
    write_running_latest,
)
from workload.data import table

RUNS = 3


# Files the events arrive in, and how many of them make a micro-batch.
FILES, PER_BATCH = 6, 2


def _event_stream(spark, sf):
    """`events` as files that arrive in a folder of their own, read in several micro-batches."""
    events, folder = table(spark, sf, "events"), shared_dir(spark, "events")
    events.repartition(FILES).write.parquet(folder)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", PER_BATCH).parquet(folder)


def stream_first_seen(spark, sf):
    rows = _event_stream(spark, sf).selectExpr("event_type AS period", "user_id", "cast(ts AS TIMESTAMP) AS seen_at")
    folder = shared_dir(spark, "seen")
    # The whole month counts as late enough.
    seen = first_seen(rows, ["period", "user_id"], "seen_at", "31 days")
    write_first_seen(seen, folder, shared_dir(spark, "stream")).awaitTermination()
    return spark.read.parquet(folder).select("period", "user_id")


def stream_first_ever(spark, sf):
    """Sightings in order of time, far more than a day apart; every twentieth user is known before."""
    events, folder = table(spark, sf, "events"), shared_dir(spark, "events")
    events.repartitionByRange(FILES, "ts").sortWithinPartitions("ts").write.parquet(folder)
    rows = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    rows = rows.selectExpr("event_type AS period", "user_id", "cast(ts AS TIMESTAMP) AS seen_at")
    known = events.where("user_id % 20 = 0").selectExpr("event_type AS period", "user_id")
    output = shared_dir(spark, "seen")
    write_first_seen(first_seen(rows, ["period", "user_id"], "seen_at", None, known), output, shared_dir(spark, "stream")).awaitTermination()
    return spark.read.parquet(output).select("period", "user_id")


def stream_latest(spark, sf):
    rows = _event_stream(spark, sf).selectExpr(
        "event_type AS period", "cast(user_id AS STRING) AS url", "dayofmonth(ts) AS version", "event_id AS seq", "props"
    )
    folder = shared_dir(spark, "latest")
    write_running_latest(rows, folder, shared_dir(spark, "stream")).awaitTermination()
    return read_running_latest(spark, folder, rows.schema)


def stream_ledger(spark, sf):
    """Three crawl runs of ten days each, every one read by the ledger stream."""
    folder, ledger, checkpoint = (shared_dir(spark, p) for p in ("observations", "ledger", "stream"))
    seen = table(spark, sf, "events").selectExpr(
        "event_type AS period",
        "concat('https://files.example.org/u', user_id, '.json') AS url",
        "true AS head_ok", "cast(null AS STRING) AS etag", "cast(null AS STRING) AS last_modified",
        "cast(length(props) AS BIGINT) AS content_length", "200 AS cond_status", "200 AS get_status",
        "sha2(props, 256) AS sha256", "cast(length(props) AS BIGINT) AS bytes", "cast(ts AS TIMESTAMP) AS observed_at",
        f"least(cast(floor((dayofmonth(ts) - 1) / 10) AS INT), {RUNS - 1}) AS run",
    )
    for run in range(RUNS):
        seen.where(F.col("run") == run).drop("run").write.mode("append").parquet(folder)
        run_incremental(
            observation_stream(spark, folder), ledger, "/data", "yearbook", checkpoint
        ).awaitTermination()
        if run == 1:
            # A cleanup in between rewrites the ledger; the files are all there.
            there = LedgerStore(spark, ledger).read().select(F.col("saved_path").alias("path"), F.lit(False).alias("is_dir"))
            LedgerStore(spark, ledger).replace(reconcile(LedgerStore(spark, ledger).read(), there)[0])
            # The last batch once more, as after a restart.
            again = seen.where(F.col("run") == run).drop("run")
            found = again.select("period", "url").distinct().withColumn("filename", F.substring_index("url", "/", -1))
            run_ledger(LedgerStore(spark, ledger), found, again, "/data", "yearbook", run)
    return LedgerStore(spark, ledger).read().select("period", "url", "version", "filename", "sha256", "bytes", "seq")


QUERIES = {
    "stream_first_seen": stream_first_seen,
    "stream_first_ever": stream_first_ever,
    "stream_latest": stream_latest,
    "stream_ledger": stream_ledger,
}

ORACLE = {
    "stream_first_seen": "SELECT DISTINCT event_type AS period, user_id FROM events",
    "stream_first_ever": "SELECT DISTINCT event_type AS period, user_id FROM events WHERE user_id % 20 <> 0",
    "stream_latest": """
        SELECT event_type AS period, CAST(user_id AS VARCHAR) AS url, CAST(day(ts) AS INTEGER) AS version, event_id AS seq, props
        FROM events QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY day(ts) DESC, event_id DESC) = 1""",
    "stream_ledger": """
        WITH seen AS (
            SELECT event_type AS period, user_id, props, least((day(ts) - 1) // 10, 2) AS seq FROM events
            QUALIFY row_number() OVER (PARTITION BY event_type, user_id, seq ORDER BY ts DESC) = 1),
        changed AS (
            SELECT * FROM seen QUALIFY lag(props) OVER (PARTITION BY period, user_id ORDER BY seq) IS DISTINCT FROM props)
        SELECT period, 'https://files.example.org/u' || user_id || '.json' AS url, seq,
               CAST(row_number() OVER (PARTITION BY period, user_id ORDER BY seq) AS INTEGER) AS version,
               'u' || user_id || CASE WHEN version = 1 THEN '' ELSE '.v' || version END || '.json' AS filename,
               sha256(props) AS sha256, length(props) AS bytes
        FROM changed""",
}
