"""The ledger and its views over streams of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.url import last_segment, url_path
from tidemark.operators.ledger import SAFE, latest_manifest
from tidemark.operators.skew import SALTS
from tidemark.plans.ledger_run import run_ledger
from tidemark.sources.ledger_store import LedgerStore
from tidemark.sources.merge_log import MergeLog
from tidemark.sources.schemas import KEY, OBSERVATION


def observation_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Observation files as they arrive in `folder`."""
    return spark.readStream.schema(OBSERVATION).parquet(folder)


def run_incremental(
    observations: DataFrame,
    ledger: str,
    base_dir: str,
    source_id: str,
    checkpoint: str,
    mode: str = SAFE,
    first_batch: int = 0,
) -> StreamingQuery:
    """Apply every new batch of observations to the ledger at `ledger`.

    A micro-batch stands for one crawl run: of several observations of a key in it
    the last one counts. A batch that is run again reads the ledger as it was before
    it and overwrites its own rows, so a replay changes nothing.
    """

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        store = LedgerStore(batch.sparkSession, ledger)
        links = batch.select(*KEY).distinct().withColumn("filename", F.expr(f"lower({last_segment(url_path('url'))})"))
        run_ledger(store, links, batch, base_dir, source_id, first_batch + batch_id, mode=mode)

    return (
        observations.writeStream.foreachBatch(apply_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def first_seen(rows: DataFrame, keys, event_time: str, delay: str | None, known: DataFrame | None = None) -> DataFrame:
    """First sighting of every key: within `delay` of event time, or, with None, ever.

    Without a delay the state holds every key it has met, as a key counts as unseen only once; keep
    it in a state store on disk. Keys in `known`, such as those of the stored ledger when the
    stream begins, are never reported; they are joined to each batch and need no state.

    Sightings of one key are first thinned out in `SALTS` separate groups, so that a
    key with very many of them does not run through a single task.
    """
    keys = list(keys)
    if known is not None:
        rows = rows.join(known.select(*keys).distinct(), keys, "left_anti")
    salt = F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS))
    thinned = rows.withColumn("_salt", salt)
    if delay is None:
        # Of a micro-batch's sightings one per key is left when they meet the key's state.
        return thinned.dropDuplicates([*keys, "_salt"]).drop("_salt").dropDuplicates(keys)
    thinned = thinned.withWatermark(event_time, delay)
    thinned = thinned.dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return thinned.dropDuplicatesWithinWatermark(keys)


def write_first_seen(rows: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", folder)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def write_running_latest(manifest: DataFrame, folder: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest row per key of a stream of ledger rows.

    Each batch adds the keys it changed as a folder; folders are merged level by level
    (see `MergeLog`), so that a reader meets few of them however long the stream has run. A
    batch that is run again is not added twice.
    """

    def write_batch(changed: DataFrame, batch_id: int) -> None:
        MergeLog(changed.sparkSession, folder).append(changed, batch_id)

    return (
        latest_manifest(manifest)
        .writeStream.foreachBatch(write_batch)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_running_latest(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """Current latest rows: per key those of the last batch that changed it."""
    return MergeLog(spark, folder).read(schema)
