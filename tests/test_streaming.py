from pyspark.sql import functions as F

from tidemark import run_incremental
from tidemark.operators.ledger import plan_changes
from tidemark.plans.ledger_run import run_ledger
from tidemark.sources.ledger_store import LedgerStore
from tidemark.sources.merge_log import MergeLog
from tidemark.sources.schemas import KEY, OBSERVATION
from tidemark.streaming.incremental import first_seen, observation_stream, write_first_seen


def observe(spark, run, changed):
    number = F.col("id")
    return spark.range(20).select(
        F.lit("p").alias("period"), F.format_string("https://h/%d.pdf", number).alias("url"), F.lit(True).alias("head_ok"),
        F.concat_ws("-", number, F.when(number % changed == 0, F.lit(run))).alias("etag"), F.lit(None).cast("string").alias("last_modified"),
        F.lit(1).cast("long").alias("content_length"), F.lit(200).alias("cond_status"), F.lit(200).alias("get_status"),
        F.concat_ws("-", number, F.when(number % changed == 0, F.lit(run))).alias("sha256"), F.lit(1).cast("long").alias("bytes"),
        F.expr(f"timestamp'2024-01-0{run + 1} 00:00:00'").alias("observed_at"),
    )


def content(store):
    return sorted((r["url"], r["version"], r["sha256"], r["seq"]) for r in store.read().collect())


def test_stream_equals_batch_and_replay_changes_nothing(spark, tmp_path):
    folder, ledger, checkpoint = (str(tmp_path / p) for p in ("in", "ledger", "checkpoint"))
    batch = LedgerStore(spark, str(tmp_path / "batch"))
    for run in range(3):
        now = observe(spark, run, 5)
        now.write.mode("append").parquet(folder)
        run_incremental(observation_stream(spark, folder), ledger, "/d", "s", checkpoint).awaitTermination()
        found = now.select(*KEY).withColumn("filename", F.substring_index("url", "/", -1))
        run_ledger(batch, found, now, "/d", "s", run)
    streamed = LedgerStore(spark, ledger)
    assert content(streamed) == content(batch)
    assert streamed.read().count() == 20 + 2 * 4
    # The last batch again, as after a restart between its write and its commit.
    run_ledger(streamed, found, now, "/d", "s", 2)
    assert content(streamed) == content(batch)
    fast = plan_changes(found, streamed.read(), now, "fast")
    assert {r["reason"] for r in fast.collect()} == {"seen-fast"}


def test_first_sightings(spark, tmp_path):
    rows = spark.range(1000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id % 50)) AS k", "timestamp_seconds(1700000000 + id) AS at", "id"
    )
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    write_first_seen(first_seen(stream, ["k"], "at", "1 hour"), out, str(tmp_path / "checkpoint")).awaitTermination()
    got = [r["k"] for r in spark.read.parquet(out).collect()]
    assert sorted(got) == sorted({r["k"] for r in rows.select("k").distinct().collect()})


def test_keys_are_first_seen_once_for_ever(spark, tmp_path):
    """Sightings days apart, a restart between them: with a delay of an hour a key is reported again, without one it is not."""
    known = spark.createDataFrame([("old",)], "k STRING")
    got = {}
    for name, delay in (("short", "1 hour"), ("ever", None)):
        out, folder, checkpoint = (str(tmp_path / f"{name}-{p}") for p in ("out", "in", "checkpoint"))
        for day in range(4):
            rows = spark.createDataFrame([(k,) for k in ("a", "old", f"day{day}")], "k STRING").withColumn("at", F.timestamp_seconds(F.lit(1_700_000_000 + 86_400 * day)))
            rows.coalesce(1).write.mode("append").parquet(folder)
            stream = spark.readStream.schema(rows.schema).parquet(folder)
            write_first_seen(first_seen(stream, ["k"], "at", delay, known), out, checkpoint).awaitTermination()
        got[name] = sorted(r["k"] for r in spark.read.parquet(out).collect())
    assert got["ever"] == ["a", "day0", "day1", "day2", "day3"]
    assert got["short"].count("a") > 1 and "old" not in got["short"]


def test_many_batches_are_few_folders(spark, tmp_path):
    log, want = MergeLog(spark, str(tmp_path / "log"), fanout=3), {}
    schema = "period STRING, url STRING, version INT"
    for batch in range(30):
        keys = [batch % 4, batch % 7 + 10, batch]
        changed = spark.createDataFrame([("p", f"u{k}", batch) for k in sorted(set(keys))], schema)
        log.append(changed, batch)
        log.append(changed, batch)
        want.update({f"u{k}": batch for k in keys})
        assert len(log.runs()) <= 2 * 4 and [r.first for r in log.runs()] == sorted(r.first for r in log.runs())
    assert {r["url"]: r["version"] for r in log.read(changed.schema).collect()} == want
    # An older batch again changes nothing.
    log.append(spark.createDataFrame([("p", "u1", 99)], schema), 3)
    assert log.read(changed.schema).count() == len(want)
    assert MergeLog(spark, str(tmp_path / "none")).read(changed.schema).collect() == []


def test_observation_layout():
    assert OBSERVATION.names[:2] == KEY
