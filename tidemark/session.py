"""Session helpers: where intermediate tables live, and size checks before a broadcast."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows above which a side is joined by shuffle instead of being broadcast.
BROADCAST_ROWS = 100_000

_own_root: str | None = None
_trial_root: str | None = None


def use_root(folder: str | None) -> None:
    """Folder for intermediate tables of sessions that do not name one in ``spark.checkpoint.dir``; None forgets it."""
    global _own_root, _trial_root
    _own_root, _trial_root = folder, _trial_root if folder else None


def use_trial_root(folder: str) -> None:
    """Folder for sessions on this machine alone, where neither `use_root` nor the session names one."""
    global _trial_root
    _trial_root = folder


def _application_dir(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_root
    if not root and re.match(r"local(\[|$)", spark.sparkContext.master):
        root = _trial_root
    if not root:
        raise RuntimeError("set spark.checkpoint.dir, or call use_root(), to a folder every executor can reach")
    # One folder per application, so that it can be removed as a whole afterwards.
    return f"{root.rstrip('/')}/tidemark/{spark.sparkContext.applicationId}"


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """Path of a new folder below the folder that the cluster names in ``spark.checkpoint.dir``."""
    return f"{_application_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


def _stored(spark: SparkSession, path: str):
    """A path as the file system that holds it sees it, and that file system."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    found, system = _stored(spark, path)
    return system.exists(found)


def files_in(spark: SparkSession, folder: str) -> list[str]:
    """Names directly in a folder; none if it is not there."""
    found, system = _stored(spark, folder)
    return [f.getPath().getName() for f in system.listStatus(found)] if system.exists(found) else []


def write_text_once(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears whole or not at all; an error if it is there already."""
    found, system = _stored(spark, path)
    system.mkdirs(found.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(found.getParent(), f".{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(found.toUri(), spark._jsc.hadoopConfiguration())
    # Without a choice that allows it, a rename never replaces a file.
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    files.rename(draft, found, none)


def remove_tables(spark: SparkSession) -> None:
    """Remove every intermediate table of this application; none may be read afterwards."""
    found, system = _stored(spark, _application_dir(spark))
    system.delete(found, True)


def materialise(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and continue from the written table.

    Its lineage ends there, so a lost executor costs no recomputation of what came
    before, and the table has a known size for the joins that follow.
    """
    path = shared_dir(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `rows` rows; counts no further than one row beyond."""
    return df.limit(rows + 1).count() <= rows


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` marked for broadcast if it was counted and is small, otherwise unchanged."""
    return F.broadcast(df) if fits(df, rows) else df
