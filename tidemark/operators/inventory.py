"""The ledger against the files that are really there."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyarrow.fs import FileSelector, FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import base_name, folder_of_archive
from tidemark.functions.text import blank_to_null, let
from tidemark.operators.skew import skew_join
from tidemark.session import materialise
from tidemark.sources.binary import file_system, normal_folder, normal_path


# Entries of a folder handed on together.
_ENTRIES = 10_000


def list_paths(spark: SparkSession, folder: str) -> DataFrame:
    """Everything below `folder`, level by level, as normal paths: path, is_dir, length.

    The unit of work is a folder. Unlike a file source's listing this one holds empty
    files, empty folders and names Spark takes for hidden.
    """
    layout = pa.schema([("path", pa.string()), ("is_dir", pa.bool_()), ("length", pa.int64())])

    def entries(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, inner = file_system(path)
                prefix = path[: len(path) - len(inner)]
                found = system.get_file_info(FileSelector(inner))
                for start in range(0, len(found), _ENTRIES):
                    some = found[start : start + _ENTRIES]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "path": [prefix + f.path for f in some],
                            "is_dir": [f.type == FileType.Directory for f in some],
                            "length": [None if f.type == FileType.Directory else f.size for f in some],
                        },
                        schema=layout,
                    )

    level, levels = spark.createDataFrame([(normal_folder(spark, folder),)], "path STRING"), []
    while not levels or not level.isEmpty():
        below = level.repartition("path").mapInArrow(entries, "path STRING, is_dir BOOLEAN, length BIGINT")
        levels.append(materialise(below))
        level = levels[-1].where("is_dir").select("path")
    return reduce(DataFrame.unionByName, levels)


def with_folders(files: DataFrame) -> DataFrame:
    """Paths of `files`, and once each the folders above them: path, is_dir.

    Files of one folder are brought together before the folders above it are named.
    """
    parents = files.select(F.regexp_extract("path", r"(?s)^(.*)/", 1).alias("path")).distinct()
    # The folder itself and, cut after segment n-1, n-2, …, 1, those above it.
    above = let(
        "parts",
        "split(path, '/')",
        "transform(sequence(1, size(parts)), n -> array_join(slice(parts, 1, n), '/'))",
    )
    folders = parents.select(F.explode(F.expr(above)).alias("path")).where("path <> ''").distinct()
    return folders.withColumn("is_dir", F.lit(True)).unionByName(
        files.select("path").withColumn("is_dir", F.lit(False))
    )


def _spelling(path: Column) -> Column:
    """Bit of the spelling of a path's ending: none, or one of the eight of ``.zip``."""
    upper = [F.substring(path, F.length(path) - i, F.lit(1)) == c for i, c in ((2, "Z"), (1, "I"), (0, "P"))]
    number = sum((F.when(u, 2**i).otherwise(0) for i, u in enumerate(upper)), F.lit(2))
    return F.when(folder_of_archive(path).isNull(), F.lit(1)).otherwise(F.pow(F.lit(2), number - 1).cast("int"))


def _presence(paths: DataFrame) -> DataFrame:
    """One row per path without ``.zip``: which spellings exist, and whether as a folder."""
    paths = paths.withColumn("path", normal_path(F.col("path")))
    path = F.col("path")
    key = F.coalesce(folder_of_archive(path), path)
    return paths.groupBy(key.alias("_key")).agg(
        F.bit_or(_spelling(path)).alias("_spellings"), F.max((path == key) & F.col("is_dir")).alias("_folder")
    )


def reconcile_status(manifest: DataFrame, paths: DataFrame) -> DataFrame:
    """Ledger rows with ``status``: kept, repaired or removed.

    A row is kept while its path exists. One whose archive is gone, but was unpacked
    to a folder of its name, is repaired to point there. All others, and rows without
    a path, are removed. `paths` is (path, is_dir).
    """
    saved = normal_path(F.col("saved_path"))
    folder = folder_of_archive(saved)
    keyed = manifest.withColumn("_key", blank_to_null(F.coalesce(folder, saved)))
    joined = skew_join(keyed, _presence(paths), ["_key"], "left")
    exists = F.coalesce(F.col("_spellings").bitwiseAND(_spelling(saved)) != 0, F.lit(False))
    unpacked = folder.isNotNull() & F.coalesce("_folder", F.lit(False))
    status = F.when(exists, "kept").when(unpacked, "repaired").otherwise("removed")
    repaired = F.col("status") == "repaired"
    judged = joined.withColumn("status", status)
    cells = {
        "saved_path": F.when(repaired, F.col("_key")).otherwise(F.col("saved_path")),
        "filename": F.when(repaired, base_name(F.col("_key"))).otherwise(F.col("filename")),
    }
    return judged.select(*[cells.get(c, F.col(c)).alias(c) for c in manifest.columns], "status")


def reconcile(manifest: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ledger split into rows that stay (repaired where needed) and removed rows."""
    judged = reconcile_status(manifest, paths)
    return judged.where("status <> 'removed'").drop("status"), judged.where("status = 'removed'").drop("status")
