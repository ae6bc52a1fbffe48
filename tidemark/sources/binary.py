"""Stored files: listed without their content, opened by path where they are needed."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bytes of a file that are held while it is hashed.
CHUNK = 8 * 2**20


def normal_path(path: Column) -> Column:
    """One form for every path: no ``file:`` scheme, no doubled slashes, none at the end.

    A path that has none of these, as nearly all have, is passed on after three plain tests.
    """
    odd = path.contains("//") | path.endswith("/") | (F.lower(F.substring(path, 1, 5)) == "file:")
    return F.when(odd, _normalised(path)).otherwise(path)


def _normalised(path: Column) -> Column:
    bare = F.regexp_replace(path, r"(?i)^file:(?://(?:localhost)?)?(?=/)", "")
    bare = F.regexp_replace(bare, r"(?<!^[A-Za-z][A-Za-z0-9+.-]{0,30}:)(?<!^[A-Za-z][A-Za-z0-9+.-]{0,30}:/)/{2,}", "/")
    return F.regexp_replace(bare, r"(?<=[^/:])/+$", "")


def normal_folder(spark: SparkSession, path: str) -> str:
    """`normal_path` of one path known to the driver."""
    return spark.range(1).select(normal_path(F.lit(path))).first()[0]


def file_system(path: str) -> tuple[FileSystem, str]:
    """Where a normal path leads, on whatever machine this runs."""
    return FileSystem.from_uri(path)


def open_file(path: str):
    """A stored file for reading at any place."""
    system, inner = file_system(path)
    return system.open_input_file(inner)


def read_binary(spark: SparkSession, folder: str, ending: str) -> DataFrame:
    """Files at or below `folder` whose lowercased name ends in `ending`: path, length. None is opened."""
    from tidemark.operators.inventory import list_paths

    files = list_paths(spark, folder).where("NOT is_dir").select("path", "length")
    return files.where(F.lower("path").endswith(ending))


def hash_files(paths: DataFrame) -> DataFrame:
    """SHA-256 and size of the files in `paths` (path): path, sha256, bytes.

    Each file is read once, in chunks, where its path lies, so its length does not matter.
    One that is gone gives no row.
    """

    def hashed(batches):
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                digest, size = hashlib.sha256(), 0
                try:
                    with open_file(path) as stream:
                        while chunk := stream.read(CHUNK):
                            digest.update(chunk)
                            size += len(chunk)
                except FileNotFoundError:
                    continue
                rows.append({"path": path, "sha256": digest.hexdigest(), "bytes": size})
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("sha256", pa.string()), ("bytes", pa.int64())]))

    return paths.select("path").mapInArrow(hashed, "path STRING, sha256 STRING, bytes BIGINT")
