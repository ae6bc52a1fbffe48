"""Archives as rows of bytes, unpacked to one row per member.

The unit of work is an archive. A task holds one batch of archives and a bounded
number of bytes of unpacked members at a time.
"""

from __future__ import annotations

import hashlib
import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.names import base_name, stem
from tidemark.operators.skew import skew_join
from tidemark.sources.binary import CHUNK, normal_path, open_file, read_binary

_MEMBERS = "archive STRING, member STRING, size BIGINT, sha256 STRING, content BINARY, error STRING"
_ARROW = pa.schema(
    [
        ("archive", pa.string()),
        ("member", pa.string()),
        ("size", pa.int64()),
        ("sha256", pa.string()),
        ("content", pa.binary()),
        ("error", pa.string()),
    ]
)


# Members handed on together, by number and by bytes.
_ROWS, _BYTES = 1000, 32 * 2**20


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Archives at or below `folder`: path, length. They are opened where they are expanded."""
    return read_binary(spark, folder, ".zip")


# A value of a row holds less than 2 GiB.
LONGEST = 2**31 - 1024


def _member(archive: zipfile.ZipFile, info: zipfile.ZipInfo, keep_content: bool, longest: int) -> dict:
    """Size, hash and, if wanted, content of a member, read in chunks."""
    digest, size, held = hashlib.sha256(), 0, []
    with archive.open(info) as stream:
        while chunk := stream.read(CHUNK):
            digest.update(chunk)
            size += len(chunk)
            if keep_content and size <= longest:
                held.append(chunk)
    kept = keep_content and size <= longest
    return {
        "member": info.filename,
        "size": size,
        "sha256": digest.hexdigest(),
        "content": b"".join(held) if kept else None,
        "error": "member too large for a row" if keep_content and not kept else None,
    }


def _members(path: str, content: bytes | None, keep_content: bool, longest: int) -> Iterator[dict]:
    nothing = {"archive": path, "member": None, "size": None, "sha256": None, "content": None}
    try:
        with (open_file(path) if content is None else io.BytesIO(content)) as source, zipfile.ZipFile(source) as archive:
            for info in archive.infolist():
                if not info.is_dir():
                    yield {"archive": path, **_member(archive, info, keep_content, longest)}
    except (zipfile.BadZipFile, pa.ArrowInvalid):  # the latter where a file is too short to seek in
        yield {**nothing, "error": "not a valid archive"}
    except Exception as failure:  # an archive that cannot be read must not end the job
        yield {**nothing, "error": type(failure).__name__}


def expand_archives(archives: DataFrame, keep_content: bool = False, longest: int = LONGEST) -> DataFrame:
    """Members of every archive in `archives` (path, and content unless it is to be opened there).

    Columns: archive, folder, member, path, size, sha256, content, error. `folder` is
    the archive's path without its ending, `path` where the member lands in it. An
    archive that cannot be read gives a row with `error`.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            contents = batch.column(1) if batch.num_columns > 1 else [None] * batch.num_rows
            for path, content in zip(batch.column(0), contents):
                for row in _members(path.as_py(), content and content.as_py(), keep_content, longest):
                    held.append(row)
                    size += len(row["content"] or b"")
                    if len(held) >= _ROWS or size >= _BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
                        held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)

    columns = ["path", *[c for c in archives.columns if c == "content"]]
    named = archives.select(*columns).withColumn("path", normal_path(F.col("path")))
    members = named.mapInArrow(unpack, _MEMBERS)
    name = base_name(F.col("archive"))
    parent = F.substring(F.col("archive"), F.lit(1), F.length("archive") - F.length(name))
    folder = F.concat(parent, stem(name))
    # A member cannot leave the folder: empty, "." and ".." parts of its name are void.
    inner = F.array_join(F.filter(F.split("member", "/"), lambda p: ~p.isin("", ".", "..")), "/")
    return members.select(
        "archive",
        folder.alias("folder"),
        "member",
        F.concat_ws("/", folder, inner).alias("_path"),
        "size",
        "sha256",
        "content",
        "error",
    ).select(
        "archive", "folder", "member",
        F.when(F.col("error").isNull(), F.col("_path")).alias("path"),
        "size", "sha256", "content", "error",
    )


def moves_of_archives(manifest: DataFrame, members: DataFrame) -> DataFrame:
    """Moves that point the ledger to the folders of unpacked archives.

    An archive with any failure keeps its entry as it is. Result: period, url, new_path.
    """
    unpacked = (
        members.groupBy("archive", "folder")
        .agg(F.count("error").alias("_failures"))
        .where("_failures = 0")
        .select(F.col("archive").alias("saved_path"), F.col("folder").alias("new_path"))
    )
    saved = manifest.select("period", "url", normal_path(F.col("saved_path")).alias("saved_path"))
    return skew_join(saved, unpacked, ["saved_path"], "inner").select(
        "period", "url", "new_path"
    )
