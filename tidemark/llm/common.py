"""Expressions shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words are runs of anything but the six ASCII white space characters.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def bucket_of(column: str, modulus: int) -> Column:
    """``crc32`` of the value as text, modulo `modulus`; null for null."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def word_count(text: Column) -> Column:
    """Number of white-space-separated words; 0 for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE))).cast("long")


def row_key(doc_id: str, text: str) -> Column:
    """64 bits that stand for a row; used together with its id, as equal rows are one document."""
    return F.xxhash64(F.col(doc_id), F.col(text))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner") -> DataFrame:
    """Join by equal keys where null equals null; keeps the left keys only."""
    renamed, condition = right, F.lit(True)
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_right_{key}")
        condition = condition & left[key].eqNullSafe(renamed[f"_right_{key}"])
    return left.join(renamed, condition, how).drop(*[f"_right_{key}" for key in keys])


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores appended until no column of `df` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
