"""Table layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import blank_to_null, strip, to_long

TEXT, INT, LONG, FLAG, TIME = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType()


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


MAPPING = table(original=TEXT, final=TEXT)

# The ledger; `seq` grows with every appended batch.
MANIFEST = table(
    source_id=TEXT,
    period=TEXT,
    url=TEXT,
    filename=TEXT,
    saved_path=TEXT,
    bytes=LONG,
    sha256=TEXT,
    etag=TEXT,
    last_modified=TEXT,
    version=INT,
    downloaded_at=TIME,
    seq=LONG,
)

# A manifest as plain text holds the same columns but the last, all of them text.
MANIFEST_TEXT = table(**{name: TEXT for name in MANIFEST.names if name != "seq"})

# What a crawl saw of a link, one row per link and run. `cond_status` is the answer to
# the conditional request, `get_status` to the download; null means it failed.
OBSERVATION = table(
    period=TEXT,
    url=TEXT,
    head_ok=FLAG,
    etag=TEXT,
    last_modified=TEXT,
    content_length=LONG,
    cond_status=INT,
    get_status=INT,
    sha256=TEXT,
    bytes=LONG,
    observed_at=TIME,
)

KEY = ["period", "url"]
# Times are written in UTC, whatever the session's time zone.
_TIME_IN = "yyyy-MM-dd'T'HH:mm:ssX"
_TIME_OUT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def typed_manifest(rows: DataFrame) -> DataFrame:
    """Text manifest as ledger rows; `problem` names a value that is no number.

    Blank text is missing, and a blank version is version 1.
    """
    version = F.when(strip(F.coalesce("version", F.lit(""))) == "", F.lit(1)).otherwise(
        strip(F.col("version")).try_cast("int")
    )
    size = to_long(F.col("bytes"))
    problem = F.when(version.isNull(), F.lit("version")).when(
        size.isNull() & (strip(F.coalesce("bytes", F.lit(""))) != ""), F.lit("bytes")
    )
    text = ["filename", "saved_path", "sha256", "etag", "last_modified"]
    return rows.select(
        "source_id",
        "period",
        "url",
        *[blank_to_null(F.col(c)).alias(c) for c in text[:2]],
        size.alias("bytes"),
        *[blank_to_null(F.col(c)).alias(c) for c in text[2:]],
        version.alias("version"),
        F.try_to_timestamp("downloaded_at", F.lit(_TIME_IN)).alias("downloaded_at"),
        F.col("seq"),
        problem.alias("problem"),
    )


def text_manifest(rows: DataFrame) -> DataFrame:
    """Ledger rows as a text manifest, missing values blank."""
    utc = F.to_utc_timestamp("downloaded_at", F.current_timezone())
    cells = {"downloaded_at": F.date_format(utc, _TIME_OUT)}
    return rows.select(
        *[F.coalesce(cells.get(c, F.col(c)).cast("string"), F.lit("")).alias(c) for c in MANIFEST_TEXT.names]
    )
