"""The latest row per key of many batches, in folders that are merged level by level.

A batch is a folder of level 0. When `FANOUT` folders of a level are there, they are merged into
one of the next level, which holds each of their keys once. So after n batches a reader meets
at most `FANOUT` - 1 folders for each of log n levels, and a row is written once a level. Which folders
count is one small file, written whole when a batch is through; folders are never changed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import files_in, write_text_once
from tidemark.sources.schemas import KEY

FANOUT = 8
BATCH = "batch"


@dataclass(frozen=True)
class Run:
    level: int
    first: int  # first and last batch in it
    last: int
    folder: str


def latest_of(rows: DataFrame) -> DataFrame:
    """Per key the row of the last batch that changed it."""
    rest = [c for c in rows.columns if c not in KEY]
    return rows.groupBy(*KEY).agg(F.max_by(F.struct(*rest), BATCH).alias("_row")).select(*KEY, *[F.col("_row")[c].alias(c) for c in rest])


class MergeLog:
    def __init__(self, spark: SparkSession, root: str, fanout: int = FANOUT):
        self.spark, self.root, self.fanout = spark, root.rstrip("/"), fanout

    def _numbers(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in files_in(self.spark, f"{self.root}/commits") if n.endswith(".json"))

    def runs(self) -> list[Run]:
        """Folders that count, oldest first."""
        numbers = self._numbers()
        if not numbers:
            return []
        text = self.spark.read.text(f"{self.root}/commits/{numbers[-1]:012d}.json", wholetext=True).first()[0]
        return [Run(**r) for r in json.loads(text)]

    def _write(self, rows: DataFrame, level: int, first: int, last: int) -> Run:
        folder = f"runs/{level}-{first}-{last}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.root}/{folder}")
        return Run(level, first, last, folder)

    def _load(self, runs: list[Run], schema: T.StructType) -> DataFrame:
        schema = T.StructType([*[f for f in schema if f.name != BATCH], T.StructField(BATCH, T.LongType())])
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{r.folder}" for r in runs])

    def append(self, changed: DataFrame, batch: int) -> None:
        """Add the rows that batch `batch` changed, each key once. A batch that is there already is not added again."""
        runs = self.runs()
        if runs and batch <= runs[-1].last:
            return
        runs.append(self._write(changed.withColumn(BATCH, F.lit(batch).cast("long")), 0, batch, batch))
        level = 0
        while len(same := [r for r in runs if r.level == level]) >= self.fanout:
            merged = self._write(latest_of(self._load(same, changed.schema)), level + 1, same[0].first, same[-1].last)
            runs = [r for r in runs if r.level > level] + [merged]
            level += 1
        write_text_once(self.spark, f"{self.root}/commits/{max(self._numbers(), default=-1) + 1:012d}.json", json.dumps([asdict(r) for r in runs]))

    def read(self, schema: T.StructType) -> DataFrame:
        """Current latest rows, as `schema` has them."""
        return latest_of(self._load(self.runs(), schema)).select(*schema.names)
