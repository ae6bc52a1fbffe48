"""The ledger as Parquet folders by period, with an index of each key's latest row.

A state of the ledger is a list of folders, each with the rows of one period that one write
brought, and another list with the latest rows of its keys, by period and bucket of the key's
hash. It is one small file below `commits`, which appears whole or not at all; the highest
number counts. Folders are never changed, so a reader keeps what it began with, a write that
fails leaves nothing to be seen, and a rewrite of some periods leaves all others' folders alone.

A batch that is applied again takes the place of what it brought before. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterable
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ledger import MOST_PERIODS, latest_manifest, of_keys
from tidemark.session import files_in, write_text_once
from tidemark.sources.schemas import MANIFEST

# Buckets of a period's keys in the index of a new ledger. More of them let an append to a period
# of very many keys write less; fewer keep small periods in few files.
BUCKETS = 4
# Folders of a period above which a run gathers them.
MOST_FOLDERS = 32
# The folder name that stands for a missing period.
_NO_PERIOD = "__HIVE_DEFAULT_PARTITION__"
# Columns that are folders.
_ROWS = T.StructType([*MANIFEST.fields, T.StructField("written", T.StringType())])
_LATEST = T.StructType([*_ROWS.fields, T.StructField("bucket", T.IntegerType())])


@dataclass(frozen=True)
class Part:
    """Rows of one period in one folder: of the batch that appended them, or of several, rewritten
    when `upto` was the last batch; those of the batches in `without` were replaced since."""

    period: str | None
    folder: str
    batch: int | None = None
    upto: int = -1
    without: tuple[int, ...] = ()


@dataclass(frozen=True)
class IndexPart:
    period: str | None
    bucket: int
    folder: str


@dataclass(frozen=True)
class State:
    last: int = -1  # the highest batch that was appended
    buckets: int = BUCKETS
    rows: tuple[Part, ...] = field(default=())
    latest: tuple[IndexPart, ...] = field(default=())

    def to_text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_text(text: str) -> State:
        raw = json.loads(text)
        rows = tuple(Part(**{**p, "without": tuple(p["without"])}) for p in raw.pop("rows"))
        return State(**{**raw, "rows": rows, "latest": tuple(IndexPart(**p) for p in raw["latest"])})


class LedgerStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self._pending: State | None = None
        self._known: tuple[int, State] | None = None  # the last commit that was read

    # --- states --------------------------------------------------------------------

    def _files(self, folder: str) -> list[str]:
        """Names in a folder below the root."""
        return files_in(self.spark, f"{self.root}/{folder}")

    def _commits(self) -> list[int]:
        return sorted(int(name.removesuffix(".json")) for name in self._files("commits") if name.endswith(".json"))

    def state(self) -> State:
        """What is committed, or what the run that is open has done so far."""
        if self._pending is not None:
            return self._pending
        numbers = self._commits()
        if not numbers:
            return State(buckets=self.buckets)
        if self._known is None or self._known[0] != numbers[-1]:
            lines = self.spark.read.text(f"{self.root}/commits/{numbers[-1]:012d}.json", wholetext=True)
            self._known = numbers[-1], State.from_text(lines.first()[0])
        return self._known[1]

    def _commit(self, state: State) -> None:
        number = max(self._commits(), default=-1) + 1
        write_text_once(self.spark, f"{self.root}/commits/{number:012d}.json", state.to_text())

    def _becomes(self, state: State) -> None:
        if self._pending is None:
            self._commit(state)
        else:
            self._pending = state

    @contextmanager
    def run(self):
        """Everything done inside is one commit; an error leaves the ledger as it was."""
        if self._pending is not None:  # part of a larger run
            yield self
            return
        before = self.state()
        self._pending = before
        try:
            yield self
            done = self._pending
        finally:
            self._pending = None
        if done != before:
            self._commit(done)

    # --- reading -------------------------------------------------------------------

    def _load(self, schema: T.StructType, place: str, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{place}").parquet(*[f"{self.root}/{f}" for f in folders])

    def _rows(self, parts: Iterable[Part]) -> DataFrame:
        by_replaced: dict[tuple[int, ...], list[str]] = defaultdict(list)
        for part in parts:
            by_replaced[part.without].append(part.folder)
        found = None
        for without, folders in by_replaced.items():
            rows = self._load(_ROWS, "rows", folders).drop("written")
            rows = rows.where(~F.col("seq").isin(*without)) if without else rows
            found = rows if found is None else found.unionByName(rows)
        return self.spark.createDataFrame([], MANIFEST) if found is None else found.select(*MANIFEST.names)

    def read(self, before: int | None = None, periods: Iterable[str | None] | None = None) -> DataFrame:
        """Current rows; only those of earlier batches with `before`, of some periods with `periods`."""
        wanted = None if periods is None else set(periods)
        parts = [p for p in self.state().rows if (wanted is None or p.period in wanted) and (before is None or p.batch is None or p.batch < before)]
        rows = self._rows(parts)
        return rows if before is None else rows.where(F.col("seq") < before)

    def latest(self, keys: DataFrame | None = None, before: int | None = None) -> DataFrame:
        """Latest row per key, as `latest_manifest` gives it; only of `keys` (period, url) if given.

        Read from the index; the history is looked at only where `before` is not behind the last
        batch, which happens when a batch is applied again.
        """
        state = self.state()
        if before is not None and before <= state.last:
            return latest_manifest(self.read(before), keys)
        if not state.latest:
            return self.spark.createDataFrame([], MANIFEST)
        folders = state.latest
        if keys is not None:
            named = [r["period"] for r in keys.select("period").distinct().limit(MOST_PERIODS + 1).collect()]
            if len(named) <= MOST_PERIODS:
                folders = [p for p in folders if p.period in named]
        if not folders:
            return self.spark.createDataFrame([], MANIFEST)
        rows = self._load(_LATEST, "latest", [p.folder for p in folders]).select(*MANIFEST.names)
        return rows if keys is None else of_keys(rows, keys)

    # --- writing -------------------------------------------------------------------

    def _write(self, rows: DataFrame, place: str, by: list[str]) -> list[tuple[list[str | None], str]]:
        """Folders of a new write: the values they stand for, and their paths below the root."""
        written = uuid.uuid4().hex
        base = f"{place}/written={written}"
        # Rebalancing splits a large folder over many files and gathers small ones.
        rows.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{self.root}/{base}")
        found: list[tuple[list[str | None], str]] = [([], base)]
        for column in by:
            found = [
                ([*values, None if name == f"{column}={_NO_PERIOD}" else unquote(name.split("=", 1)[1])], f"{folder}/{name}")
                for values, folder in found
                for name in sorted(self._files(folder))
                if name.startswith(f"{column}=")
            ]
        return found

    def _bucket(self, state: State):
        return F.pmod(F.hash("url"), F.lit(state.buckets)).alias("bucket")

    def _indexed(self, state: State, rows: DataFrame, touched: set[tuple[str | None, int]]) -> State:
        """`state` with the latest of `rows` in the `touched` places of the index."""
        folders = self._write(latest_manifest(rows).select(*MANIFEST.names, self._bucket(state)), "latest", ["period", "bucket"])
        kept = [p for p in state.latest if (p.period, p.bucket) not in touched]
        return replace(state, latest=tuple(kept) + tuple(IndexPart(period, int(bucket), folder) for (period, bucket), folder in folders))

    def _places(self, state: State, rows: DataFrame) -> set[tuple[str | None, int]]:
        """Places of the index that hold the keys of `rows`: no more than the index has folders."""
        return {(r["period"], r["bucket"]) for r in rows.select("period", self._bucket(state)).distinct().collect()}

    def append(self, rows: DataFrame, batch: int) -> None:
        """Add the rows of batch `batch`, in place of any it wrote before."""
        state = self.state()
        written = self._write(rows.withColumn("seq", F.lit(batch).cast("long")).select(*MANIFEST.names), "rows", ["period"])
        new = [Part(period, folder, batch) for (period,), folder in written]
        if batch > state.last:
            brought = self._rows(new)
            touched = self._places(state, brought) if new else set()
            state = replace(state, last=batch, rows=state.rows + tuple(new))
            if touched:
                old = [p.folder for p in state.latest if (p.period, p.bucket) in touched]
                known = self._load(_LATEST, "latest", old).select(*MANIFEST.names) if old else None
                state = self._indexed(state, brought if known is None else known.unionByName(brought), touched)
        else:
            # What the batch had brought is known only from the rows: their places are made anew.
            gone = [p for p in state.rows if p.batch == batch]
            mixed = [p for p in state.rows if p.batch is None and batch <= p.upto and batch not in p.without]
            replaced = self._rows(gone).unionByName(self._rows(mixed).where(F.col("seq") == batch))
            touched = self._places(state, replaced.unionByName(self._rows(new)))
            kept = [replace(p, without=(*p.without, batch)) if p in mixed else p for p in state.rows if p not in gone]
            state = replace(state, rows=tuple(kept) + tuple(new))
            if touched:
                periods = {period for period, _ in touched}
                history = self._rows(p for p in state.rows if p.period in periods)
                places = self.spark.createDataFrame(sorted(touched, key=str), "_period STRING, _bucket INT")
                # As many rows as places of the index.
                there = F.col("period").eqNullSafe(F.col("_period")) & (self._bucket(state) == F.col("_bucket"))
                state = self._indexed(state, history.join(F.broadcast(places), there, "left_semi"), touched)
        self._becomes(state)

    def rewrite(self, rows: DataFrame, periods: Iterable[str | None]) -> None:
        """Put `rows` in place of all rows of `periods`; folders of other periods stay as they are."""
        state, wanted = self.state(), set(periods)
        written = self._write(rows.select(*MANIFEST.names), "rows", ["period"])
        if foreign := {period for (period,), _ in written} - wanted:
            raise ValueError(f"rows of other periods than those to rewrite: {sorted(foreign, key=str)[:5]}")
        new = tuple(Part(period, folder, None, state.last) for (period,), folder in written)
        touched = {(p.period, p.bucket) for p in state.latest if p.period in wanted}
        state = replace(state, rows=tuple(p for p in state.rows if p.period not in wanted) + new)
        if new:
            state = self._indexed(state, self._rows(new), touched)
        else:
            state = replace(state, latest=tuple(p for p in state.latest if (p.period, p.bucket) not in touched))
        self._becomes(state)

    def compact(self, most: int = MOST_FOLDERS) -> list[str | None]:
        """Gather the rows of every period that lies in more than `most` folders in one; returns those periods.

        The list of folders stays short however many batches there are, and a row is written anew
        once in `most` batches of its period.
        """
        crowded = [period for period, n in Counter(p.period for p in self.state().rows).items() if n > most]
        if crowded:
            self.rewrite(self.read(periods=crowded), crowded)
        return crowded

    def replace(self, rows: DataFrame) -> None:
        """Put `rows` in place of the whole ledger; also compacts it."""
        state = self.state()
        written = self._write(rows.select(*MANIFEST.names), "rows", ["period"])
        new = tuple(Part(period, folder, None, state.last) for (period,), folder in written)
        state = replace(state, rows=new, latest=())
        self._becomes(self._indexed(state, self._rows(new), set()) if new else state)
