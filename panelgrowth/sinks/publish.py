"""Tables of a run that appear together, and sections that a rerun skips
(SURVEY K8, M7, M8).

A run writes its tables under ``base/_runs/<run>/``; nobody reads them there.  When
all are written, one row (sequence number, run, tables) is appended to
``base/_published``: a single small file that the writer's commit moves into
place.  Readers take the row of the highest number, so they see the old set until
then and the whole new set after; a run that is lost in between leaves the old one.

What a run has finished is noted, table by table, in ``base/_state`` under the
fingerprint of its inputs (files with their sizes and times, parameters).  A rerun
with the same fingerprint reads finished tables where they are; other inputs have
another fingerprint and share nothing.  A table is noted after its write was
committed, so a half-written one is never taken for finished; it is replaced.
"""

from __future__ import annotations

import hashlib
import json
import threading
import uuid
from typing import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelgrowth.sinks.writers import SinkTarget

PUBLISHED = "seq long, run string, tables array<string>"
STATE = "run string, name string, path string, fmt string"


def _rows(spark: SparkSession, path: str, ddl: str) -> DataFrame | None:
    """A small table of notes; None where nothing was noted yet."""
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None


def _note(spark: SparkSession, path: str, ddl: str, row: tuple) -> None:
    spark.createDataFrame([row], ddl).coalesce(1).write.mode("append").parquet(path)


def fingerprint(spark: SparkSession, paths: Iterable[str], **parameters) -> str:
    """Name of a run: its input files by size and time, and its parameters.

    The files are summed up on the cluster; no file is read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    files = found.groupBy("path").agg(F.max("length").alias("n"), F.max("modificationTime").alias("t"), F.count(F.lit(1)).alias("k"))
    line = F.sha2(F.concat_ws("\n", "path", F.col("n").cast("string"), F.unix_micros("t").cast("string"), F.col("k").cast("string")), 256)
    # an order-free digest: both halves of the lines' hashes added up
    half = lambda at: F.sum(F.conv(F.substring(line, at, 15), 16, 10).cast("decimal(20,0)"))
    row = files.agg(F.count(F.lit(1)), half(1), half(16), half(31)).head()
    said = json.dumps([str(x) for x in row], sort_keys=True) + json.dumps(parameters, sort_keys=True, default=str)
    return hashlib.sha256(said.encode()).hexdigest()[:24]


class Run:
    """A run's tables under ``target.base``, staged, noted and published."""

    def __init__(self, spark: SparkSession, target: SinkTarget, name: str):
        if target.fmt == "jdbc":
            raise ValueError("tables that appear together need a file target")
        self.spark, self.target, self.name = spark, target, name
        base = target.base.rstrip("/")
        self.folder, self.state, self.published = f"{base}/_runs/{name}", f"{base}/_state", f"{base}/_published"
        notes = _rows(spark, self.state, STATE)
        own = notes.where(F.col("run") == name).collect() if notes is not None else []  # a row a table of this run
        self.done = {r["name"]: (r["path"], r["fmt"]) for r in own}
        self.lock = threading.Lock()

    def has(self, name: str) -> bool:
        return name in self.done

    def read(self, name: str) -> DataFrame:
        path, fmt = self.done[name]
        return self.spark.read.format(fmt).load(path)

    def staged(self) -> SinkTarget:
        """Where the tables of this attempt go: a name of its own, as a lost
        attempt may still be writing."""
        return SinkTarget(self.target.fmt, f"{self.folder}/{uuid.uuid4().hex}")

    def note(self, name: str, path: str, fmt: str) -> None:
        with self.lock:  # one writer at a time; the sections run side by side
            _note(self.spark, self.state, STATE, (self.name, name, path, fmt))
            self.done[name] = (path, fmt)

    def write(self, name: str, writer: Callable[[SinkTarget], None]) -> None:
        """Writes a table by ``writer(staged target)`` unless it is finished."""
        if not self.has(name):
            to = self.staged()
            writer(to)
            self.note(name, to.path(name), to.fmt)

    def keep(self, df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
        """An intermediate table, written once for all attempts of the run."""
        if not self.has(label):
            path = self.staged().path(label)
            out = df.write
            (out.partitionBy(*partition_by) if partition_by else out).parquet(path)
            self.note(label, path, "parquet")
        return self.spark.read.schema(df.schema).parquet(self.done[label][0])

    def publish(self, tables: Iterable[str]) -> None:
        """Shows the finished tables, all at once, in place of those before."""
        tables = list(tables)
        missing = [t for t in tables if not self.has(t)]
        if missing:
            raise ValueError(f"not finished: {missing}")
        seq, run = _latest(self.spark, self.target)
        if run != self.name:
            _note(self.spark, self.published, PUBLISHED, (seq + 1, self.name, tables))


def _latest(spark: SparkSession, target: SinkTarget) -> tuple[int, str | None]:
    rows = _rows(spark, f"{target.base.rstrip('/')}/_published", PUBLISHED)
    row = rows.agg(F.max("seq"), F.max_by("run", "seq")).head() if rows is not None else (None, None)
    return row[0] or 0, row[1]


def read_published(spark: SparkSession, target: SinkTarget, table: str) -> DataFrame:
    """A table of the set that was published last."""
    _, run = _latest(spark, target)
    if run is None:
        raise ValueError(f"nothing was published under {target.base}")
    own = Run(spark, target, run)
    shown = _rows(spark, own.published, PUBLISHED).where(F.col("run") == run).orderBy(F.desc("seq")).head()["tables"]
    if table not in shown:
        raise ValueError(f"{table} is not among the published tables {sorted(shown)}")
    return own.read(table)
