"""Feed and lookup sources.

* Fact feeds are tab-separated text with a header row.  Every column is read
  as text and matched by header name (names stripped: published files may
  pad them; order and extra columns do not matter), then the
  id/year/value/footnote fields are stripped with built-in expressions.
* A feed may be files, folders or globs; files are grouped by header line and
  appended (UNION ALL, by column name): a series present in two files is
  counted twice, as in the source job.  Headers are found from the first record
  of each file, in tasks over the file list, so a feed is read once.
* ``load_report`` names empty files and files that are listed twice, with their
  row counts.
* Lookups are whole-table reads from any Spark source (parquet, csv, jdbc).
* The run-date row is built from a run date, or from the latest date found
  in the data, never from the wall clock inside a plan.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from typing import Iterable, Iterator, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrowth.functions.clean import WHITESPACE, strip_all

# The column layout of the time-series fact files.
FACT_COLUMNS = ["series_id", "year", "period", "value", "footnote_codes"]


@dataclass(frozen=True)
class FeedFile:
    """A file of a feed: its size, how often the paths name it, its column names."""

    file: str
    bytes: int
    modified: _dt.datetime | None
    listed: int
    names: tuple[str, ...]


def fact_schema(columns: Iterable[str] = FACT_COLUMNS) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def _plain(uri: str) -> str:
    """A file's encoded URI as the listing names it."""
    return re.sub("^file:/+", "file:/", unquote(uri))


def _listed(spark: SparkSession, paths) -> DataFrame:
    """file, bytes, modified: a row for each time that the paths name a file with a
    byte in it.  A listing; no content is read."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.format("binaryFile").load(paths).select(
        F.col("path").alias("file"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def _empty_files(listed: DataFrame, full: Iterable[str]) -> list[str]:
    """Files without a byte, for which Spark plans no task."""
    return sorted({_plain(u) for u in listed.inputFiles()} - set(full))


def feed_files(spark: SparkSession, paths) -> DataFrame:
    """The files that a feed's paths (files, folders, globs) name: file, bytes,
    modified, listed (how often the paths name it; files without a byte once)."""
    listed = _listed(spark, paths)
    full = listed.groupBy("file").agg(F.max("bytes").alias("bytes"), F.max("modified").alias("modified"),
                                      F.count(F.lit(1)).cast("int").alias("listed"))
    empty = _empty_files(listed, [r["file"] for r in full.select("file").collect()])
    none = spark.createDataFrame([(f, 0, None, 1) for f in empty], "file string, bytes long, modified timestamp, listed int")
    return full.unionByName(none)


def first_record(stream, chunk: int = 1 << 16, most: int = 1 << 24) -> str:
    """The first line of an input stream that is not blank, and nothing beyond the
    chunk that holds its end; '' where there is none."""
    held, blank = b"", b" \t\r\n\x0b\x0c"
    while len(held) < most:
        more = stream.read(chunk)
        held = (held + more).lstrip(blank) if not held.strip(blank) else held + more
        if not more or b"\n" in held:
            break
    return held.split(b"\n", 1)[0].decode("utf-8", "replace")


def _open_first(uri: str) -> str | None:
    """The first record of a file, None where pyarrow has no way to its store."""
    from pyarrow import fs
    try:
        if uri.startswith("file:"):
            system, path = fs.LocalFileSystem(), uri[5:]
        else:
            system, path = fs.FileSystem.from_uri(uri)
        with system.open_input_stream(path, compression="detect") as stream:
            return first_record(stream)
    except Exception:
        return None


def first_records(files: DataFrame) -> DataFrame:
    """The files with ``record`` (NULL: not readable here), read in tasks over the
    file list: one record a file, not the feed."""
    import pyarrow as pa

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            record = pa.array([_open_first(n) for n in batch.column("file").to_pylist()], pa.string())
            yield pa.record_batch([*batch.columns, record], names=[*batch.schema.names, "record"])

    return files.mapInArrow(read, T.StructType([*files.schema.fields, T.StructField("record", T.StringType())]))


def _header_names(spark: SparkSession, file: str, record: str | None) -> tuple[str, ...]:
    if record is None:  # a store that only Spark reads: its reader takes the first record
        names = spark.read.option("sep", "\t").option("header", True).csv(file).columns
    else:
        names = record.split("\t")
    return tuple(n.strip(WHITESPACE).strip('"').strip(WHITESPACE) for n in names)


def feed_headers(spark: SparkSession, paths, columns: Sequence[str] = FACT_COLUMNS) -> list[FeedFile]:
    """The feed's files with their column names (blanks stripped); a file without
    a byte has none.  A file without a header that holds the first expected column is
    an error.  One small row per file reaches the driver, as in Spark's own file
    listing."""
    listed = _listed(spark, paths)
    rows = first_records(listed).collect()
    times = Counter(r["file"] for r in rows)
    own = {r["file"]: r for r in rows}
    with ThreadPoolExecutor(max_workers=16) as pool:
        headers = dict(zip(own, pool.map(lambda r: _header_names(spark, r["file"], r["record"]), own.values())))
    out = [FeedFile(f, 0, None, 1, ()) for f in _empty_files(listed, own)]
    for file, r in own.items():
        header = headers[file]
        if header != ("",) and columns[0] not in header:
            raise ValueError(f"{file}: no header line with {columns[0]}")
        out.append(FeedFile(file, r["bytes"], r["modified"], times[file], () if header == ("",) else header))
    return sorted(out, key=lambda f: f.file)


def read_facts(spark: SparkSession, paths, strip_value: bool = True,
               columns: Iterable[str] = FACT_COLUMNS, file_column: str | None = None,
               files: list[FeedFile] | None = None) -> DataFrame:
    """Read a fact feed as text.

    Files, folders and globs may be mixed; files are grouped by their header
    line and each group is one scan, so part files may order their columns
    differently.  A file without a header is an error; a file listed twice is
    appended twice.  Headers come from the files' first records alone, so the
    feed is read once (``files``: what ``feed_headers`` found before).

    ``strip_value``: strip the value field too.  The state/metro feed strips
    it explicitly; the national feed's numeric read ignores surrounding
    blanks, which comes to the same, so both feeds use the default.
    ``file_column``: add the row's file under this name (U1 lineage).
    """
    columns = list(columns)
    files = feed_headers(spark, paths, columns) if files is None else files
    groups: dict[tuple, list[str]] = {}
    for f in files:
        if f.names:
            # the k-th listing of a file goes to the k-th scan of its group
            for k in range(f.listed):
                groups.setdefault((f.names, k), []).append(f.file)
    # the metadata column is an encoded URI, the listing is not
    plain = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    origin = [F.regexp_replace(plain, "^file:/+", "file:/").alias(file_column)] if file_column else []
    frames = []
    for (names, _), own in sorted(groups.items()):
        scan = (spark.read.schema(fact_schema(names)).option("sep", "\t").option("header", True)
                .option("enforceSchema", True).option("mode", "PERMISSIVE").csv(sorted(own)))
        frames.append(scan.select(*[c for c in columns if c in names], *origin))
    if not frames:
        return spark.createDataFrame([], fact_schema([*columns, *([file_column] if file_column else [])]))
    facts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    missing = [c for c in columns if c not in facts.columns]
    facts = facts.withColumns({c: F.lit(None).cast("string") for c in missing})
    stripped = {"series_id", "year", "footnote_codes"} | ({"value"} if strip_value else set())
    return facts.select(*[(strip_all(c).alias(c) if c in stripped else F.col(c)) for c in columns],
                        *([file_column] if file_column else []))


def load_report(files: list[FeedFile], facts: DataFrame, file_column: str) -> DataFrame:
    """What was loaded, one row per file of the feed: file, bytes, listed,
    rows, status ('ok', 'empty': no data row, 'listed twice': its rows count more
    than once).  ``facts`` carry their file (``read_facts(file_column=...)``, or the
    written panel's rows before any filter); they are counted by file, with
    partial counts on the map side."""
    spark = facts.sparkSession
    listing = spark.createDataFrame([(f.file, f.bytes, f.listed) for f in files], "file string, bytes long, listed int")
    rows = facts.groupBy(F.col(file_column).alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    out = listing.join(rows, "file", "left").withColumn("rows", F.coalesce("rows", F.lit(0)).cast("long"))
    return out.withColumn("status", _load_status())


def _load_status() -> Column:
    return F.when(F.col("rows") == 0, "empty").when(F.col("listed") > 1, "listed twice").otherwise("ok")


def load_by_feed(report: DataFrame, feed: Column) -> DataFrame:
    """The rows of ``load_report`` by feed, where a feed is a folder of several files:
    feed, listed, rows, status (a feed is empty where all of its files are)."""
    by = report.groupBy(feed.alias("feed")).agg(F.max("listed").alias("listed"), F.sum("rows").alias("rows"))
    return by.withColumn("status", _load_status())


@dataclass
class LookupSource:
    """S3: where lookup tables live.  ``fmt`` is any Spark source name;
    for ``jdbc`` the caller supplies ``url`` and connection properties."""

    fmt: str = "parquet"
    base: str = ""
    options: dict = field(default_factory=dict)
    url: str | None = None
    properties: dict = field(default_factory=dict)
    # JDBC only: partitioned reads by table (column, lowerBound, upperBound, numPartitions)
    partitions: dict = field(default_factory=dict)
    # JDBC only: (key column, number of parts) by table; the bounds are found from the column
    keyed: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        suffix = "" if self.fmt in ("jdbc",) else f".{self.fmt}" if self.fmt != "csv" else ".csv"
        return f"{self.base.rstrip('/')}/{name}{suffix}"


#: Prefixes of a text key that are counted to find its bounds, and their length, at most.
MAX_PREFIXES = 10_000
MAX_PREFIX = 32


def key_bounds(keys: DataFrame, column: str, parts: int) -> list:
    """Up to ``parts`` - 1 values that cut the column's rows into runs of about equal
    size: quantiles of a number or date, prefixes of a text (the shortest ones that
    are many enough, counted; at most ``MAX_PREFIXES`` reach the driver)."""
    c = F.col(column)
    if not isinstance(keys.schema[column].dataType, T.StringType):
        shares = [i / parts for i in range(1, parts)]
        cuts = keys.agg(F.percentile_approx(c, F.array(*[F.lit(x) for x in shares]), F.lit(100 * parts))).first()[0] if shares else []
        return sorted(set(cuts or []))
    lengths = range(1, MAX_PREFIX + 1)
    kinds = keys.agg(*[F.approx_count_distinct(F.substring(c, 1, n)) for n in lengths]).first()
    small = [n for n, k in zip(lengths, kinds) if k * 1.2 <= MAX_PREFIXES] or [1]
    length = next((n for n in small if kinds[n - 1] >= 16 * parts), small[-1])
    counts = keys.where(c.isNotNull()).groupBy(F.substring(c, 1, length).alias("p")).count().orderBy("p").collect()
    total, at, cuts = sum(r["count"] for r in counts), 0, []
    for r in counts:
        # before this prefix lie as many rows as the next cut asks for
        if len(cuts) < parts - 1 and at * parts >= (len(cuts) + 1) * total and at:
            cuts.append(r["p"])
            while len(cuts) < parts - 1 and at * parts >= (len(cuts) + 1) * total:
                cuts.append(r["p"])
        at += r["count"]
    return sorted(set(cuts))


def _literal(value) -> str:
    if isinstance(value, (_dt.date, _dt.datetime)):
        return f"'{value}'"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def range_predicates(column: str, bounds: Sequence) -> list[str]:
    """A WHERE clause for each run between the bounds.  Every row meets one of them:
    that of the last bound that it reaches, whatever order the database has (a
    collation may sort texts otherwise than Spark); a missing key meets the first."""
    reached = [f"{column} >= {_literal(b)}" for b in bounds]
    out = []
    for i in range(len(bounds) + 1):
        terms = reached[i - 1:i] + [f"NOT ({r})" for r in reached[i:]]
        clause = " AND ".join(terms) or "1 = 1"
        out.append(f"({column} IS NULL OR ({clause}))" if i == 0 else clause)
    return out


def read_lookup(spark: SparkSession, source: LookupSource, name: str) -> DataFrame:
    """S3: whole-table lookup read; ``source.keyed`` reads it in parallel over ranges
    whose bounds come from the key column itself."""
    if source.fmt == "jdbc":
        if name in source.keyed:
            column, parts = source.keyed[name]
            keys = spark.read.jdbc(source.url, f"(SELECT {column} FROM {name}) k", properties=dict(source.properties))
            return spark.read.jdbc(source.url, name, properties=dict(source.properties),
                                   predicates=range_predicates(column, key_bounds(keys, column, parts)))
        return spark.read.jdbc(source.url, name, properties=dict(source.properties),
                               **source.partitions.get(name, {}))
    reader = spark.read.format(source.fmt).options(**source.options)
    return reader.load(source.path(name))


def date_ref_row(spark: SparkSession, as_of: _dt.date) -> DataFrame:
    """One-row table (month, year) as text for a run date; month is the
    previous month number (0 in January)."""
    return spark.range(1).select(
        F.lit(str(as_of.month - 1)).alias("month"),
        F.lit(str(as_of.year)).alias("year"))


def date_ref_column_exprs(d: Column) -> list[Column]:
    return [(F.month(d) - 1).cast("string").alias("month"),
            F.year(d).cast("string").alias("year")]


def date_ref_from_column(df: DataFrame, date_col: str) -> DataFrame:
    """S6/X7 with the run date taken as the latest date in ``date_col``."""
    latest = df.agg(F.max(F.col(date_col)).alias("_d"))
    return latest.select(*date_ref_column_exprs(F.col("_d")))
