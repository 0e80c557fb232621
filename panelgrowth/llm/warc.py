"""WARC archives and their capture index.

Pages are written as WARC records (one gzip member each): a response with its
payload, or a revisit that refers to the response with the same payload.  Each
archive has a run of index entries (URL key, timestamp, page, file, offset,
length), sorted when the archive is closed.  Runs are dealt out by key ranges,
and in each range a loser tree merges the segments of all runs, so the whole
index is in order of URL key and timestamp: every URL's captures stand
together as its history.  Records are read back through the index by offset.

Defined results: a NULL html is the empty payload.  A NULL url has the empty
key.  Of equal payloads of at least ``MIN_REVISIT`` bytes the largest page_id is
the response (rows that repeat it are responses too), a NULL page_id is less
than any other; where all are NULL each is a response.  An empty table gives
no archive and an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import zlib
from itertools import chain
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrowth.llm.common import only, shared_folder, written
from panelgrowth.llm.files import new_name, open_in, open_out

MIN_REVISIT = 1000
#: An archive is closed beyond this many bytes or records.
ARCHIVE_BYTES = 256 << 20
ARCHIVE_RECORDS = 100_000
#: Rows of a run that the merge holds.
HEAD_ROWS = 512
#: Seconds of the first moment of the year 1 and the last of the year 9999.
FIRST_TIME, LAST_TIME = -62_135_596_800, 253_402_300_799
#: Fixed value: the profile of a revisit with an equal payload.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = "urlkey string, ts long, page_id long, run string, `offset` long, length long, kind string, digest string"
_INDEX_NAMES = ["urlkey", "ts", "page_id", "run", "offset", "length", "kind", "digest"]
_INDEX_SCHEMA = pa.schema(list(zip(_INDEX_NAMES, [
    pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()])))


def url_key(url: str | None) -> str:
    """Sort-friendly key: reversed host, then port, path and query, lower case;
    scheme, user and fragment go."""
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:]*)(:\d+)?([^#]*)", (url or "").strip(), re.I | re.S)
    if not m:
        return (url or "").strip().lower()
    host = re.sub(r"^www\d*\.", "", m[1].lower())
    port = "" if m[2] in (None, ":80", ":443") else m[2]
    return f"{','.join(reversed(host.split('.')))}{port}){m[3].lower() or '/'}"


def _header(name: str, value: str) -> bytes:
    return f"{name}: {re.sub(r'[\x00-\x1f\x7f]', lambda c: f'%{ord(c[0]):02X}', value)}\r\n".encode()


def warc_date(ts: int) -> str:
    """The date of a time in seconds; times beyond the years 1 to 9999 get their ends."""
    date = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=min(max(ts, FIRST_TIME), LAST_TIME))
    return f"{date.year:04d}-{date:%m-%dT%H:%M:%SZ}"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, ts: int,
           refers_to: int | None) -> bytes:
    """One gzip member holding a response, or a revisit where ``refers_to`` is given."""
    head = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            + f"Content-Length: {len(payload)}\r\n\r\n".encode())
    block = head + (payload if refers_to is None else b"")
    out = (b"WARC/1.1\r\n" + _header("WARC-Type", "response" if refers_to is None else "revisit")
           + _header("WARC-Record-ID", f"<urn:page:{'none' if page_id is None else page_id}>")
           + _header("WARC-Date", warc_date(ts)) + _header("WARC-Target-URI", url or "urn:none")
           + _header("WARC-Payload-Digest", f"sha1:{digest}"))
    if refers_to is not None:
        out += _header("WARC-Refers-To", f"<urn:page:{refers_to}>") + _header("WARC-Profile", PROFILE)
    out += (_header("Content-Type", "application/http; msgtype=response")
            + _header("Content-Length", str(len(block))) + b"\r\n" + block + b"\r\n\r\n")
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(out) + z.flush()


def parse(member: bytes) -> dict:
    """Fields of one record: page_id, url, type, refers_to, digest, payload
    (None for a revisit) and payload_bytes."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda x: None if x in (None, "<urn:page:none>") else int(x[10:-1])
    response = fields["WARC-Type"] == "response"
    said = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if response and said != len(payload):
        raise ValueError("payload of another length than its header says")
    digest = hashlib.sha1(payload).hexdigest() if response else fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Payload-Digest"] != f"sha1:{digest}":
        raise ValueError("payload of another digest than its header says")
    return {"page_id": number(fields["WARC-Record-ID"]), "url": fields["WARC-Target-URI"],
            "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To")),
            "payload_digest": digest, "payload": payload if response else None, "payload_bytes": said}


class LoserTree:
    """Merges sorted sequences: each step plays one path of the tree, log2(k)
    comparisons.  ``key`` gives an entry's sort key; ties go to the earlier run."""

    def __init__(self, runs: list, key):
        self.runs = [iter(r) for r in runs]
        self.key = key
        self.k = len(runs)
        self.heads: list = [None] * self.k
        for i in range(self.k):
            self._advance(i)
        self.losers = [-1] * max(self.k, 1)
        for i in range(self.k):
            self._play(i)

    def _advance(self, i: int) -> None:
        row = next(self.runs[i], None)
        # an ended run loses to all others
        self.heads[i] = (1, None, i, None) if row is None else (0, self.key(row), i, row)

    def _beats(self, a: int, b: int) -> bool:
        return self.heads[a][:3] < self.heads[b][:3] if self.heads[a][0] == self.heads[b][0] == 0 \
            else (self.heads[a][0], a) < (self.heads[b][0], b)

    def _play(self, i: int) -> None:
        node = (i + self.k) // 2
        while node > 0:
            if self.losers[node] == -1:  # the first to arrive waits for its opponent
                self.losers[node] = i
                return
            if self._beats(self.losers[node], i):
                self.losers[node], i = i, self.losers[node]
            node //= 2
        self.losers[0] = i

    def __iter__(self) -> Iterator:
        while self.k:
            i = self.losers[0]
            if self.heads[i][0]:
                return
            yield self.heads[i][3]
            self._advance(i)
            node = (i + self.k) // 2
            while node > 0:
                if self._beats(self.losers[node], i):
                    self.losers[node], i = i, self.losers[node]
                node //= 2
            self.losers[0] = i


def _order(row: tuple) -> tuple:
    """Index order: URL key, timestamp, page (NULL first)."""
    return row[0].encode(), row[1], row[2] is not None, row[2] or 0


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, ts, digest, refers_to (NULL: a response)."""
    kind = pages.schema["ts"].dataType if "ts" in pages.columns else None
    seconds = F.lit(None)
    if isinstance(kind, (T.NumericType, T.TimestampType)):
        seconds = F.col("ts").try_cast("long")
    p = only(pages.withColumn("ts", seconds.cast("long")), page_id=("page_id", "long"), url=("url", "string"),
             html=("html", "string"), ts=("ts", "long"))
    p = (p.withColumn("html", F.coalesce("html", F.lit(""))).withColumn("digest", F.sha1("html"))
         .withColumn("ts", F.coalesce("ts", F.greatest("page_id", F.lit(0)), F.lit(0))))
    # one row per repeated payload; a hot one is reduced before the shuffle
    first = (p.where(F.octet_length("html") >= min_bytes).groupBy("digest")
             .agg(F.max("page_id").alias("_response"), F.count(F.lit(1)).alias("_n"))
             .where("_n > 1").drop("_n"))
    j = p.join(first, "digest", "left")
    return j.withColumn("refers_to", F.when(
        (F.octet_length("html") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("_response")),
        F.col("_response"))).drop("_response")


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_REVISIT) -> tuple[str, DataFrame]:
    """Writes the archives; returns their folder and the sorted runs of index
    entries.  ``pages`` may have a ``ts`` column (seconds as a number, or a
    timestamp); without one, or where it is NULL, the page id stands for it."""
    folder = folder or shared_folder(pages.sparkSession, "warc")
    rows = with_revisits(pages, min_bytes).select("page_id", "url", "html", "ts", "digest", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, run, at = None, "", [], 0

        def closed() -> pa.RecordBatch:
            out.close()
            run.sort(key=_order)  # the archive's run
            return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*run), _INDEX_SCHEMA.types)],
                                   schema=_INDEX_SCHEMA)

        for batch in batches:
            for page_id, url, html, ts, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, run, at = new_name("archive", ".warc.gz"), [], 0
                    out = open_out(folder, name)
                member = record(page_id, url, html.encode(), digest, ts, refers_to)
                out.write(member)
                run.append((url_key(url), ts, page_id, name, at, len(member),
                            "response" if refers_to is None else "revisit", digest))
                at += len(member)
                if at >= ARCHIVE_BYTES or len(run) >= ARCHIVE_RECORDS:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    return folder, written(rows.mapInArrow(write, INDEX), "warc-runs")


def merge_index(runs: DataFrame, folder: str | None = None) -> DataFrame:
    """The runs merged into one index in order of URL key, timestamp and page:
    partition after partition, and inside each.  A key's many captures may lie
    in several partitions, split by timestamp and page.

    A task spools the segments of its range, run after run, to a file in the shared
    folder and merges them from there: of each run it holds ``HEAD_ROWS`` rows."""
    n = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    folder = folder or shared_folder(runs.sparkSession, "warc-segments")
    keys = ["urlkey", "ts", "page_id"]
    dealt = runs.repartitionByRange(n, *keys).sortWithinPartitions("run", *keys)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        name = new_name("segments", ".arrow")
        with open_out(folder, name) as out:
            segments = spool(chain([first], batches), out)
        out = []
        with open_in(folder, name) as source:
            file = pa.ipc.open_file(source)
            for row in LoserTree([rows_of(file, own) for own in segments], _order):
                out.append(row)
                if len(out) == 8192:
                    yield _batch(out)
                    out = []
        if out:
            yield _batch(out)

    return dealt.mapInArrow(merge, INDEX)


def spool(batches: Iterator[pa.RecordBatch], out) -> list[list[int]]:
    """Writes rows that come run after run; the numbers of each run's batches."""
    segments: list[list[int]] = []
    last, n = None, 0
    with pa.ipc.new_file(out, _INDEX_SCHEMA) as file:
        for batch in batches:
            names = batch.column(3).to_pylist()
            at = 0
            while at < len(names):
                end = at + 1
                while end < len(names) and names[end] == names[at] and end - at < HEAD_ROWS:
                    end += 1
                if names[at] != last:
                    segments.append([])
                    last = names[at]
                part = batch.slice(at, end - at)
                file.write_batch(pa.record_batch([c.cast(t) for c, t in zip(part.columns, _INDEX_SCHEMA.types)],
                                                 schema=_INDEX_SCHEMA))
                segments[-1].append(n)
                at, n = end, n + 1
    return segments


def rows_of(file, numbers: list[int]) -> Iterator[tuple]:
    """The rows of a spooled run, a batch at a time."""
    for k in numbers:
        yield from zip(*(c.to_pylist() for c in file.get_batch(k).columns))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _INDEX_SCHEMA.types)], schema=_INDEX_SCHEMA)


def read_records(folder: str, index: DataFrame, payload: bool = False) -> DataFrame:
    """The records of the index entries: page_id, payload_bytes,
    payload_digest, record_type, refers_to (and payload)."""
    ddl = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names = [x.split()[0] for x in ddl.split(", ")] + ["payload"] * payload
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()][:len(names)]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = sorted(zip(*(batch.column(c).to_pylist() for c in ("run", "offset", "length"))))
            out, name, source = [], None, None
            for run, offset, length in rows:
                if run != name:
                    if source is not None:
                        source.close()
                    name, source = run, open_in(folder, run)
                source.seek(offset)
                r = parse(source.read(length))
                out.append(tuple(r[c] for c in names))
            if source is not None:
                source.close()
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    return index.mapInArrow(read, ddl + ", payload binary" * payload)


def archive_digest(pages: DataFrame) -> DataFrame:
    """Writes the archives, merges their index and reads every record through it."""
    folder, runs = write_archives(pages)
    index = written(merge_index(runs), "warc-index")
    return read_records(folder, index)
