import hashlib
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelgrowth.llm.warc import (
    LoserTree, archive_digest, merge_index, parse, read_records, record, rows_of, spool, url_key, write_archives,
)


def _pages(spark):
    big = "x" * 1500
    rows = [(i, f"http://www.Host{i % 5}.example.com:80/p/{i % 7}?q#f", f"<html>{i}</html>" + "é" * i) for i in range(60)]
    rows += [(100, None, big), (101, "http://a.b/\r\nX: y", big), (102, "ftp:nothing", big), (102, "u", big), (103, "u", "small"),
             (104, "u", "small"), (105, "u", None), (106, "u", ""), (None, "u", big), (107, "u", "y" * 999), (108, "u", "y" * 999),
             (None, "v", "z" * 1000), (None, "v", "z" * 1000), (109, "u", "é" * 500), (110, "u", "é" * 500)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return rows, df.selectExpr("*", "1 AS digest", "'x' AS refers_to", "0 AS run")


def _expected(rows):
    last = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000:
            old = last.get(b)
            last[b] = p if old is None else max(old, p if p is not None else old)
    out = []
    for p, _, h in rows:
        b = (h or "").encode()
        r = last.get(b)
        ref = r if r is not None and p != r else None
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "response" if ref is None else "revisit", ref))
    return sorted(out, key=str)


def test_digest(spark):
    rows, df = _pages(spark)
    assert sorted((tuple(r) for r in archive_digest(df).collect()), key=str) == _expected(rows)


def test_index_is_in_order_and_finds_payloads(spark):
    rows, df = _pages(spark)
    folder, runs = write_archives(df)
    index = merge_index(runs)
    got = index.rdd.map(lambda r: (r["urlkey"].encode(), r["ts"], r["page_id"] is not None, r["page_id"] or 0)).collect()
    assert got == sorted(got) and len(got) == len(rows)
    read = read_records(folder, index.where("kind = 'response'"), payload=True).collect()
    have = {(h or "").encode() for _, _, h in rows}
    assert {bytes(r["payload"]) for r in read} == have


def test_record_round_trip():
    r = parse(record(7, "http://x/\n", b"\r\n\r\npay\r\nload", hashlib.sha1(b"\r\n\r\npay\r\nload").hexdigest(), 1, None))
    assert r["payload"] == b"\r\n\r\npay\r\nload" and r["page_id"] == 7 and r["url"] == "http://x/%0A"
    r = parse(record(8, None, b"abc", hashlib.sha1(b"abc").hexdigest(), 1, 7))
    assert (r["record_type"], r["refers_to"], r["payload"], r["payload_bytes"]) == ("revisit", 7, None, 3)


def test_any_page_id_and_time(spark):
    rows = [(10**12, "u", "a"), (1 << 62, "u", "b"), (-(1 << 62), "u", "c" * 1200), (5, "u", "c" * 1200), (None, "u", "d")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert sorted((tuple(r) for r in archive_digest(df).collect()), key=str) == _expected(rows)


@pytest.mark.parametrize("ts", ["'2024-01-02T03:04:05Z'", "array(1)", "double('NaN')", "1e300D", "-9e18D",
                                "timestamp'2024-01-02 03:04:05'", "cast(null as int)", "12.7BD"])
def test_a_column_named_ts_of_any_type(spark, ts):
    rows, df = _pages(spark)
    df = df.withColumn("ts", F.expr(ts))
    assert sorted((tuple(r) for r in archive_digest(df).collect()), key=str) == _expected(rows)


def test_merge_holds_a_batch_of_each_run():
    from panelgrowth.llm import warc
    rng = random.Random(5)
    runs = [sorted((f"k{rng.randint(0, 99):02d}", rng.randint(0, 9), i, f"run{r}", 0, 1, "response", "d") for i in range(2000))
            for r in range(4)]
    sink = pa.BufferOutputStream()
    parts = spool(iter([warc._batch(x[i:i + 700]) for x in runs for i in range(0, 2000, 700)]), sink)
    file, read = pa.ipc.open_file(sink.getvalue()), []

    class Counted:
        def get_batch(self, k):
            read.append(k)
            return file.get_batch(k)

    tree = iter(LoserTree([rows_of(Counted(), own) for own in parts], warc._order))
    next(tree)
    assert len(read) == 4 and all(file.get_batch(k).num_rows <= warc.HEAD_ROWS for k in read)
    assert [warc._order(r) for r in tree] == sorted(warc._order(r) for x in runs for r in x)[1:]


def test_loser_tree():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted((rng.randint(0, 20), i) for _ in range(rng.randint(0, 30))) for i in range(k)]
        assert list(LoserTree(runs, lambda x: x[0])) == sorted((x for r in runs for x in r), key=lambda x: x)


def test_url_key():
    assert url_key("https://www.Example.com:443/A?b#c") == "com,example)/a?b"
    assert url_key("http://u:p@x.org") == "org,x)/" and url_key(None) == ""


def test_empty(spark):
    _, df = _pages(spark)
    assert archive_digest(df.where("page_id < 0")).count() == 0
