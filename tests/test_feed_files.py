"""Headers from first records, lineage, key ranges."""

import datetime as dt
import gzip
import io
import json
import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from panelgrowth.sources import feeds
from panelgrowth.sources.feeds import (
    feed_files, feed_headers, first_record, key_bounds, load_report, range_predicates, read_facts,
)

HEAD = "series_id\tyear\tperiod\tvalue\tfootnote_codes"


def write(path, lines):
    path.write_text("".join(x + "\n" for x in lines))
    return str(path)


def lines(n, tag):
    return [f"{tag}{i}  \t2001\tM01\t  {i}.5\t" for i in range(n)]


def test_first_record_reads_no_further():
    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            Counted.taken += len(out)
            return out

    s = Counted(("  \n\r\n" + HEAD + "\r\n" + "x" * 10_000_000).encode())
    assert first_record(s, chunk=1024).strip() == HEAD and Counted.taken <= 2048
    assert first_record(io.BytesIO(b"")) == "" and first_record(io.BytesIO(b"\n \n")) == ""
    assert first_record(io.BytesIO(b"only line")) == "only line"
    wide = "\t".join(f"column{i}" for i in range(500))
    assert first_record(io.BytesIO((wide + "\nrest").encode()), chunk=16) == wide


def test_mixed_headers_compression_and_names(spark, tmp_path):
    odd = tmp_path / "a b+c%20d.txt"
    write(odd, [HEAD, *lines(3, "A")])
    write(tmp_path / "swapped.txt", ["value\textra\tperiod \t year\t series_id", "7.5\tz\tM02\t2002\tB1"])
    with gzip.open(tmp_path / "packed.txt.gz", "wt") as f:
        f.write(HEAD + "\nC1\t2003\tM03\t9\tP\n")
    (tmp_path / "empty.txt").write_text("")
    got = sorted(tuple(r) for r in read_facts(spark, str(tmp_path), file_column="src").collect())
    at = lambda n: f"file:{tmp_path}/{n}"
    assert got == [("A0", "2001", "M01", "0.5", None, at("a b+c%20d.txt")), ("A1", "2001", "M01", "1.5", None, at("a b+c%20d.txt")),
                   ("A2", "2001", "M01", "2.5", None, at("a b+c%20d.txt")), ("B1", "2002", "M02", "7.5", None, at("swapped.txt")),
                   ("C1", "2003", "M03", "9", "P", at("packed.txt.gz"))]


def test_a_file_without_a_header_is_an_error(spark, tmp_path):
    write(tmp_path / "good.txt", [HEAD, *lines(2, "A")])
    write(tmp_path / "bad.txt", lines(2, "B"))
    with pytest.raises(ValueError, match="bad.txt: no header line"):
        read_facts(spark, str(tmp_path))


def test_stores_that_only_spark_reads(spark, tmp_path, monkeypatch):
    a = write(tmp_path / "a.txt", [" series_id \tyear\tperiod\tvalue", "A1\t2001\tM01\t1"])
    monkeypatch.setattr(feeds, "first_records", lambda files: files.withColumn("record", F.lit(None).cast("string")))
    assert [f.names for f in feed_headers(spark, a)] == [("series_id", "year", "period", "value")]
    assert [tuple(r) for r in read_facts(spark, a).collect()] == [("A1", "2001", "M01", "1", None)]


def test_listing_and_load_report(spark, tmp_path):
    a, b = write(tmp_path / "a.txt", [HEAD, *lines(4, "A")]), write(tmp_path / "b.txt", [HEAD])
    c = tmp_path / "c.txt"
    c.write_text("")
    listed = {os.path.basename(r["file"]): r["listed"] for r in feed_files(spark, [a, b, a, str(c)]).collect()}
    assert listed == {"a.txt": 2, "b.txt": 1, "c.txt": 1}
    files = feed_headers(spark, [a, b, a, str(c)])
    facts = read_facts(spark, [a, b, a, str(c)], file_column="src", files=files)
    assert facts.count() == 8  # UNION ALL
    got = {os.path.basename(r["file"]): (r["rows"], r["status"]) for r in load_report(files, facts, "src").collect()}
    assert got == {"a.txt": (8, "listed twice"), "b.txt": (0, "empty"), "c.txt": (0, "empty")}
    assert read_facts(spark, str(c), file_column="src").columns[-1] == "src"


def test_the_feed_is_read_once(tmp_path):
    """Bytes that Spark's tasks read, from the event log, against the feed's."""
    feed, log = tmp_path / "feed", tmp_path / "log"
    feed.mkdir()
    log.mkdir()
    for k in range(3):
        write(feed / f"f{k}.txt", [HEAD, *lines(20_000, f"S{k}-")])
    code = f"""
        from panelgrowth.session import get_spark
        from panelgrowth.sources.feeds import read_facts
        spark = get_spark("local[2]", 2, conf={{"spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://{log}",
            "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.driver.memory": "1g"}})
        assert read_facts(spark, "{feed}").selectExpr("count(value)", "max(series_id)").first()[0] == 60000
        spark.stop()
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, timeout=300, cwd=tmp_path,
                   env=os.environ | {"PYTHONPATH": root})
    read = 0
    for f in log.iterdir():
        for line in f.read_text().splitlines():
            e = json.loads(line)
            if e["Event"] == "SparkListenerTaskEnd":
                read += e["Task Metrics"]["Input Metrics"]["Bytes Read"]
    size = sum(f.stat().st_size for f in feed.iterdir())
    assert size <= read < 1.2 * size


def _parts(df, column, n):
    preds = range_predicates(column, key_bounds(df, column, n))
    # each row meets one of them
    hit = sum((F.coalesce(F.expr(p).cast("int"), F.lit(0)) for p in preds), F.lit(0))
    assert df.where(hit != 1).count() == 0
    return [df.where(p).count() for p in preds]


def test_key_ranges(spark):
    text = spark.range(4000).selectExpr("concat('SMU', lpad(cast(id * 7 as string), 8, '0'), 'x''y') AS k")
    sizes = _parts(text, "k", 8)
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)
    skewed = text.unionByName(spark.range(4000).selectExpr("'SMU00000000hot' AS k")).unionByName(spark.range(9).selectExpr("cast(null AS string) AS k"))
    assert sum(_parts(skewed, "k", 4)) == 8009
    numbers = spark.range(1000).selectExpr("id * id AS k").unionByName(spark.range(1).selectExpr("cast(null AS long) AS k"))
    sizes = _parts(numbers, "k", 5)
    assert len(sizes) == 5 and max(sizes) < 1.3 * min(sizes)
    days = spark.range(100).selectExpr("date_add(date'2001-01-01', cast(id AS int)) AS k")
    assert len(_parts(days, "k", 4)) == 4
    assert _parts(text.where("false"), "k", 4) == [0] and _parts(numbers.where("false"), "k", 4) == [0]
    assert _parts(numbers, "k", 1) == [1001]


def test_predicates():
    assert range_predicates("k", []) == ["(k IS NULL OR (1 = 1))"]
    assert range_predicates("k", ["b", "d'e"]) == [
        "(k IS NULL OR (NOT (k >= 'b') AND NOT (k >= 'd''e')))", "k >= 'b' AND NOT (k >= 'd''e')", "k >= 'd''e'"]
    assert range_predicates("k", [dt.date(2001, 2, 3), 5])[2] == "k >= 5"


def test_predicates_hold_in_another_order():
    # a database that folds case sorts the bounds otherwise: still one clause a row
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT unnest(['a', 'B', 'b', 'C', 'd', NULL]) AS k")
    bounds = ["B", "C", "a", "b"]  # in binary order
    hits = " + ".join(f"coalesce(({p.replace('k >=', 'lower(k) >=').replace(chr(39) + 'B', chr(39) + 'b').replace(chr(39) + 'C', chr(39) + 'c')})::INT, 0)"
                      for p in range_predicates("k", bounds))
    assert {r[0] for r in con.execute(f"SELECT {hits} FROM t").fetchall()} == {1}
