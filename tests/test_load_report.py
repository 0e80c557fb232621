"""The load report over feeds of several files."""

import datetime as dt
from pathlib import Path

from pyspark.sql import functions as F

from panelgrowth.sources.feeds import load_by_feed


def _lineitem(spark, folder, statuses, files):
    rows = [(i, 1, 3.0, s, dt.datetime(2001, 2, 3)) for i, s in enumerate(statuses)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_quantity double, l_linestatus string, "
                          "l_shipdate timestamp").repartition(files).write.parquet(f"{folder}/lineitem.parquet")


def test_no_task_writes_a_whole_feed(spark, tmp_path, monkeypatch):
    import __spark_entry__ as E
    _lineitem(spark, tmp_path, "OF" * 600 + "O", 4)
    # no file is put together with another in one task
    monkeypatch.setattr(E, "analog_feed_text", lambda s, d, f=E.analog_feed_text: f(s, d).repartition(4))
    paths, write = [], E.write_feed_tsv
    monkeypatch.setattr(E, "write_feed_tsv", lambda df, path, **how: (paths.append(path), write(df, path, **how)))
    got = sorted(tuple(r) for r in E.q_feed_load_report(spark, str(tmp_path)).collect())
    assert got == [("none", 1, 0, "empty"), ("open", 2, 1202, "listed twice"), ("shipped", 1, 600, "ok")]
    for path in paths:
        assert len(list(Path(path.removeprefix("file:")).glob("part-*.csv"))) == 4


def test_a_feed_without_rows_is_empty(spark, tmp_path):
    import __spark_entry__ as E
    _lineitem(spark, tmp_path, "FFF", 2)
    got = sorted(tuple(r) for r in E.q_feed_load_report(spark, str(tmp_path)).collect())
    assert got == [("none", 1, 0, "empty"), ("open", 2, 0, "empty"), ("shipped", 1, 3, "ok")]


def test_load_by_feed(spark):
    report = spark.createDataFrame(
        [("a/1", 10, 1, 5, "ok"), ("a/2", 0, 1, 0, "empty"), ("b/1", 9, 2, 4, "listed twice"), ("c/1", 9, 2, 0, "empty")],
        "file string, bytes long, listed int, rows long, status string")
    got = load_by_feed(report, F.substring("file", 1, 1))
    assert got.columns == ["feed", "listed", "rows", "status"]
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", 1, 5, "ok"), ("b", 2, 4, "listed twice"), ("c", 2, 0, "empty")]
