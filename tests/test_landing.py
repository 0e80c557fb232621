"""The analog landing: lines joined to their orders once, written once, not sorted;
the load report over feeds of several files."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelgrowth.sinks.writers import OPEN_FILES, materialize


@pytest.fixture
def tables(spark, tmp_path):
    """Small tables: two orders of one key, an order without lines, lines without an
    order, lines without a flag, a status or a supplier."""
    def write(name, rows, schema, files=1):
        spark.createDataFrame(rows, schema).repartition(files).write.parquet(f"{tmp_path}/{name}.parquet")

    write("region", [(0, "ASIA"), (1, "EUROPE")], "r_regionkey int, r_name string")
    write("nation", [(0, "CHINA", 0), (1, "FRANCE", 1)], "n_nationkey int, n_name string, n_regionkey int")
    write("customer", [(1, 0, "BUILDING"), (2, 1, "MACHINERY"), (3, 1, None)],
          "c_custkey long, c_nationkey int, c_mktsegment string")
    write("orders", [(1, 1), (2, 2), (2, 1), (3, 3), (4, 2)], "o_orderkey long, o_custkey long")
    lines = [(o, n, s, float(n), f, x, dt.datetime(2000, 1 + n, 1)) for o, s, f, x in (
        (1, 2, "N", "O"), (2, 3, "R", "F"), (3, 5, "A", "O"), (9, 4, "N", "F"), (2, None, None, "F"), (1, 7, "N", None))
        for n in range(1, 8)]
    write("lineitem", lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_quantity double, "
          "l_returnflag string, l_linestatus string, l_shipdate timestamp", files=3)
    return str(tmp_path)


def test_lines_are_joined_and_written_once(spark, tables, monkeypatch):
    from panelgrowth.plans import job
    from panelgrowth.sources.analog import analog_feeds, write_analog_landing
    from panelgrowth.sources.feeds import read_facts
    written = []

    def record(df, label, **how):
        written.append((df, materialize(df, label, **how)))
        return written[-1][1]

    monkeypatch.setattr(job, "materialize", record)
    base, lookups = write_analog_landing(spark, tables)
    assert len(written) == 1
    plan = written[0][0]._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
    # the feeds and lookups hold what the tables give
    feeds, paths = analog_feeds(spark, tables), job.feed_paths(base)
    for feed, own in (("sm_facts", paths["sm"]), ("ce_facts", paths["ce"])):
        want = feeds[feed].select(F.trim("series_id"), "year", "period", F.trim("value"), "footnote_codes")
        got = read_facts(spark, own)
        assert want.count() == 49 and got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    for name, df in feeds.items():
        if not name.endswith("_facts"):
            got = spark.read.parquet(lookups.path(name)).select(*df.columns)
            assert got.exceptAll(df).count() == df.exceptAll(got).count() == 0


def test_few_parts_are_written_without_a_sort(spark):
    df = spark.range(0, 4000, numPartitions=2).select(F.col("id"), (F.hash("id") % 5).alias("part"))
    before = spark.conf.get(OPEN_FILES, None)
    back = materialize(df, "parts", partition_by=["part"])
    assert spark.conf.get(OPEN_FILES, None) == before
    assert back.columns == ["id", "part"] and back.exceptAll(df).count() == df.exceptAll(back).count() == 0
    # beyond the bound on open files a task sorts its rest
    many = spark.range(0, 4000, numPartitions=2).select(F.col("id"), (F.hash("id") % 50).alias("part"))
    back = materialize(many, "parts", partition_by=["part"])
    assert back.exceptAll(many).count() == many.exceptAll(back).count() == 0
