"""Sections on their own, unknown names, feed folders with differing headers, bounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelgrowth.functions.clean import lenient_double
from panelgrowth.operators.enrich import within_bounds
from panelgrowth.plans import reports as R
from panelgrowth.sources.feeds import read_facts

PANEL = ("area_name string, state_name string, supersector_name string, industry_name string, Month string, "
         "year string, value double, data_type_code string, seasonal string")


def _panel(spark):
    rows = [(area, "S1", "A", "Total Nonfarm", f"{m:02d}", "2020", 10.0 * m, "01", s)
            for area in ("Statewide", "Town") for m in range(1, 13) for s in "US"]
    return spark.createDataFrame(rows, PANEL)


def test_one_section_alone_gives_its_rows(spark):
    panel, day = _panel(spark), dt.date(2021, 3, 1)
    both = R.run(panel, None, day, ["states", "msa"]).tables
    states, metros = R.run(panel, None, day, ["states"]).tables, R.run(panel, None, day, ["msa"]).tables
    assert list(states) == ["state_rankings"] and list(metros) == ["msa_rankings"]
    counts = states["state_rankings"].count(), metros["msa_rankings"].count()
    assert min(counts) > 0 and sum(counts) == both["state_rankings"].count()


def test_unknown_section_is_an_error(spark):
    with pytest.raises(ValueError, match="typo"):
        R.run(_panel(spark), None, dt.date(2021, 3, 1), ["states", "typo"])


def test_folder_of_files_with_differing_headers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("series_id \tyear\tperiod\tvalue\tfootnote_codes\nS1 \t2001\tM01\t 5\t\n")
    (tmp_path / "b.txt").write_text("year\tseries_id\tvalue\tperiod\textra\n2002\tS2\t7\tM02\tx\n")
    want = [("S1", "2001", "M01", "5"), ("S2", "2002", "M02", "7")]
    for paths in (str(tmp_path), f"{tmp_path}/*.txt", [f"{tmp_path}/a.txt", f"{tmp_path}/b.txt"]):
        assert sorted(tuple(r)[:4] for r in read_facts(spark, paths).collect()) == want


def test_file_without_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.txt").write_text("series_id\tyear\tperiod\tvalue\tfootnote_codes\nS1\t2001\tM01\t5\t\n")
    (tmp_path / "b.txt").write_text("S1\t2001\tM01\t5\t\n")
    with pytest.raises(ValueError, match="no header"):
        read_facts(spark, str(tmp_path))


def test_numbers_beyond_a_double_are_null(spark):
    df = spark.createDataFrame([("1e400",), ("-1e400",), ("2.5",), ("NaN",)], "v string")
    assert [r[0] for r in df.select(lenient_double("v")).collect()] == [None, None, 2.5, None]


def test_broadcast_bounds(spark):
    df = spark.range(100).select("id", F.lit("x" * 100).alias("t"))
    assert within_bounds(df) and not within_bounds(df, max_rows=99) and not within_bounds(df, max_bytes=1000)
