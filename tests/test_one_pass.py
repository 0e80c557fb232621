"""The sections come from one pass over the facts; large cohorts stay dealt out."""

import datetime as dt

from panelgrowth.operators import enrich
from panelgrowth.plans import fused, reports as R
from panelgrowth.sinks.writers import SinkTarget, write_reports

PANEL = ("area_name string, state_name string, supersector_name string, industry_name string, "
         "Month string, year string, value double, seasonal string")
AS_OF = dt.date(2001, 3, 1)


def _panel(spark, tmp_path):
    rows = [(a, s, "ss", ind, f"{m:02d}", "2001", float(m + len(a or "")), fl)
            for a, s in (("Statewide", "X"), ("M1", "X"), ("M1", "Y"), ("Metro2", "Y"), (None, "Y"))
            for ind in ("Total Nonfarm", "Mining", None) for m in range(1, 13) for fl in ("U", "S")]
    path = str(tmp_path / "panel")
    spark.createDataFrame(rows, PANEL).write.parquet(path)
    return spark.read.parquet(path), path


def test_written_cells_feed_all_levels(spark, tmp_path):
    panel, path = _panel(spark, tmp_path)
    kept = []

    def keep(df, label, **how):
        kept.append((label, any(path in f for f in df.inputFiles())))
        return fused.materialize(df, label, **how)

    levels = fused.state_metro_sections(panel, 2, 10.0, 12.0, rank_strategy="auto", keep=keep)
    # the facts are read for the cells alone
    assert kept == [("entity_cells", True), ("state_metro_metrics", False)]
    assert not any(path in f for f in R.metro_over_report(panel, AS_OF, threshold=10.0).inputFiles())
    want = {"state": R.state_report(panel, AS_OF), "msa": R.metro_report(panel, AS_OF),
            "under": R.metro_under_report(panel, AS_OF, threshold=12.0),
            "over": R.metro_over_report(panel, AS_OF, threshold=10.0)}
    for level, df in want.items():
        rows = sorted(map(repr, df.collect()))
        assert rows and sorted(map(repr, levels[level].collect())) == rows, level


def test_combined_table_from_one_aggregation(spark, tmp_path):
    panel, path = _panel(spark, tmp_path)
    got = fused.combined_section(panel, AS_OF)
    want = R.combined_report(R.state_report(panel, AS_OF), R.metro_report(panel, AS_OF))
    plan = got._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert got.columns == want.columns and sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_large_cohorts_are_dealt_out_by_the_series(spark, tmp_path, monkeypatch):
    panel, _ = _panel(spark, tmp_path)
    want = sorted(map(repr, R.metro_over_report(panel, AS_OF, threshold=10.0).collect()))
    monkeypatch.setattr(enrich, "within_bounds", lambda *a, **b: False)
    df = R.metro_over_report(panel, AS_OF, threshold=10.0)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(area_name" in plan and "REPARTITION_BY_COL" in plan
    assert sorted(map(repr, df.collect())) == want


def test_national_index_follows_the_names_before_clean_up(spark, tmp_path):
    rows = [("A", "X", ss, "Mining", f"{m:02d}", "2001", 1.0, fl)
            for ss in ("Goods-Producing", "Goods Producing\r") for m in (1, 2, 3) for fl in ("U", "S")]
    report = R.national_report(spark.createDataFrame(rows, PANEL), AS_OF, raw_keys=True)
    target = SinkTarget("parquet", str(tmp_path))
    write_reports({"national_rankings_t": report}, target, index=True)
    got = spark.read.parquet(target.path("national_rankings_t")).orderBy("index")
    assert got.columns == ["index", *R.NATIONAL_COLUMNS]
    assert [(r["index"], r["supersector_name"], r["Month"]) for r in got.collect()] == [
        (i, "Goods Producing", f"{m:02d}") for i, m in enumerate((1, 2, 3, 1, 2, 3))]
