"""Plan checks: no Python UDF, partitioned windows, expected shuffles."""

import datetime as dt

from panelgrowth.plans import reports as R

PANEL = ("area_name string, state_name string, supersector_name string, industry_name string, "
         "Month string, year string, value double, seasonal string, size double")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _panel(spark, tmp_path):
    rows = [(a, s, "ss", ind, f"{m:02d}", str(y), float(m + y % 7), fl, 1.0)
            for a, s in (("Statewide", "X"), ("Statewide", "Y"), ("M1", "X"), ("M2", "Y"))
            for ind in ("Total Nonfarm", "Mining") for y in (2000, 2001) for m in range(1, 13)
            for fl in ("U", "S")]
    path = str(tmp_path / "panel.parquet")
    spark.createDataFrame(rows, PANEL).write.parquet(path)
    return spark.read.parquet(path)


def test_sections_have_no_python_and_three_exchanges(spark, tmp_path):
    panel = _panel(spark, tmp_path)
    as_of = dt.date(2001, 3, 1)
    for df in (R.state_report(panel, as_of), R.metro_report(panel, as_of),
               R.metro_under_report(panel, as_of), R.national_report(panel, as_of)):
        plan = _plan(df)
        for py in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
            assert py not in plan
        assert "SinglePartition" not in plan
        # cell aggregation, series window, peer window (nation: no peer window)
        assert plan.count("Exchange hashpartitioning") <= 3
        assert "PartialAggregate" in plan or "HashAggregate" in plan


def test_pushdown_reaches_scan(spark, tmp_path):
    panel = _panel(spark, tmp_path)
    plan = _plan(R.state_report(panel, dt.date(2001, 3, 1)))
    assert "PushedFilters: [IsNotNull(area_name), EqualTo(area_name,Statewide)" in plan or \
        "EqualTo(area_name,Statewide)" in plan
    assert "size" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_over_cohort_semi_join(spark, tmp_path):
    panel = _panel(spark, tmp_path)
    plan = _plan(R.metro_over_report(panel, dt.date(2001, 3, 1), threshold=5.0))
    assert "LeftSemi" in plan


def test_feed_path_broadcasts_lookups_and_shuffles_three_times(spark):
    import __spark_entry__ as E
    df = E.queries()["feed_state_report"](spark, "/root/testdata/sf0.001")
    df.write.format("noop").mode("overwrite").save()
    plan = _plan(df)
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 5
    assert plan.count("Exchange hashpartitioning") == 3


def test_cohort_lists_are_broadcast_and_series_exchange_is_full_key(spark, tmp_path):
    from panelgrowth.plans.fused import fused_metrics
    panel = _panel(spark, tmp_path)
    over = R.metro_over_report(panel, dt.date(2001, 3, 1), threshold=5.0)
    over.write.format("noop").mode("overwrite").save()
    assert "BroadcastHashJoin" in _plan(over) and "LeftSemi" in _plan(over)
    fused = fused_metrics(panel, 2, over_threshold=5.0, under_threshold=10.0)
    fused.write.format("noop").mode("overwrite").save()
    plan = _plan(fused)
    assert "SortMergeJoin" not in plan
    # the series window's exchange hashes the whole series key
    assert any("Exchange hashpartitioning(level" in line and "entity" in line and "supersector_name" in line
               and "industry_name" in line and "year" not in line.split("hashpartitioning(")[1].split(")")[0]
               for line in plan.splitlines())
