"""U/S pairing (A1-A7, J3, J4) and cohorts."""

from panelgrowth.operators.pairing import over_cohort, paired_sums, single_sums, under_rows

PANEL = ("area_name string, state_name string, supersector_name string, industry_name string, "
         "Month string, year string, value double, seasonal string")
KEYS = ["area_name", "supersector_name", "industry_name", "year", "Month"]


def _panel(spark, rows):
    return spark.createDataFrame(rows, PANEL)


def test_left_and_inner_pairing(spark):
    rows = [("A", "s", "ss", "TN", "01", "2001", 5.0, "U"),
            ("A", "s", "ss", "TN", "01", "2001", 2.0, "U"),
            ("A", "s", "ss", "TN", "01", "2001", 7.0, "S"),
            ("A", "s", "ss", "TN", "02", "2001", 4.0, "U"),          # no S row
            ("A", "s", "ss", "TN", "03", "2001", 9.0, "S"),          # no U row
            (None, "s", "ss", "TN", "01", "2001", 100.0, "U")]       # NULL key dropped
    left = {(r["Month"]): (r["value"], r["value_mom"])
            for r in paired_sums(_panel(spark, rows), KEYS, "left").collect()}
    assert left == {"01": (7.0, 7.0), "02": (4.0, None)}
    inner = paired_sums(_panel(spark, rows), KEYS, "inner").collect()
    assert [(r["Month"], r["value"], r["value_mom"]) for r in inner] == [("01", 7.0, 7.0)]


def test_pairing_equals_two_sums_and_join(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.choice("ABC"), "s", "ss", rnd.choice(["TN", "X"]), f"{rnd.randint(1, 4):02d}", "2001",
             float(rnd.randint(1, 9)), rnd.choice("US")) for _ in range(300)]
    df = _panel(spark, rows)
    u = df.filter("seasonal = 'U'").groupBy(*KEYS).sum("value").withColumnRenamed("sum(value)", "value")
    s = df.filter("seasonal = 'S'").groupBy(*KEYS).sum("value").withColumnRenamed("sum(value)", "value_mom")
    want = sorted(tuple(r) for r in u.join(s, KEYS, "left").select(*KEYS, "value", "value_mom").collect())
    got = sorted(tuple(r) for r in paired_sums(df, KEYS, "left").collect())
    assert got == want


def test_cohort_thresholds(spark):
    rows = [("Big", "s", "ss", "Total Nonfarm", "01", "2001", 1200.0, "S"),
            ("Big", "s", "ss", "Total Nonfarm", "02", "2001", 900.0, "S"),
            ("Big", "s", "ss", "Mining", "01", "2001", 5.0, "S"),
            ("Edge", "s", "ss", "Total Nonfarm", "01", "2001", 1000.0, "S"),
            ("Small", "s", "ss", "Total Nonfarm", "01", "2001", 10.0, "S"),
            ("Statewide", "s", "ss", "Total Nonfarm", "01", "2001", 5000.0, "S")]
    df = _panel(spark, rows)
    over = {(r["area_name"], r["industry_name"], r["Month"]) for r in over_cohort(df).collect()}
    assert over == {("Big", "Total Nonfarm", "01"), ("Big", "Total Nonfarm", "02"), ("Big", "Mining", "01")}
    under = {(r["area_name"], r["Month"]) for r in under_rows(df).collect()}
    assert under == {("Big", "02"), ("Small", "01")}


def test_single_sums_measures_equal(spark):
    rows = [("A", "s", "ss", "TN", "01", "2001", 2.0, "S"), ("A", "s", "ss", "TN", "01", "2001", 3.0, "S")]
    r = single_sums(_panel(spark, rows), KEYS).first()
    assert r["value"] == r["value_mom"] == 5.0


def test_empty_cohorts_in_reports(spark):
    import datetime as dt
    from panelgrowth.plans import reports as R
    from panelgrowth.plans.fused import fused_metrics
    rows = [("A", "s", "ss", "Total Nonfarm", f"{m:02d}", "2001", 5.0, fl)
            for m in range(1, 13) for fl in ("U", "S")]
    df = _panel(spark, rows)
    assert R.metro_over_report(df, dt.date(2001, 3, 1), threshold=1e9).count() == 0
    assert R.metro_under_report(df, dt.date(2001, 3, 1), threshold=0.0, scope="frame").count() == 0
    levels = {r["level"] for r in fused_metrics(df, 2, over_threshold=1e9, under_threshold=0.0).collect()}
    assert levels == {"msa"}
