"""Real-feed path: padded TSV facts + lookups -> enrichment -> panel ->
report, and the sinks."""

import datetime as dt

import pandas as pd

from panelgrowth.plans.panels import enrich_state_metro, state_metro_panel
from panelgrowth.plans.reports import state_report
from panelgrowth.sinks.writers import SinkTarget, write_reports
from panelgrowth.sources.feeds import LookupSource, date_ref_row, read_facts, read_lookup


def _write_lookups(spark, base):
    pd_frames = {
        "sm_state": pd.DataFrame({"state_code": [1, 2], "state_name": ["Alpha", "Beta\r"]}),
        "sm_supersector": pd.DataFrame({"supersector_code": [0, 5], "supersector_name": ["Total", "Goods\r"]}),
        "sm_series": pd.DataFrame({
            "series_id": ["S1", "S2", "S3"], "state_code": [1, 2, 1], "area_code": [0, 0, 123],
            "supersector_code": [0, 0, 5], "industry_code": [0, 0, 5000000],
            "data_type_code": ["1", "1", "1"], "seasonal": ["U", "U", "U"],
            "footnote_codes": ["x", "x", "x"]}),
        "sm_industry": pd.DataFrame({"industry_code": [0, 5000000],
                                     "industry_name": ["Total Nonfarm", "Mining"]}),
        "sm_area": pd.DataFrame({"area_code": ["00000\n", "00123"],
                                 "area_name": ["Statewide", "Gamma Metropolitan Statistical Area"],
                                 "state_name": ["WRONG", "WRONG"]}),
    }
    for name, pdf in pd_frames.items():
        spark.createDataFrame(pdf).write.mode("overwrite").parquet(f"{base}/{name}.parquet")


def _write_facts(path, rows):
    lines = ["series_id\tyear\tperiod\tvalue\tfootnote_codes"]
    for sid, year, period, value in rows:
        lines.append(f"{sid:<17}\t{year}\t{period}\t{value:>12}\t")
    path.write_text("\n".join(lines) + "\n")


def test_feed_to_state_report(spark, tmp_path):
    base = str(tmp_path / "lookups")
    _write_lookups(spark, base)
    facts_path = tmp_path / "sm.data.txt"
    rows = []
    for t in range(14):
        year, month = 2000 + t // 12, t % 12 + 1
        rows += [("S1", year, f"M{month:02d}", f"{100 + t}.0"),
                 ("S2", year, f"M{month:02d}", f"{200 + 2 * t}"),
                 ("S3", year, f"M{month:02d}", "-" if t == 3 else f"{10 + t}")]
    rows.append(("S1", 2000, "M13", "999"))
    _write_facts(facts_path, rows)

    src = LookupSource("parquet", base)
    lk = {n: read_lookup(spark, src, n) for n in ("sm_state", "sm_supersector", "sm_series",
                                                  "sm_industry", "sm_area")}
    facts = read_facts(spark, str(facts_path))
    enriched = enrich_state_metro(facts, lk["sm_state"], lk["sm_supersector"], lk["sm_series"],
                                  lk["sm_industry"], lk["sm_area"])
    panel = state_metro_panel(enriched)
    got = {(r["area_name"], r["state_name"], r["industry_name"], r["Month"]) for r in panel.collect()}
    assert ("Statewide", "Alpha", "Total Nonfarm", "01") in got
    assert ("Statewide", "Beta", "Total Nonfarm", "01") in got       # CR removed, left name kept
    assert ("Gamma ", "Alpha", "Mining", "02") in got                 # padded codes joined
    assert not any(m == "13" for *_, m in got)

    rep = state_report(panel, as_of=dt.date(2001, 3, 1)).filter("year = '2001'").orderBy("state_name", "Month")
    out = rep.collect()
    a = [r for r in out if r["state_name"] == "Alpha"]
    assert a[0]["pct_change"] == round((112 / 100 - 1) * 100, 2)
    assert a[0]["abs_change"] == 12.0
    assert a[0]["value_mom"] is None                     # no adjusted series: left pairing
    b = [r for r in out if r["state_name"] == "Beta"]
    # Beta's series is exactly twice Alpha's: equal growth every month, so the
    # first-tie rule ranks by entity name
    assert all(r["rank"] == 1.0 for r in a) and all(r["rank"] == 2.0 for r in b)


def test_date_ref_row(spark):
    r = date_ref_row(spark, dt.date(2024, 3, 15)).first()
    assert (r["month"], r["year"]) == ("2", "2024")


def test_write_reports_index_restarts(spark, tmp_path):
    a = spark.createDataFrame([("x", "s", "i", "2001", "01", 1.0), ("w", "s", "i", "2001", "01", 2.0)],
                              "state_name string, supersector_name string, industry_name string, "
                              "year string, Month string, value double")
    b = spark.createDataFrame([("m", "s", "i", "2001", "01", 3.0)],
                              "state_name string, supersector_name string, industry_name string, "
                              "year string, Month string, value double")
    target = SinkTarget("parquet", str(tmp_path / "out"))
    write_reports({"state_rankings": a.unionByName(b)}, target, index=True,
                  entity_parts={"state_rankings": [a, b]})
    back = spark.read.parquet(target.path("state_rankings"))
    assert sorted((r["index"], r["state_name"]) for r in back.collect()) == [(0, "m"), (0, "w"), (1, "x")]


def test_write_reports_sorted(spark, tmp_path):
    a = spark.createDataFrame([("x", "s", "i", "2001", "02", 1.0), ("x", "s", "i", "2001", "01", 2.0)],
                              "state_name string, supersector_name string, industry_name string, "
                              "year string, Month string, value double")
    b = spark.createDataFrame([("a", "s", "i", "2001", "01", 3.0)],
                              "state_name string, supersector_name string, industry_name string, "
                              "year string, Month string, value double")
    target = SinkTarget("parquet", str(tmp_path / "sorted"))
    write_reports({"state_rankings": a.unionByName(b)}, target, sort=True,
                  entity_parts={"state_rankings": [a, b]})
    back = spark.read.parquet(target.path("state_rankings")).collect()
    assert [(r["state_name"], r["Month"]) for r in back] == [("x", "01"), ("x", "02"), ("a", "01")]


def test_feed_header_padding_order_and_extras(spark, tmp_path):
    p = tmp_path / "padded.txt"
    p.write_text("year\tseries_id                     \tperiod\textra\t       value\n"
                 "2001\tS1   \tM01\tx\t   5.0\n")
    r = read_facts(spark, str(p)).first()
    assert (r["series_id"], r["year"], r["period"], r["value"], r["footnote_codes"]) == \
        ("S1", "2001", "M01", "5.0", None)


def test_csv_lookup_source(spark, tmp_path):
    (tmp_path / "sm_industry.csv").write_text("industry_code,industry_name\n5000000,Mining\n0,Total Nonfarm\n")
    src = LookupSource("csv", str(tmp_path), options={"header": "true"})
    got = sorted(tuple(r) for r in read_lookup(spark, src, "sm_industry").collect())
    assert got == [("0", "Total Nonfarm"), ("5000000", "Mining")]
