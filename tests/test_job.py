"""The monthly job from a landing folder to the report tables."""

import datetime as dt

import pandas as pd

from panelgrowth.plans.job import CE_FILES, SM_FILES, build_panels, feed_paths, main, run_monthly
from panelgrowth.sinks.writers import SinkTarget
from panelgrowth.sources.feeds import LookupSource


def _tsv(path, rows):
    lines = ["series_id\tyear\tperiod\tvalue\tfootnote_codes"]
    lines += [f"{s:<20}\t{y}\t{p}\t{v:>10}\t" for s, y, p, v in rows]
    path.write_text("\n".join(lines) + "\n")


def test_monthly_job(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    months = [(2000 + t // 12, f"M{t % 12 + 1:02d}") for t in range(15)]
    sm_rows = []
    for i, (y, p) in enumerate(months):
        for sid, base in (("SMU1", 100), ("SMS1", 100), ("SMU2", 1500), ("SMS2", 1500), ("SMU3", 50)):
            sm_rows.append((sid, y, p, f"{base + i}"))
    _tsv(landing / f"{SM_FILES[0]}.txt", sm_rows)
    ce_rows = [(sid, y, p, f"{base + 2 * i}.0") for i, (y, p) in enumerate(months)
               for sid, base in (("CEU0", 1000), ("CES0", 990))]
    _tsv(landing / f"{CE_FILES[0]}.txt", ce_rows)
    _tsv(landing / f"{CE_FILES[1]}.txt", ce_rows[:4])      # a series in two files counts twice
    for f in CE_FILES[2:]:
        _tsv(landing / f"{f}.txt", [])

    lk = tmp_path / "lookups"
    frames = {
        "sm_state": pd.DataFrame({"state_code": [1], "state_name": ["Alpha"]}),
        "sm_supersector": pd.DataFrame({"supersector_code": ["0"], "supersector_name": ["Total"]}),
        "sm_series": pd.DataFrame({
            "series_id": ["SMU1", "SMS1", "SMU2", "SMS2", "SMU3"], "state_code": [1] * 5,
            "area_code": [0, 0, 11, 11, 22], "supersector_code": ["0"] * 5, "industry_code": ["0"] * 5,
            "data_type_code": [1] * 5, "seasonal": ["U", "S", "U", "S", "U"]}),
        "sm_industry": pd.DataFrame({"industry_code": ["00000000"], "industry_name": ["Total Nonfarm"]}),
        "sm_area": pd.DataFrame({"area_code": ["00000", "00011", "00022"],
                                 "area_name": ["Statewide", "Big Metropolitan Statistical Area", "Small NECTA"]}),
        "ce_series": pd.DataFrame({"series_id": [" CEU0 ", "CES0"], "supersector_code": ["0", "0"],
                                   "industry_code": ["0", "0"], "data_type_code": ["1", "1"],
                                   "seasonal": ["U", "S"]}),
        "ce_industry": pd.DataFrame({"industry_code": ["0"], "industry_name": ["Total Nonfarm\r"]}),
        "ce_supersector": pd.DataFrame({"supersector_code": ["0"], "supersector_name": ["Goods-Producing"]}),
    }
    for name, pdf in frames.items():
        spark.createDataFrame(pdf).write.parquet(str(lk / f"{name}.parquet"))

    assert feed_paths(str(landing))["ce"][0].endswith(f"{CE_FILES[0]}.txt")
    sm, ce = build_panels(spark, str(landing), LookupSource("parquet", str(lk)))
    out = tmp_path / "out"
    target = SinkTarget("parquet", str(out))
    run_monthly(spark, sm, ce, target, dt.date(2001, 3, 1), index=True)

    read = lambda t: spark.read.parquet(target.path(t))
    nat = read("national_rankings_t").orderBy("year", "Month").collect()
    assert len(nat) == 15
    assert nat[0]["value"] == 2000.0 and nat[0]["value_mom"] == 1980.0  # Jan rows in two files count twice
    assert nat[2]["value"] == 1004.0 and nat[2]["value_mom"] == 994.0
    assert nat[0]["supersector_name"] == "Goods Producing" and nat[0]["industry_name"] == "Total Nonfarm"
    assert nat[0]["rank"] == "" and nat[0]["area_name"] == "United States"
    states = read("state_rankings")
    assert states.count() == 15 * 3                   # Alpha + Big + Small
    assert sorted(r["state_name"] for r in states.filter("index = 0").collect()) == ["Alpha", "Big "]
    msa = read("msa_rankings")
    assert set(msa.columns) >= {"state_name", "rank_mom"}
    over = read("msa_rankings_over").select("area_name").distinct().collect()
    assert [r[0] for r in over] == ["Big "]
    under = read("msa_rankings_under").select("area_name").distinct().collect()
    assert [r[0] for r in under] == ["Small"]
    ref = read("date_ref_t").first()
    assert (ref["month"], ref["year"]) == ("2", "2001")

    # frame scope runs end to end (per-section path)
    out3 = SinkTarget("parquet", str(tmp_path / "out3"))
    run_monthly(spark, sm, ce, out3, dt.date(2001, 3, 1), scope="frame")
    assert spark.read.parquet(out3.path("state_rankings")).count() == 15 * 3
    nat3 = spark.read.parquet(out3.path("national_rankings_t")).count()
    assert nat3 == 15

    # the fused pass and the per-section functions write the same tables
    out2 = SinkTarget("parquet", str(tmp_path / "out2"))
    run_monthly(spark, sm, ce, out2, dt.date(2001, 3, 1), index=True, fused=False)
    for t in ("state_rankings", "msa_rankings", "msa_rankings_under", "msa_rankings_over"):
        a = sorted(tuple(r) for r in read(t).collect())
        b = sorted(tuple(r) for r in spark.read.parquet(out2.path(t)).select(*read(t).columns).collect())
        assert a == b, t

    # the command line: a subset of sections, sorted output
    out4 = tmp_path / "cli"
    main(["--landing", str(landing), "--lookups", str(lk), "--out", str(out4),
          "--as-of", "2001-03-01", "--sections", "national,msa", "--sort"])
    msa_cli = spark.read.parquet(str(out4 / "msa_rankings")).collect()
    assert len(msa_cli) == 30
    keys = [(r["state_name"], r["supersector_name"], r["industry_name"], r["year"], r["Month"]) for r in msa_cli]
    assert keys == sorted(keys)
    assert spark.read.parquet(str(out4 / "national_rankings_t")).count() == 15
    assert not (out4 / "state_rankings").exists()
