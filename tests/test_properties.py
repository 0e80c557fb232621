"""Properties on random panels."""

import datetime as dt
import random
from collections import defaultdict

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelgrowth.operators.growth import finish_growth, growth_fractions
from panelgrowth.operators.pairing import paired_sums
from panelgrowth.operators.ranks import with_peer_ranks
from panelgrowth.plans import reports as R

PANEL = ("area_name string, state_name string, supersector_name string, industry_name string, "
         "Month string, year string, value double, seasonal string")
KEYS = ["area_name", "supersector_name", "industry_name", "year", "Month"]


def _random_panel(spark, seed=13, n=3000):
    rnd = random.Random(seed)
    areas = ["Statewide"] * 3 + [f"A{i}" for i in range(8)]
    rows = []
    for _ in range(n):
        t = rnd.randint(0, 35)
        rows.append((rnd.choice(areas), rnd.choice(["X", "Y"]), rnd.choice(["s1", "s2"]),
                     rnd.choice(["Total Nonfarm", "Mining"]), f"{t % 12 + 1:02d}", str(2000 + t // 12),
                     float(rnd.randint(1, 60)), rnd.choice("USS")))
    return spark.createDataFrame(rows, PANEL), rows


def test_group_sum_conserves_total(spark):
    df, rows = _random_panel(spark)
    cells = paired_sums(df, KEYS, "left").collect()
    u_total = sum(r[6] for r in rows if r[7] == "U")
    assert sum(c["value"] for c in cells) == u_total
    s_cells = {tuple(c[k] for k in KEYS) for c in cells}
    s_total = sum(r[6] for r in rows if r[7] == "S" and (r[0], r[2], r[3], r[5], r[4]) in s_cells)
    assert sum(c["value_mom"] or 0.0 for c in cells) == s_total


def test_growth_is_difference_without_gaps(spark):
    df, _ = _random_panel(spark)
    cells = paired_sums(df, KEYS, "left")
    out = finish_growth(growth_fractions(cells, KEYS[:3], 2))
    w = out.withColumn("_raw_lag", F.lag("value", 12).over(
        Window.partitionBy(*KEYS[:3]).orderBy("year", "Month")))
    rows = w.filter(F.col("_raw_lag").isNotNull() & F.col("abs_change").isNotNull()).collect()
    assert rows
    for r in rows:
        assert r["abs_change"] == round(r["value"] - r["_raw_lag"], 2)


def test_rank_permutation_and_average_sum(spark):
    df, _ = _random_panel(spark)
    cells = paired_sums(df, KEYS, "left")
    fr = growth_fractions(cells, KEYS[:3], 2)
    ranked = with_peer_ranks(fr, "area_name", {"rf": ("_f_yoy", "first"), "ra": ("_f_yoy", "average")})
    groups = defaultdict(list)
    for r in ranked.filter(F.col("_f_yoy").isNotNull()).collect():
        groups[(r["supersector_name"], r["industry_name"], r["year"], r["Month"])].append((r["rf"], r["ra"]))
    assert groups
    for vals in groups.values():
        n = len(vals)
        assert sorted(v[0] for v in vals) == [float(i) for i in range(1, n + 1)]
        assert abs(sum(v[1] for v in vals) - n * (n + 1) / 2) < 1e-9


def test_combined_rows_are_states_plus_metros(spark):
    df, _ = _random_panel(spark)
    as_of = dt.date(2002, 3, 1)
    states, metros = R.state_report(df, as_of), R.metro_report(df, as_of)
    assert R.combined_report(states, metros).count() == states.count() + metros.count()
