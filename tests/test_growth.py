"""Growth windows (W1-W8) on hand-worked series, series scope."""

from pyspark.sql import functions as F

from panelgrowth.operators.growth import finish_growth, growth_fractions

SCHEMA = ("state_name string, supersector_name string, industry_name string, "
          "year string, Month string, value double, value_mom double")


def _cells(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _months(n, start_year=2000):
    return [(str(start_year + i // 12), f"{i % 12 + 1:02d}") for i in range(n)]


def _run(spark, values, moms=None, k=2, entity="a"):
    moms = moms or [None] * len(values)
    rows = [(entity, "ss", "ind", y, m, v, mm) for (y, m), v, mm in zip(_months(len(values)), values, moms)]
    df = finish_growth(growth_fractions(_cells(spark, rows), ["state_name", "supersector_name",
                                                               "industry_name"], k))
    return df.orderBy("year", "Month").collect()


def test_mom_gap_padding(spark):
    moms = [10.0, None, 12.0, None, None, 15.0, 18.0]
    out = _run(spark, [1.0] * 7, moms)
    assert [r["_f_mom"] for r in out] == [None, None, 0.19999999999999996, None, None, 0.25, 0.19999999999999996]
    assert [r["pct_change_mom"] for r in out] == [None, None, 20.0, None, None, 25.0, 20.0]
    assert [r["abs_change_mom"] for r in out] == [None, None, None, None, None, None, 3.0]


def test_rolling_and_yoy_warmup(spark):
    values = [float(100 + i) for i in range(24)]
    out = _run(spark, values, k=3)
    ann = [r["value_ann_avg"] for r in out]
    assert ann[:11] == [None] * 11 and ann[11] == sum(values[:12]) / 12
    pct_ann = [r["_f_ann"] for r in out]
    assert pct_ann[:23] == [None] * 23 and pct_ann[23] is not None
    ytd = [r["value_ytd_avg"] for r in out]
    assert ytd[:2] == [None, None] and ytd[2] == (100 + 101 + 102) / 3
    yoy = [r["pct_change"] for r in out]
    assert yoy[:12] == [None] * 12
    assert out[12]["pct_change"] == round((112 / 100 - 1) * 100, 2)
    assert out[12]["abs_change"] == 12.0


def test_zero_base_is_null(spark):
    out = _run(spark, [1.0] * 3, [0.0, 5.0, 6.0])
    assert out[1]["_f_mom"] is None and out[1]["abs_change_mom"] is None
    assert out[2]["pct_change_mom"] == 20.0


def test_january_has_no_ytd(spark):
    out = _run(spark, [float(i) for i in range(1, 15)], k=0)
    assert all(r["value_ytd_avg"] is None and r["pct_change_ytd"] is None for r in out)


def test_series_do_not_leak(spark):
    rows = []
    for ent, base in (("a", 10.0), ("b", 1000.0)):
        for (y, m), i in zip(_months(3), range(3)):
            rows.append((ent, "ss", "ind", y, m, base + i, base + i))
    df = finish_growth(growth_fractions(_cells(spark, rows), ["state_name", "supersector_name",
                                                               "industry_name"], 2))
    first_b = df.filter((F.col("state_name") == "b") & (F.col("Month") == "01")).first()
    assert first_b["pct_change_mom"] is None


try:
    import math

    import pandas as pd
    from hypothesis import given, settings, strategies as st

    def _pandas_series(rows, k):
        df = pd.DataFrame(rows, columns=["state_name", "supersector_name", "industry_name", "year",
                                         "Month", "value", "value_mom"])
        df = df.sort_values(["state_name", "supersector_name", "industry_name", "year", "Month"])
        g = df.groupby(["state_name", "supersector_name", "industry_name"], sort=False)

        def pct(col, p):
            def one(x):
                base = x.ffill().shift(p)
                return (x / base.where(base != 0) - 1).where(x.notna())
            return g[col].transform(one)

        df["value_ytd_avg"] = g["value"].transform(lambda x: x.rolling(k).mean()) if k > 0 else float("nan")
        df["value_ann_avg"] = g["value"].transform(lambda x: x.rolling(12).mean())
        g = df.groupby(["state_name", "supersector_name", "industry_name"], sort=False)
        for fam, (m, p) in {"mom": ("value_mom", 1), "ytd": ("value_ytd_avg", 12),
                            "ann": ("value_ann_avg", 12), "yoy": ("value", 12)}.items():
            df[f"_f_{fam}"] = pct(m, p)
            df[f"_lag_{fam}"] = g[m].shift(p)
        return df.reset_index(drop=True)

    @settings(max_examples=6, deadline=None)
    @given(spec=st.lists(st.tuples(st.integers(1, 30), st.integers(0, 4), st.integers(0, 6)),
                         min_size=1, max_size=5),
           k=st.integers(0, 11))
    def test_series_growth_property(spark, spec, k):
        rows = []
        for s, (n, nv, nm) in enumerate(spec):
            for t in range(n):
                v = None if (t * 7 + s) % 11 < nv else float((t * 13 + s * 5) % 17)
                m = None if (t * 5 + s) % 7 < nm else float((t * 3 + s) % 19 + 1)
                rows.append((f"e{s}", "ss", "ind", str(2000 + t // 12), f"{t % 12 + 1:02d}", v, m))
        want = _pandas_series(rows, k)
        got = growth_fractions(_cells(spark, rows), ["state_name", "supersector_name", "industry_name"], k)
        got = got.toPandas().sort_values(["state_name", "year", "Month"]).reset_index(drop=True)
        want = want.sort_values(["state_name", "year", "Month"]).reset_index(drop=True)
        for c in ["value_ytd_avg", "value_ann_avg", "_f_mom", "_f_ytd", "_f_ann", "_f_yoy",
                  "_lag_mom", "_lag_yoy"]:
            for i in range(len(want)):
                a, b = got[c][i], want[c][i]
                if pd.isna(a) or pd.isna(b):
                    assert pd.isna(a) and pd.isna(b), (c, i, a, b)
                else:
                    assert math.isclose(float(a), float(b), rel_tol=1e-12, abs_tol=1e-12), (c, i, a, b)
except ImportError:  # pragma: no cover
    pass
