"""Growth metrics over monthly series, series scope.

Cells are one row per (series key, year, Month).  Every metric is a window
over the series, ordered by year then Month:

* ``pct_change(x, p)``: x divided by the last non-missing x at or before p
  rows back, minus 1; missing where x is missing, or where the base is
  missing or zero (the source engine would give inf there).
* ``rolling_mean(x, n)``: mean of the last n rows, missing until n
  non-missing values are in the frame.
* job growth: the raw (not forward-filled) x p rows back times the
  unrounded fraction.

The four families are mom (``value_mom``, 1 row), ytd (rolling mean over k
rows, then 12 rows), ann (rolling mean over 12 rows, then 12 rows) and
year-over-year (``value``, 12 rows).  Windows partition by the series key,
so the work spreads over series; Catalyst shares one exchange for all of
them.  The whole-frame variant lives in ``frame.py``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelgrowth.functions.clean import pct_round, round2

ORDER = ("year", "Month")
YEAR_BACK = 12
# family -> (measure column, rows back)
FAMILIES = {
    "mom": ("value_mom", 1),
    "ytd": ("value_ytd_avg", YEAR_BACK),
    "ann": ("value_ann_avg", YEAR_BACK),
    "yoy": ("value", YEAR_BACK),
}


def series_window(series_keys: Sequence[str], order: Sequence[str] = ORDER) -> WindowSpec:
    return Window.partitionBy(*series_keys).orderBy(*order)


def pct_change(x: Column, w: WindowSpec, periods: int) -> Column:
    """Gap-padded percent change as a fraction."""
    base = F.last(x, ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, -periods))
    return F.when(x.isNotNull(), F.try_divide(x, base) - F.lit(1.0))


def rolling_mean(x: Column, w: WindowSpec, n: int) -> Column:
    """Trailing n-row mean, missing until the frame holds n values."""
    if n <= 0:
        return F.lit(None).cast("double")
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(x).over(frame) == F.lit(n), F.avg(x).over(frame))


def with_rolling_means(cells: DataFrame, w: WindowSpec, ytd_months: int) -> DataFrame:
    return cells.withColumns({
        "value_ytd_avg": rolling_mean(F.col("value"), w, ytd_months),
        "value_ann_avg": rolling_mean(F.col("value"), w, YEAR_BACK),
    })


def with_fractions(df: DataFrame, w: WindowSpec) -> DataFrame:
    """Unrounded fractions ``_f_<family>`` and raw lags ``_lag_<family>``."""
    cols = {}
    for fam, (measure, p) in FAMILIES.items():
        x = F.col(measure)
        cols[f"_f_{fam}"] = pct_change(x, w, p)
        cols[f"_lag_{fam}"] = F.lag(x, p).over(w)
    return df.withColumns(cols)


def finish_growth(df: DataFrame) -> DataFrame:
    """Rounded percent and job-growth columns from fractions and lags."""
    cols = {}
    for fam in FAMILIES:
        suffix = "" if fam == "yoy" else f"_{fam}"
        cols[f"pct_change{suffix}"] = pct_round(F.col(f"_f_{fam}"))
        cols[f"abs_change{suffix}"] = round2(F.col(f"_lag_{fam}") * F.col(f"_f_{fam}"))
    return df.withColumns(cols)


def growth_fractions(cells: DataFrame, series_keys: Sequence[str], ytd_months: int) -> DataFrame:
    """Rolling means, fractions and lags, series scope."""
    w = series_window(series_keys)
    return with_fractions(with_rolling_means(cells, w, ytd_months), w)
