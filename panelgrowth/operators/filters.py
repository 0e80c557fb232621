"""Row filters.

Inequality tests keep rows whose value is missing, as the source job's
query strings do, so they are written with a null-safe equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values used by the state/metro and national splits.
STATEWIDE = "Statewide"
TOTAL_NONFARM = "Total Nonfarm"
EXCLUDED_STATES = ("District of Columbia", "Virgin Islands", "Puerto Rico")
EXCLUDED_AREA_PHRASES = ("Metropolitan Division", "NECTA Division")
ANNUAL_PERIOD = "M13"
UNADJUSTED = "U"
ADJUSTED = "S"
EMPLOYMENT_TYPE = "01"


def not_equal(c: str, value: str) -> Column:
    """``c != value`` that keeps missing values (True when ``c`` is NULL)."""
    return ~F.col(c).eqNullSafe(F.lit(value))


def area_exclusion(df: DataFrame, col: str = "area_name",
                   phrases=EXCLUDED_AREA_PHRASES) -> DataFrame:
    """drop areas whose name contains any of the phrases."""
    cond = None
    for p in phrases:
        hit = F.coalesce(F.col(col).contains(p), F.lit(False))
        cond = hit if cond is None else (cond | hit)
    return df.filter(~cond)


def state_metro_split_condition(seasonal: str | tuple[str, ...]) -> Column:
    """seasonal flag, employment data type, excluded states, no annual
    average period."""
    seasonal = (seasonal,) if isinstance(seasonal, str) else tuple(seasonal)
    cond = F.col("seasonal").isin(*seasonal) & (F.col("data_type_code") == EMPLOYMENT_TYPE)
    for s in EXCLUDED_STATES:
        cond = cond & not_equal("state_name", s)
    return cond & not_equal("period", ANNUAL_PERIOD)


def national_split_condition(seasonal: str | tuple[str, ...]) -> Column:
    """seasonal flag and no annual average period only."""
    seasonal = (seasonal,) if isinstance(seasonal, str) else tuple(seasonal)
    return F.col("seasonal").isin(*seasonal) & not_equal("period", ANNUAL_PERIOD)


def statewide_only(df: DataFrame) -> DataFrame:
    """F4."""
    return df.filter(F.col("area_name") == STATEWIDE)


def not_statewide(df: DataFrame) -> DataFrame:
    """F5 (missing area names are kept)."""
    return df.filter(not_equal("area_name", STATEWIDE))
