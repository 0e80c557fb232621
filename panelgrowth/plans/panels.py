"""Panel builds: enrichment, cleaning and the U/S split.

``state_metro_panel`` and ``national_panel`` take an enriched fact table
(real feeds joined to their lookups, or the analog) and return the cleaned
panel with a ``Month`` column; rows of both seasonal flags stay in one
frame, since the pairing step sums both in one aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrowth.functions.clean import (
    finite,
    lenient_double, month_from_period, remove, strip_all, zero_pad,
)
from panelgrowth.operators.enrich import enrich
from panelgrowth.operators.filters import (
    ADJUSTED, UNADJUSTED, area_exclusion, national_split_condition,
    state_metro_split_condition,
)

# The panels' columns.
SM_COLUMNS = ["area_name", "state_name", "supersector_name", "industry_name", "period",
              "year", "value", "data_type_code", "seasonal"]
CE_COLUMNS = ["supersector_name", "industry_name", "period", "year", "value",
              "data_type_code", "seasonal"]
# Text removed from metro names for display.
NECTA_SUFFIX = " NECTA"
MSA_SUFFIX = "Metropolitan Statistical Area"


def _numeric_value(df: DataFrame) -> F.Column:
    """Text values get the lenient parse; numeric ones are cast."""
    if isinstance(df.schema["value"].dataType, T.StringType):
        return lenient_double("value")
    return finite(F.col("value").cast("double"))


def clean_state_metro(enriched: DataFrame, extra=()) -> DataFrame:
    """P1, X5, F1, X3a, X3c, X3d, X2 on the enriched state/metro facts."""
    cols = SM_COLUMNS + [c for c in extra if c not in SM_COLUMNS]
    df = enriched.select(*cols).withColumns({
        "value": _numeric_value(enriched),
        "period": F.col("period").cast("string"),
    })
    df = area_exclusion(df)
    return df.withColumns({
        "area_name": remove(remove("area_name", NECTA_SUFFIX), MSA_SUFFIX),
        "state_name": remove("state_name", "\r"),
        "supersector_name": remove("supersector_name", "\r"),
        "data_type_code": zero_pad(F.col("data_type_code").cast("string"), 2),
    })


def split_state_metro(cleaned: DataFrame, seasonal=(UNADJUSTED, ADJUSTED)) -> DataFrame:
    """F2 + period -> Month."""
    return (cleaned.filter(state_metro_split_condition(seasonal))
            .withColumn("period", month_from_period("period"))
            .withColumnRenamed("period", "Month"))


def state_metro_panel(enriched: DataFrame, seasonal=(UNADJUSTED, ADJUSTED), extra=()) -> DataFrame:
    """Cleaned state/metro panel, flags ``seasonal`` kept."""
    return split_state_metro(clean_state_metro(enriched, extra), seasonal)


def national_panel(enriched: DataFrame, seasonal=(UNADJUSTED, ADJUSTED)) -> DataFrame:
    """P1, F3 + period -> Month.  Names are cleaned only after the
    report's metrics, as in the source job."""
    df = enriched.select(*CE_COLUMNS).withColumn("value", _numeric_value(enriched))
    return (df.filter(national_split_condition(seasonal))
            .withColumn("period", month_from_period("period"))
            .withColumnRenamed("period", "Month"))


# --- real feeds: lookups cleaned as the source job cleans them -------------

def clean_sm_lookups(state, supersector, series, industry, area):
    """X1-X4 on the state/metro lookups; returns them in join order with keys."""
    supersector = supersector.withColumn(
        "supersector_code", zero_pad(F.col("supersector_code").cast("string"), 8))
    series = series.withColumns({
        "area_code": zero_pad(F.col("area_code").cast("string"), 5),
        "industry_code": zero_pad(F.col("industry_code").cast("string"), 8),
        "supersector_code": zero_pad(F.col("supersector_code").cast("string"), 8),
    })
    industry = industry.withColumn(
        "industry_code", zero_pad(F.col("industry_code").cast("string"), 8))
    area = area.withColumn("area_code", remove(F.col("area_code").cast("string"), "\n"))
    return [(series, "series_id"), (industry, "industry_code"),
            (supersector, "supersector_code"), (state, "state_code"), (area, "area_code")]


def clean_ce_lookups(series, industry, supersector):
    series = series.withColumns({
        "series_id": strip_all(F.col("series_id").cast("string")),
        "supersector_code": zero_pad(F.col("supersector_code").cast("string"), 8),
        "industry_code": zero_pad(F.col("industry_code").cast("string"), 8),
    })
    industry = industry.withColumn(
        "industry_code", zero_pad(F.col("industry_code").cast("string"), 8))
    supersector = supersector.withColumn(
        "supersector_code", zero_pad(F.col("supersector_code").cast("string"), 8))
    return [(series, "series_id"), (industry, "industry_code"), (supersector, "supersector_code")]


def enrich_state_metro(facts: DataFrame, state, supersector, series, industry, area) -> DataFrame:
    """J1 + J6: facts joined to the five state/metro lookups."""
    return enrich(facts, clean_sm_lookups(state, supersector, series, industry, area), salt=True)


def enrich_national(facts: DataFrame, series, industry, supersector) -> DataFrame:
    """Facts joined to the three national lookups."""
    return enrich(facts, clean_ce_lookups(series, industry, supersector), salt=True)
