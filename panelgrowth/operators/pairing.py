"""Group sums and the pairing of unadjusted with adjusted panels
(SURVEY A1-A7, J3-J5, F6, F7).

The source job sums the unadjusted rows and the adjusted rows separately
and then merges the two results on the cell keys (inner for the nation,
left elsewhere).  Here both sums come from one aggregation over the rows
of both flags: one scan and one shuffle (with map-side partial sums) instead
of two aggregations and a join.  Counting the rows of each flag keeps the
join semantics exact: ``left`` keeps cells with an unadjusted row, ``inner``
keeps cells with rows of both flags.  Sums do not depend on the order of the rows
(``exact.py``).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrowth.operators.exact import exact_sums
from panelgrowth.operators.filters import (
    ADJUSTED, TOTAL_NONFARM, UNADJUSTED, not_equal, STATEWIDE,
)


def paired_sums(panel: DataFrame, keys: Sequence[str], how: str = "left",
                value: str = "value", flag: str = "seasonal",
                base_flag: str = UNADJUSTED, mom_flag: str = ADJUSTED) -> DataFrame:
    """One row per cell with ``value`` (sum of the
    ``base_flag`` rows) and ``value_mom`` (sum of the ``mom_flag`` rows).

    Rows with a missing key are dropped first (the source job's group-by
    drops them).  ``how`` is ``left`` (cells with a base row) or ``inner``
    (cells with rows of both flags).
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    keys = list(keys)
    is_base = F.col(flag) == F.lit(base_flag)
    is_mom = F.col(flag) == F.lit(mom_flag)
    cells = exact_sums(panel.dropna(subset=keys).filter(F.col(flag).isin(base_flag, mom_flag)), keys,
                       {"value": F.when(is_base, F.col(value)), "value_mom": F.when(is_mom, F.col(value))},
                       F.count(F.when(is_base, F.lit(1))).alias("_n_base"),
                       F.count(F.when(is_mom, F.lit(1))).alias("_n_mom"))
    keep = F.col("_n_base") > 0
    if how == "inner":
        keep = keep & (F.col("_n_mom") > 0)
    return cells.filter(keep).select(*keys, "value", "value_mom")


def single_sums(panel: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """A4: one group sum used as both measures (the over-cohort pairs the
    adjusted panel with itself, so ``value_mom`` equals ``value``)."""
    keys = list(keys)
    cells = exact_sums(panel.dropna(subset=keys), keys, {"value": F.col(value)})
    return cells.withColumn("value_mom", F.col("value"))


def over_cohort_names(panel: DataFrame, size: str = "value", threshold: float = 1000.0,
                      industry: str = TOTAL_NONFARM, entity: str = "area_name") -> DataFrame:
    """Distinct names of the areas with at least one non-statewide
    ``industry`` row whose ``size`` is above the threshold (one row per
    area; a filtered scan with partial distinct map-side)."""
    return (panel.filter(not_equal("area_name", STATEWIDE)
                         & (F.col("industry_name") == F.lit(industry))
                         & (F.col(size) > F.lit(threshold)))
            .select(entity)
            .distinct())


def over_cohort(panel: DataFrame, entity: str = "area_name", size: str = "value",
                threshold: float = 1000.0, industry: str = TOTAL_NONFARM) -> DataFrame:
    """Every row of the areas that have at least one
    non-statewide ``industry`` row with ``size > threshold``.

    The qualifying names are derived and applied as a left-semi join, so the
    name list never passes through the driver.  The list (one row per area)
    is written once and broadcast behind a size check; beyond it the rows
    are dealt out by the full cell key after the join, so that a hot area is
    not left in one task.
    """
    from panelgrowth.sinks.writers import materialize
    names = materialize(over_cohort_names(panel, size, threshold, industry, entity), "cohort_names")
    joined, spread = cohort_join(panel, names, [entity], "left_semi")
    cell = [c for c in (entity, "supersector_name", "industry_name", "year", "Month") if c in panel.columns]
    return joined.repartition(*cell) if spread else joined


def cohort_join(df: DataFrame, names: DataFrame, on: Sequence[str],
                how: str) -> tuple[DataFrame, bool]:
    """Join ``df`` to a written list of names: broadcast within the bounds.
    Beyond them it is a shuffle join, and True says that the rows are left hashed
    by name: the caller must deal them out anew by a finer key, or a hot name
    stays in one task."""
    from panelgrowth.operators.enrich import within_bounds
    if within_bounds(names):
        return df.join(F.broadcast(names), list(on), how), False
    return df.join(names, list(on), how), True


def over_cells(adjusted: DataFrame, keys: Sequence[str], size: str = "value",
               threshold: float = 1000.0, industry: str = TOTAL_NONFARM,
               entity: str = "area_name", value: str = "value") -> DataFrame:
    """A4, A7, F7, J5 in one pass over the facts: the group sums of
    ``single_sums(over_cohort(...))``.  The aggregation also carries the largest
    qualifying size of each cell; its cells are written once, and the
    qualifying names are taken from them."""
    from panelgrowth.sinks.writers import materialize
    keys = list(keys)
    counts = not_equal("area_name", STATEWIDE) & (F.col("industry_name") == F.lit(industry))
    cells = materialize(exact_sums(adjusted, keys, {"value": F.col(value)},
                                   F.max(F.when(counts, F.col(size))).alias("_top")), "over_cells")
    names = cells.filter(F.col("_top") > F.lit(threshold)).select(entity).distinct()
    joined, spread = cohort_join(cells.dropna(subset=keys).drop("_top"), names, [entity], "left_semi")
    if spread:
        joined = joined.repartition(*[c for c in keys if c not in ("year", "Month")])
    return joined.withColumn("value_mom", F.col("value"))


def under_rows(panel: DataFrame, size: str = "value", threshold: float = 1000.0,
               industry: str = TOTAL_NONFARM) -> DataFrame:
    """non-statewide ``industry`` rows with ``size < threshold``."""
    return panel.filter(not_equal("area_name", STATEWIDE)
                        & (F.col("industry_name") == F.lit(industry))
                        & (F.col(size) < F.lit(threshold)))
