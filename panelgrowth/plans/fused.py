"""All four state/metro sections in one pass (states, metros, small metros,
large metros).

A panel row belongs to one entity only: its state if it is statewide, else its
area.  So one aggregation over the facts, keyed by (statewide, entity, cell),
with conditional sums, holds all that the four levels need:

=========  =====================================================  ==========
level      cells                                                  entity
=========  =====================================================  ==========
state      statewide, with unadjusted rows                        state_name
msa        other, with unadjusted rows                            area_name
under      other, with unadjusted 'Total Nonfarm' rows below the  area_name
           threshold (sums of such rows alone)
over       other, with adjusted rows, of areas with an adjusted   area_name
           'Total Nonfarm' row above the threshold
=========  =====================================================  ==========

The cells are written once; levels, large-metro areas and entity counts come
from them, and one series window and one peer window serve every level.
Results are equal to the per-section functions in ``reports.py``.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrowth.operators.exact import exact_sums
from panelgrowth.operators.filters import ADJUSTED, STATEWIDE, TOTAL_NONFARM, UNADJUSTED
from panelgrowth.operators.growth import finish_growth, growth_fractions
from panelgrowth.operators.pairing import cohort_join
from panelgrowth.operators.ranks import MAX_WINDOW_GROUP_ROWS, peer_ranks
from panelgrowth.plans.reports import CELL_TAIL, _k, report_columns
from panelgrowth.sinks.writers import materialize

LEVELS = ("state", "msa", "under", "over")
AVERAGE_MOM = ("under", "over")


def entity_cells(panel: DataFrame, under_threshold: float = 1000.0,
                 over_size: str = "value", under_size: str = "value") -> DataFrame:
    """One row per (statewide, entity, cell): sums and row counts of both flags,
    the same of the rows below the threshold, and the largest adjusted
    'Total Nonfarm' size (``top``, metro cells only)."""
    is_u = F.col("seasonal") == F.lit(UNADJUSTED)
    is_s = F.col("seasonal") == F.lit(ADJUSTED)
    metro_tn = ~F.col("statewide") & (F.col("industry_name") == F.lit(TOTAL_NONFARM))
    small = metro_tn & (F.col(under_size) < F.lit(under_threshold))
    statewide = F.col("area_name").eqNullSafe(F.lit(STATEWIDE))
    rows = (panel.filter(F.col("seasonal").isin(UNADJUSTED, ADJUSTED))
            .withColumn("statewide", statewide)
            .withColumn("entity", F.when(F.col("statewide"), F.col("state_name"))
                        .otherwise(F.col("area_name"))))
    value = F.col("value")
    return exact_sums(rows, ["statewide", "entity", *CELL_TAIL],
                      {"u": F.when(is_u, value), "s": F.when(is_s, value),
                       "under_u": F.when(small & is_u, value), "under_s": F.when(small & is_s, value)},
                      F.count(F.when(is_u, F.lit(1))).alias("n_u"),
                      F.count(F.when(is_s, F.lit(1))).alias("n_s"),
                      F.count(F.when(small & is_u, F.lit(1))).alias("n_under"),
                      F.max(F.when(metro_tn & is_s, F.col(over_size))).alias("top"))


def level_cells(cells: DataFrame, over_threshold: float = 1000.0,
                levels: Sequence[str] = LEVELS) -> DataFrame:
    """Cells of the asked levels from ``entity_cells``.  Cells with a missing
    key are dropped (the source job's group-by drops them), after the areas
    were qualified on all rows."""
    keys = ["level", "entity"] + CELL_TAIL
    complete = cells.dropna(subset=["entity"] + CELL_TAIL)
    metro = ~F.col("statewide")

    def tag(level: str, base: str, mom: str):
        return F.struct(F.lit(level).alias("level"), F.col(base).alias("value"),
                        F.col(mom).alias("value_mom"))

    tags = {
        "state": F.when(F.col("statewide") & (F.col("n_u") > 0), tag("state", "u", "s")),
        "msa": F.when(metro & (F.col("n_u") > 0), tag("msa", "u", "s")),
        "under": F.when(metro & (F.col("n_under") > 0), tag("under", "under_u", "under_s")),
    }

    def expand(df: DataFrame, columns) -> DataFrame:
        # explode, then a plain null filter: stays in generated code
        return (df.withColumn("_tag", F.explode(F.array(*columns)))
                .filter(F.col("_tag").isNotNull())
                .select("_tag.level", "entity", *CELL_TAIL, "_tag.value", "_tag.value_mom"))

    wanted = [tags[x] for x in levels if x in tags]
    if "over" not in levels:
        return expand(complete, wanted).select(*keys, "value", "value_mom")
    names = (cells.filter(F.col("top") > F.lit(over_threshold))
             .select("statewide", "entity", F.lit(True).alias("_qualified")).distinct())
    over = F.when(F.col("_qualified") & (F.col("n_s") > 0), tag("over", "s", "s"))
    joined, spread = cohort_join(complete, names, ["statewide", "entity"], "left")
    out = expand(joined, wanted + [over]).select(*keys, "value", "value_mom")
    return out.repartition("level", "entity", "supersector_name", "industry_name") if spread else out


def rank_strategy_for(cells: DataFrame, max_window_rows: int = MAX_WINDOW_GROUP_ROWS) -> str:
    """Window or sorted ranks: a peer group holds at most one row per entity, so
    the entities of each kind, counted on the written cells, bound it."""
    rows = cells.groupBy("statewide").agg(F.count_distinct("entity").alias("n")).collect()
    return "sorted" if any(r["n"] > max_window_rows for r in rows) else "window"


def fused_metrics(panel: DataFrame, k: int, over_threshold: float = 1000.0,
                  under_threshold: float = 1000.0, over_size: str = "value",
                  under_size: str = "value", rank_strategy: str = "window",
                  levels: Sequence[str] = LEVELS,
                  keep: Callable[..., DataFrame] | None = None) -> DataFrame:
    """Metrics and ranks of the asked levels, with ``level`` and ``entity``.

    With the level ``over`` or ``rank_strategy="auto"`` the cells are written
    while this is called (``keep``, by default a table under the shared
    folder), so the facts are read once; else the result is lazy."""
    cells = entity_cells(panel, under_threshold, over_size, under_size)
    if "over" in levels or rank_strategy == "auto":
        cells = (keep or materialize)(cells, "entity_cells")
    if rank_strategy == "auto":
        rank_strategy = rank_strategy_for(cells)
    df = growth_fractions(level_cells(cells, over_threshold, levels),
                          ["level", "entity", "supersector_name", "industry_name"], k)
    peer = ["level"] + CELL_TAIL
    df = peer_ranks(df, "entity", {
        "_rank_mom_first": ("_f_mom", "first"),
        "_rank_mom_avg": ("_f_mom", "average"),
        "rank_ytd": ("_f_ytd", "first"),
        "rank_ann": ("_f_ann", "first"),
        "rank": ("_f_yoy", "first"),
    }, peer_keys=peer, strategy=rank_strategy)
    df = df.withColumn("rank_mom", F.when(F.col("level").isin(*AVERAGE_MOM), F.col("_rank_mom_avg"))
                       .otherwise(F.col("_rank_mom_first")))
    return finish_growth(df).select("level", *report_columns("entity"))


def combined_section(panel: DataFrame, as_of=None, ytd_months: int | None = None) -> DataFrame:
    """M6/U3 from one aggregation of the panel: the states and the metros, names in
    ``state_name``; equal to ``combined_report`` of the two sections."""
    metrics = fused_metrics(panel, _k(ytd_months, as_of), levels=("state", "msa"))
    return metrics.drop("level").withColumnRenamed("entity", "state_name")


def split_levels(metrics: DataFrame) -> dict[str, DataFrame]:
    """level -> report frame with its entity column named as in the
    per-section functions."""
    names = {"state": "state_name", "msa": "area_name", "under": "area_name", "over": "area_name"}
    return {lvl: metrics.filter(F.col("level") == F.lit(lvl)).drop("level")
            .withColumnRenamed("entity", names[lvl]) for lvl in LEVELS}


def state_metro_sections(panel: DataFrame, k: int, over_threshold: float = 1000.0,
                         under_threshold: float = 1000.0, over_size: str = "value",
                         rank_strategy: str = "window",
                         keep: Callable[..., DataFrame] | None = None) -> dict[str, DataFrame]:
    """The four state/metro tables from one pass.  ``keep(df, label,
    partition_by=...)`` materializes the combined metrics once, partitioned
    by level, so each table reads only its own partition."""
    metrics = fused_metrics(panel, k, over_threshold, under_threshold, over_size,
                            rank_strategy=rank_strategy, keep=keep)
    if keep is not None:
        metrics = keep(metrics, "state_metro_metrics", partition_by=["level"])
    return split_levels(metrics)
