"""The five report sections and their combination.

Each section is a lazy DataFrame:

1. group-sum the unadjusted rows into ``value`` and the adjusted rows into
   ``value_mom``, one row per cell, paired inner (nation) or left (others);
2. growth fractions over each series (``growth.py``; ``scope="frame"`` runs
   them down the whole key-sorted frame instead, see ``frame.py``);
3. peer ranks on the unrounded fractions, then rounding.

Shuffles per section (series scope): the cell aggregation, the series
window, the peer window.  The over-cohort adds a small semi-join.  ``run``
builds the four state/metro sections in one pass instead (``fused.py``).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field
from functools import reduce
from typing import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrowth.functions.clean import remove, ytd_months_for
from panelgrowth.operators.filters import ADJUSTED, not_statewide, statewide_only
from panelgrowth.operators.growth import finish_growth, growth_fractions
from panelgrowth.operators.pairing import over_cells, paired_sums, under_rows
from panelgrowth.operators.ranks import MAX_WINDOW_GROUP_ROWS, peer_ranks
from panelgrowth.sinks.writers import RAW_KEYS

# The nation's name and the output columns.
NATION = "United States"
CELL_TAIL = ["supersector_name", "industry_name", "year", "Month"]

NATIONAL_COLUMNS = [
    "supersector_name", "industry_name", "year", "Month", "value", "value_mom",
    "value_ytd_avg", "pct_change_ytd", "rank_ytd", "abs_change_ytd",
    "value_ann_avg", "pct_change_ann", "rank_ann", "abs_change_ann",
    "rank", "pct_change", "abs_change", "area_name", "state_name",
    "pct_change_mom", "rank_mom", "abs_change_mom",
]


def report_columns(entity: str) -> list[str]:
    return [
        entity, "supersector_name", "industry_name", "year", "Month", "value", "value_mom",
        "pct_change_mom", "rank_mom", "abs_change_mom",
        "value_ytd_avg", "pct_change_ytd", "rank_ytd", "abs_change_ytd",
        "value_ann_avg", "pct_change_ann", "rank_ann", "abs_change_ann",
        "pct_change", "rank", "abs_change",
    ]


def _k(ytd_months: int | None, as_of: _dt.date | None) -> int:
    if ytd_months is not None:
        return int(ytd_months)
    if as_of is None:
        raise ValueError("give as_of or ytd_months")
    return ytd_months_for(as_of)


def _fractions(cells: DataFrame, series_keys: list[str], k: int, scope: str) -> DataFrame:
    if scope == "series":
        return growth_fractions(cells, series_keys, k)
    if scope == "frame":
        from panelgrowth.operators.frame import frame_growth_fractions
        return frame_growth_fractions(cells, series_keys + ["year", "Month"], k)
    raise ValueError("scope must be 'series' or 'frame'")


def area_metrics(cells: DataFrame, entity: str, k: int, mom_ties: str = "first",
                 scope: str = "series", rank_strategy: str = "window") -> DataFrame:
    """W1-W11 for one entity level; returns the 21 report columns.

    ``rank_strategy``: ``window`` keeps a peer group in one task (a peer
    group never holds more rows than there are entities); ``sorted`` ranks
    from a distributed sort for entity counts too large for one task; see
    ``run`` for the automatic choice."""
    df = _fractions(cells, [entity, "supersector_name", "industry_name"], k, scope)
    df = peer_ranks(df, entity, strategy=rank_strategy, ranks={
        "rank_mom": ("_f_mom", mom_ties),
        "rank_ytd": ("_f_ytd", "first"),
        "rank_ann": ("_f_ann", "first"),
        "rank": ("_f_yoy", "first"),
    })
    return finish_growth(df).select(*report_columns(entity))


def national_report(ce_panel: DataFrame, as_of: _dt.date | None = None,
                    ytd_months: int | None = None, scope: str = "series",
                    raw_keys: bool = False) -> DataFrame:
    """M1: nation-wide cells, inner pairing, no ranks (blank text).

    The source job orders the table by the names before their clean-up:
    ``raw_keys`` adds them (``RAW_KEYS``) for the writer's index and order."""
    k = _k(ytd_months, as_of)
    cells = paired_sums(ce_panel, CELL_TAIL, how="inner")
    df = finish_growth(_fractions(cells, ["supersector_name", "industry_name"], k, scope))
    blank = F.lit("")
    df = df.withColumns({
        "rank_ytd": blank, "rank_ann": blank, "rank": blank, "rank_mom": blank,
        "area_name": F.lit(NATION), "state_name": F.lit(NATION),
    })
    raw = list(RAW_KEYS.values()) if raw_keys else []
    if raw_keys:
        df = df.withColumns({r: F.col(c) for c, r in RAW_KEYS.items()})
    # names are cleaned after the sums and metrics, as in the source job
    goods = ("Goods-Producing", "Goods Producing")
    df = df.withColumns({
        c: F.replace(remove(c, "\r"), F.lit(goods[0]), F.lit(goods[1]))
        for c in ("industry_name", "supersector_name")
    })
    return df.select(*NATIONAL_COLUMNS, *raw)


def state_report(panel: DataFrame, as_of=None, ytd_months=None, scope="series",
                 rank_strategy: str = "window") -> DataFrame:
    """M2: statewide rows, entity ``state_name``, left pairing."""
    cells = paired_sums(statewide_only(panel), ["state_name"] + CELL_TAIL, how="left")
    return area_metrics(cells, "state_name", _k(ytd_months, as_of), "first", scope, rank_strategy)


def metro_report(panel: DataFrame, as_of=None, ytd_months=None, scope="series",
                 rank_strategy: str = "window") -> DataFrame:
    """M3: non-statewide rows, entity ``area_name``, left pairing."""
    cells = paired_sums(not_statewide(panel), ["area_name"] + CELL_TAIL, how="left")
    return area_metrics(cells, "area_name", _k(ytd_months, as_of), "first", scope, rank_strategy)


def metro_over_report(panel: DataFrame, as_of=None, ytd_months=None, scope="series",
                      threshold: float = 1000.0, size: str = "value",
                      rank_strategy: str = "window") -> DataFrame:
    """M4: all rows of the areas with any adjusted 'Total Nonfarm' row above
    the threshold.  Both measures come from the adjusted rows (as in the
    source job); ``rank_mom`` averages ties.  The cells are written while
    this is called, so the facts are read once."""
    adjusted = panel.filter(F.col("seasonal") == ADJUSTED)
    cells = over_cells(adjusted, ["area_name"] + CELL_TAIL, size, threshold)
    return area_metrics(cells, "area_name", _k(ytd_months, as_of), "average", scope, rank_strategy)


def metro_under_report(panel: DataFrame, as_of=None, ytd_months=None, scope="series",
                       threshold: float = 1000.0, size: str = "value",
                       rank_strategy: str = "window") -> DataFrame:
    """M5: 'Total Nonfarm' rows below the threshold, left pairing;
    ``rank_mom`` averages ties."""
    cells = paired_sums(under_rows(panel, size, threshold), ["area_name"] + CELL_TAIL, how="left")
    return area_metrics(cells, "area_name", _k(ytd_months, as_of), "average", scope, rank_strategy)


def combined_report(states: DataFrame, metros: DataFrame) -> DataFrame:
    """States then metros, metro names in ``state_name``.  Ranks are
    not recomputed over the union."""
    return states.unionByName(metros.withColumnRenamed("area_name", "state_name"))


SM_SECTIONS = {"states", "msa", "msa_over", "msa_under"}

SECTIONS: dict[str, Callable] = {
    "national": national_report,
    "states": state_report,
    "msa": metro_report,
    "msa_over": metro_over_report,
    "msa_under": metro_under_report,
}


def rank_strategies(sm_panel: DataFrame, max_window_rows: int = MAX_WINDOW_GROUP_ROWS) -> dict[str, str]:
    """Window or sorted ranks per entity level.  A peer group holds at most
    one row per entity, so the distinct entity count bounds every group;
    one small aggregation over the (materialized) panel measures it."""
    row = sm_panel.agg(F.count_distinct("state_name").alias("s"),
                       F.count_distinct("area_name").alias("a")).first()
    pick = lambda n: "window" if (n or 0) <= max_window_rows else "sorted"
    return {"state_name": pick(row["s"]), "area_name": pick(row["a"])}


def one_pass(sections: Iterable[str], scope: str = "series", fused: bool = True) -> bool:
    """Whether ``run`` builds the state/metro sections in one pass over the panel."""
    return fused and scope == "series" and SM_SECTIONS <= set(sections)


@dataclass
class Sections:
    """Sink tables by name, and the appended parts of combined tables."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    parts: dict[str, list[DataFrame]] = field(default_factory=dict)


def run(sm_panel: DataFrame | None, ce_panel: DataFrame | None, as_of: _dt.date,
        sections: Iterable[str] = tuple(SECTIONS), scope: str = "series",
        over_threshold: float = 1000.0, under_threshold: float = 1000.0,
        over_size: str = "value", rank_strategy: str = "auto",
        keep: Callable[..., DataFrame] | None = None,
        fused: bool = True, raw_keys: bool = False) -> Sections:
    """M7: build the requested sections.  Sink tables:
    ``national_rankings_t``, ``state_rankings``, ``msa_rankings``,
    ``msa_rankings_under``, ``msa_rankings_over``.  ``state_rankings`` holds
    the states, and the metros too where both were asked for; an unknown section
    name is an error.  The tables are lazy, but choosing the rank strategy and
    ``keep`` run jobs here.

    With ``fused`` (series scope, all four state/metro sections) those
    sections come from one pass (``fused.py``).  ``keep(df, label)`` (for
    example a write to the shared folder and read back) is applied to the
    result that feeds several tables, so it is computed once.  That pass reads
    the state/metro panel once; without it the panel feeds every section, so
    materialize it before calling.  ``raw_keys``: see ``national_report``.
    """
    sections = list(sections)
    unknown = sorted(set(sections) - set(SECTIONS))
    if unknown:
        raise ValueError(f"unknown sections {unknown}; choose from {list(SECTIONS)}")
    res = Sections()
    if "national" in sections:
        res.tables["national_rankings_t"] = national_report(ce_panel, as_of, scope=scope, raw_keys=raw_keys)
    sm_sections = set(sections) - {"national"}
    if not sm_sections:
        return res
    states = metros = under = over = None
    if one_pass(sections, scope, fused):
        from panelgrowth.plans.fused import state_metro_sections
        levels = state_metro_sections(sm_panel, _k(None, as_of), over_threshold, under_threshold,
                                      over_size, rank_strategy=rank_strategy, keep=keep)
        return assemble(levels, res)
    else:
        if rank_strategy == "auto":
            strat = rank_strategies(sm_panel)
        else:
            strat = {"state_name": rank_strategy, "area_name": rank_strategy}
        if "states" in sections:
            states = state_report(sm_panel, as_of, scope=scope, rank_strategy=strat["state_name"])
        if "msa" in sections:
            metros = metro_report(sm_panel, as_of, scope=scope, rank_strategy=strat["area_name"])
            metros = metros.withColumnRenamed("area_name", "state_name")
            if keep is not None:
                metros = keep(metros, "msa_rankings")
        if "msa_under" in sections:
            under = metro_under_report(sm_panel, as_of, scope=scope, threshold=under_threshold,
                                       rank_strategy=strat["area_name"])
        if "msa_over" in sections:
            over = metro_over_report(sm_panel, as_of, scope=scope, threshold=over_threshold,
                                     size=over_size, rank_strategy=strat["area_name"])
    return _filled(res, states, metros, under, over)


def assemble(levels: dict[str, DataFrame], res: Sections | None = None) -> Sections:
    """The sink tables of the four levels of the one pass (``fused.split_levels``)."""
    return _filled(res or Sections(), levels["state"], levels["msa"].withColumnRenamed("area_name", "state_name"),
                   levels["under"], levels["over"])


def _filled(res: Sections, states, metros, under, over) -> Sections:
    if metros is not None:
        res.tables["msa_rankings"] = metros
    parts = [x for x in (states, metros) if x is not None] if states is not None else []
    if parts:
        res.tables["state_rankings"] = reduce(DataFrame.unionByName, parts)
        res.parts["state_rankings"] = parts
    if under is not None:
        res.tables["msa_rankings_under"] = under
    if over is not None:
        res.tables["msa_rankings_over"] = over
    return res


#: Sink table of each section.
SECTION_TABLES = {"national": "national_rankings_t", "states": "state_rankings", "msa": "msa_rankings",
                  "msa_over": "msa_rankings_over", "msa_under": "msa_rankings_under"}
