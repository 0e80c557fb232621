"""The monthly job end to end.

    python -m panelgrowth.plans.job --landing DIR --lookups DIR --out DIR --as-of 2024-03-15

reads the two text feeds from a landing folder and the lookups from a
lookup source, builds both panels, computes the requested sections and
replaces the report tables.

Scale notes
-----------
* The series lookup is filtered to the flags the panels keep (seasonal U/S,
  employment data type) before its size check, so a lookup that is too big
  to broadcast whole is often small enough once filtered.
* The four state/metro sections come from one aggregation of the panel,
  whose cells are written once under the session's shared checkpoint folder
  and read back.  Fewer sections, or the frame scope, write the panel there
  instead.
"""

from __future__ import annotations

import argparse
import json
import datetime as _dt
from concurrent.futures import ThreadPoolExecutor
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelgrowth.functions.clean import zero_pad
from panelgrowth.operators.filters import ADJUSTED, EMPLOYMENT_TYPE, UNADJUSTED
from panelgrowth.plans import reports as R
from panelgrowth.plans.panels import (
    enrich_national, enrich_state_metro, national_panel, state_metro_panel,
)
from panelgrowth.sinks.publish import Run, fingerprint
from panelgrowth.sinks.writers import SinkTarget, materialize, write_reports, write_table
from panelgrowth.sources.feeds import LookupSource, date_ref_row, read_facts, read_lookup

# The feed files the job reads (the state/metro file and the
# eleven national current-employment files), and the lookup table names.
SM_FILES = ("sm.data.1.AllData",)
CE_FILES = (
    "ce.data.07.TotMinConAECurr",
    "ce.data.08.ManufactureAECurr",
    "ce.data.09.ServProvTradeAECurr",
    "ce.data.10.TransWhUtsAECurr",
    "ce.data.11.InfoAECurr",
    "ce.data.12.FinActAECurr",
    "ce.data.13.ProfBusAECurr",
    "ce.data.14.EducHealthAECurr",
    "ce.data.15.LeisHospAECurr",
    "ce.data.16.OtherServicesAECurr",
    "ce.data.17.GovtAECurr",
)
SM_LOOKUPS = ("sm_state", "sm_supersector", "sm_series", "sm_industry", "sm_area")
CE_LOOKUPS = ("ce_series", "ce_industry", "ce_supersector")


def feed_paths(landing_dir: str, suffix: str = ".txt") -> dict[str, list[str]]:
    """Feed name -> file paths in the landing folder."""
    base = landing_dir.rstrip("/")
    return {"sm": [f"{base}/{f}{suffix}" for f in SM_FILES],
            "ce": [f"{base}/{f}{suffix}" for f in CE_FILES]}


def _prefilter_series(series: DataFrame, with_data_type: bool) -> DataFrame:
    cond = None
    if "seasonal" in series.columns:
        cond = F.col("seasonal").isin(UNADJUSTED, ADJUSTED)
    if with_data_type and "data_type_code" in series.columns:
        dt = zero_pad(F.col("data_type_code").cast("string"), 2) == F.lit(EMPLOYMENT_TYPE)
        cond = dt if cond is None else cond & dt
    return series if cond is None else series.filter(cond)


def build_state_metro_panel(spark: SparkSession, paths, lookups: LookupSource) -> DataFrame:
    """M0a from the state/metro feed file(s) and its five lookups."""
    lk = {n: read_lookup(spark, lookups, n) for n in SM_LOOKUPS}
    facts = read_facts(spark, paths, strip_value=True)
    return state_metro_panel(enrich_state_metro(
        facts, lk["sm_state"], lk["sm_supersector"],
        _prefilter_series(lk["sm_series"], with_data_type=True),
        lk["sm_industry"], lk["sm_area"]))


def build_national_panel(spark: SparkSession, paths, lookups: LookupSource) -> DataFrame:
    """M0b from the national feed files and their three lookups."""
    lk = {n: read_lookup(spark, lookups, n) for n in CE_LOOKUPS}
    facts = read_facts(spark, paths, strip_value=True)
    return national_panel(enrich_national(
        facts, _prefilter_series(lk["ce_series"], with_data_type=False),
        lk["ce_industry"], lk["ce_supersector"]))


def build_panels(spark: SparkSession, landing_dir: str, lookups: LookupSource,
                 feeds: dict[str, list[str]] | None = None) -> tuple[DataFrame, DataFrame]:
    """M0a + M0b from the feeds."""
    feeds = feeds or feed_paths(landing_dir)
    return (build_state_metro_panel(spark, feeds["sm"], lookups),
            build_national_panel(spark, feeds["ce"], lookups))


def concurrently(*thunks):
    """Run independent Spark actions from separate threads (Spark schedules
    jobs from different threads side by side); returns their results."""
    thunks = [t for t in thunks if t is not None]
    if len(thunks) <= 1:
        return [t() for t in thunks]
    with ThreadPoolExecutor(max_workers=len(thunks)) as pool:
        futures = [pool.submit(t) for t in thunks]
        return [f.result() for f in futures]


def run_monthly(spark: SparkSession, sm_panel: DataFrame | None, ce_panel: DataFrame | None,
                target: SinkTarget, as_of: _dt.date, sections: Iterable[str] = tuple(R.SECTIONS),
                scope: str = "series", index: bool = False, materialize_panels: bool = True,
                over_threshold: float = 1000.0, under_threshold: float = 1000.0,
                over_size: str = "value", fused: bool = True,
                rank_strategy: str = "auto", sort: bool = False) -> dict[str, DataFrame]:
    """M7 + M8 + K6: compute the sections and replace the tables.

    Independent work runs side by side: the two panels are materialized
    together (the state/metro panel only where several passes read it), then
    the national branch and the state/metro branch are built and written
    together."""
    sections = list(sections)
    sm_sections = [x for x in sections if x != "national"]
    if materialize_panels:
        # one pass reads the state/metro panel once: nothing to write for it
        keep_sm = sm_panel is not None and sm_sections and not R.one_pass(sections, scope, fused)
        sm_panel, ce_panel = concurrently(
            (lambda: materialize(sm_panel, "sm_panel")) if keep_sm else (lambda: sm_panel),
            (lambda: materialize(ce_panel, "ce_panel")) if ce_panel is not None and "national" in sections
            else (lambda: ce_panel))

    def branch(which: list[str]) -> dict[str, DataFrame]:
        built = R.run(sm_panel, ce_panel, as_of, which, scope,
                      over_threshold, under_threshold, over_size, rank_strategy=rank_strategy,
                      keep=materialize, fused=fused, raw_keys=index or sort)
        concurrently(*[
            (lambda n=n, d=d: write_reports({n: d}, target, index=index,
                                            entity_parts=built.parts, sort=sort))
            for n, d in built.tables.items()])
        return built.tables

    dated = date_ref_row(spark, as_of)
    if index:
        dated = dated.select(F.lit(0).cast("long").alias("index"), *dated.columns)
    results = concurrently(
        (lambda: branch(["national"])) if "national" in sections else None,
        (lambda: branch(sm_sections)) if sm_sections else None,
        lambda: write_table(dated, "date_ref_t", target))
    tables: dict[str, DataFrame] = {}
    for r in results:
        if isinstance(r, dict):
            tables.update(r)
    return tables


def run_published(spark: SparkSession, landing_dir: str, lookups: LookupSource, target: SinkTarget,
                  as_of: _dt.date, sections: Iterable[str] = tuple(R.SECTIONS), scope: str = "series",
                  index: bool = False, sort: bool = False, over_threshold: float = 1000.0,
                  under_threshold: float = 1000.0, over_size: str = "value",
                  feeds: dict[str, list[str]] | None = None, version: str = "") -> str:
    """M7 + M8 + K6 + K8: the monthly job from the feeds, whose tables appear
    together and whose rerun skips what is finished; returns the run's name.

    The run is named by its inputs: feed and lookup files by size and time, and the
    parameters (``version`` stands for lookups that are not files, and for anything
    else that should start anew).  Finished tables and the cells and metrics between
    them are noted (``sinks/publish.py``); a rerun builds a panel only where a
    table that needs it is missing, so after a fault in the last writes it reads no
    facts.  Read the tables with ``read_published``."""
    sections = list(sections)
    unknown = sorted(set(sections) - set(R.SECTIONS))
    if unknown:
        raise ValueError(f"unknown sections {unknown}; choose from {list(R.SECTIONS)}")
    feeds = feeds or feed_paths(landing_dir)
    read = [f for f, wanted in (("ce", "national" in sections), ("sm", set(sections) - {"national"})) if wanted]
    used = [p for f in read for p in feeds[f]]
    files = [] if lookups.fmt == "jdbc" else [lookups.base]
    run = Run(spark, target, fingerprint(
        spark, [*used, *files], as_of=as_of, sections=sorted(sections), scope=scope, index=index, sort=sort,
        thresholds=[over_threshold, under_threshold, over_size], fmt=target.fmt, version=version))
    sm_tables = [R.SECTION_TABLES[x] for x in sections if x != "national"]

    def write_all(built: R.Sections, tables: list[str]) -> None:
        concurrently(*[
            (lambda n=n: run.write(n, lambda to: write_reports({n: built.tables[n]}, to, index=index,
                                                               entity_parts=built.parts, sort=sort)))
            for n in tables if not run.has(n)])

    def national() -> None:
        table = R.SECTION_TABLES["national"]
        if "national" in sections and not run.has(table):
            panel = build_national_panel(spark, feeds["ce"], lookups)
            write_all(R.run(None, panel, as_of, ["national"], scope, raw_keys=index or sort), [table])

    def state_metro() -> None:
        if all(run.has(n) for n in sm_tables):
            return
        if R.one_pass(sections, scope) and run.has("state_metro_metrics"):
            from panelgrowth.plans.fused import split_levels
            built = R.assemble(split_levels(run.read("state_metro_metrics")))
        else:
            if R.one_pass(sections, scope):
                panel = build_state_metro_panel(spark, feeds["sm"], lookups)
            elif run.has("sm_panel"):
                panel = run.read("sm_panel")
            else:
                panel = run.keep(build_state_metro_panel(spark, feeds["sm"], lookups), "sm_panel")
            which = [x for x in sections if x != "national"]
            # tables that feed others are kept under names of their own
            built = R.run(panel, None, as_of, which, scope, over_threshold, under_threshold, over_size,
                          keep=lambda df, label, **how: run.keep(
                              df, label if label in ("entity_cells", "state_metro_metrics") else f"kept_{label}", **how),
                          raw_keys=index or sort)
        write_all(built, sm_tables)

    def dated() -> None:
        row = date_ref_row(spark, as_of)
        if index:
            row = row.select(F.lit(0).cast("long").alias("index"), *row.columns)
        run.write("date_ref_t", lambda to: write_table(row, "date_ref_t", to))

    concurrently(national, state_metro, dated)
    run.publish(["date_ref_t", *[R.SECTION_TABLES[x] for x in sections]])
    return run.name


def main(argv=None) -> None:
    from panelgrowth.session import DEFAULT_CONF, get_spark
    p = argparse.ArgumentParser(description="monthly panel growth job")
    p.add_argument("--landing", required=True, help="folder with the feed .txt files")
    p.add_argument("--lookups", required=True, help="lookup base folder (or JDBC URL with --lookup-format jdbc)")
    p.add_argument("--lookup-format", default="parquet")
    p.add_argument("--out", required=True, help="output base folder (or JDBC URL with --out-format jdbc)")
    p.add_argument("--out-format", default="parquet")
    p.add_argument("--as-of", required=True, help="run date, YYYY-MM-DD")
    p.add_argument("--sections", default=",".join(R.SECTIONS))
    p.add_argument("--scope", default="series", choices=("series", "frame"))
    p.add_argument("--index", action="store_true", help="write the positional index column")
    p.add_argument("--sort", action="store_true", help="write rows in key order")
    p.add_argument("--together", action="store_true",
                   help="replace all tables at once and let a rerun skip finished sections (file outputs)")
    p.add_argument("--master", default=None)
    p.add_argument("--jdbc-options", default=None,
                   help="JSON file: lookup_properties, lookup_partitions (by table), lookup_keys "
                        "(by table: key column, parts), out_properties")
    a = p.parse_args(argv)
    spark = get_spark(master=a.master) if a.master else SparkSession.builder.getOrCreate()
    # the session settings of get_spark, where the submitter set none
    given = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql.") and not given.contains(k):
            spark.conf.set(k, v)
    jdbc: dict = {}
    if a.jdbc_options:
        with open(a.jdbc_options) as f:
            jdbc = json.load(f)
    if a.lookup_format == "jdbc":
        lookups = LookupSource("jdbc", url=a.lookups, properties=jdbc.get("lookup_properties", {}),
                               partitions=jdbc.get("lookup_partitions", {}),
                               keyed={k: tuple(v) for k, v in jdbc.get("lookup_keys", {}).items()})
    else:
        lookups = LookupSource(a.lookup_format, a.lookups)
    target = (SinkTarget("jdbc", url=a.out, properties=jdbc.get("out_properties", {})) if a.out_format == "jdbc"
              else SinkTarget(a.out_format, a.out))
    how = {"sections": a.sections.split(","), "scope": a.scope, "index": a.index, "sort": a.sort}
    as_of = _dt.date.fromisoformat(a.as_of)
    if a.together:
        run_published(spark, a.landing, lookups, target, as_of, **how)
    else:
        run_monthly(spark, *build_panels(spark, a.landing, lookups), target, as_of, **how)


if __name__ == "__main__":
    main()
