"""

Every query reads the test tables under ``sf_dir`` (through the analog
panel of ``panelgrowth.sources.analog``, or the same panel encoded as text
feeds and coded lookups) and returns a lazy DataFrame; every oracle is the
same query as DuckDB SQL over the same tables.  Sections below: reports,
building blocks (one operator each), scalar functions, filters / enrichment
/ sources / sinks, the feed path, the fused pass, frame scope.
"""

from __future__ import annotations

import datetime as _dt
import os
import sys
from collections.abc import Callable

# the engine package sits next to this file; make it importable however this
# module is loaded
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from panelgrowth import oracle as O  # noqa: E402
from panelgrowth.functions.clean import (  # noqa: E402
    lenient_double, month_from_period, pct_round, remove, round2, strip_all, zero_pad,
)
from panelgrowth.operators.filters import (  # noqa: E402
    ADJUSTED, area_exclusion, not_statewide, statewide_only,
)
from panelgrowth.operators.growth import finish_growth, growth_fractions  # noqa: E402
from panelgrowth.operators.pairing import over_cohort, paired_sums, single_sums, under_rows  # noqa: E402
from panelgrowth.operators.ranks import with_peer_ranks  # noqa: E402
from panelgrowth.plans import reports as R  # noqa: E402
from panelgrowth.plans.panels import (  # noqa: E402
    clean_state_metro, national_panel, split_state_metro, state_metro_panel,
)
from panelgrowth.sinks.writers import (  # noqa: E402
    SinkTarget, scratch_path, write_feed_tsv, write_reports,
)
from panelgrowth.sources.analog import (  # noqa: E402
    analog_facts, analog_feed_text, analog_national_facts, edge_facts, edge_national_facts, table,
)
from panelgrowth.sources.feeds import date_ref_from_column, read_facts  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
# Query parameters (not data): run date and cohort thresholds for the analog.
AS_OF = _dt.date(2001, 12, 1)          # year-to-date width k = 11
K = AS_OF.month - 1
OVER_SIZE = "size"                     # l_extendedprice
OVER_THRESHOLD = 104200.0              # splits the cleaned metro areas at sf0.01 (7 of 13)
UNDER_THRESHOLD = 40.0
TAIL = ["supersector_name", "industry_name", "year", "Month"]
NOT_STATEWIDE_SQL = "area_name IS DISTINCT FROM 'Statewide'"
STATEWIDE_SQL = "area_name = 'Statewide'"


def _panel(spark: SparkSession, sf: str) -> DataFrame:
    return state_metro_panel(analog_facts(spark, sf), extra=("size",))


def _national_panel(spark: SparkSession, sf: str) -> DataFrame:
    return national_panel(analog_national_facts(spark, sf))


def _metro_cells(spark, sf):
    return paired_sums(not_statewide(_panel(spark, sf)), ["area_name"] + TAIL, "left")


def _state_cells(spark, sf):
    return paired_sums(statewide_only(_panel(spark, sf)), ["state_name"] + TAIL, "left")


def _metrics(cells: DataFrame, entity: str) -> DataFrame:
    return finish_growth(growth_fractions(cells, [entity, "supersector_name", "industry_name"], K))


# --- reports ---------------------------------------------------------------

def q_national_report(spark, sf):
    return R.national_report(_national_panel(spark, sf), AS_OF)


def q_state_report(spark, sf):
    return R.state_report(_panel(spark, sf), AS_OF)


def q_metro_report(spark, sf):
    return R.metro_report(_panel(spark, sf), AS_OF)


def q_metro_over_report(spark, sf):
    return R.metro_over_report(_panel(spark, sf), AS_OF, threshold=OVER_THRESHOLD, size=OVER_SIZE)


def q_metro_under_report(spark, sf):
    return R.metro_under_report(_panel(spark, sf), AS_OF, threshold=UNDER_THRESHOLD)


def q_state_report_nation(spark, sf):
    panel = state_metro_panel(analog_facts(spark, sf, state_level="nation"), extra=("size",))
    return R.state_report(panel, AS_OF)


def q_combined_report(spark, sf):
    from panelgrowth.plans.fused import combined_section
    return combined_section(_panel(spark, sf), AS_OF)


def q_combined_sections(spark, sf):
    """The two sections computed alone, appended."""
    panel = _panel(spark, sf)
    return R.combined_report(R.state_report(panel, AS_OF), R.metro_report(panel, AS_OF))


# --- building blocks ---------------------------------------------------------

def q_paired_sums_left(spark, sf):
    return _metro_cells(spark, sf)


def q_paired_sums_inner(spark, sf):
    return paired_sums(_national_panel(spark, sf), TAIL, "inner")


def q_lag_growth_12(spark, sf):
    return _metrics(_metro_cells(spark, sf), "area_name").select(
        "area_name", *TAIL, "value", "pct_change", "abs_change")


def q_lag_growth_1(spark, sf):
    return _metrics(_metro_cells(spark, sf), "area_name").select(
        "area_name", *TAIL, "value_mom", "pct_change_mom", "abs_change_mom")


def q_rolling_mean_12(spark, sf):
    return _metrics(_state_cells(spark, sf), "state_name").select(
        "state_name", *TAIL, "value", "value_ann_avg")


def q_rolling_mean_ytd(spark, sf):
    return _metrics(_state_cells(spark, sf), "state_name").select(
        "state_name", *TAIL, "value", "value_ytd_avg")


def q_growth_ann(spark, sf):
    return _metrics(_state_cells(spark, sf), "state_name").select(
        "state_name", *TAIL, "value_ann_avg", "pct_change_ann", "abs_change_ann")


def q_growth_ytd(spark, sf):
    return _metrics(_state_cells(spark, sf), "state_name").select(
        "state_name", *TAIL, "value_ytd_avg", "pct_change_ytd", "abs_change_ytd")


def q_rank_first(spark, sf):
    cells = _state_cells(spark, sf)
    df = growth_fractions(cells, ["state_name", "supersector_name", "industry_name"], K)
    return with_peer_ranks(df, "state_name", {"rank": ("_f_yoy", "first")}).select(
        "state_name", *TAIL, "rank")


def q_rank_average(spark, sf):
    cells = _metro_cells(spark, sf)
    df = growth_fractions(cells, ["area_name", "supersector_name", "industry_name"], K)
    return with_peer_ranks(df, "area_name", {"rank_mom": ("_f_mom", "average")}).select(
        "area_name", *TAIL, "rank_mom")


def q_cohort_over_semi(spark, sf):
    adjusted = _panel(spark, sf).filter(F.col("seasonal") == ADJUSTED)
    return over_cohort(adjusted, "area_name", OVER_SIZE, OVER_THRESHOLD).select(
        "area_name", "state_name", *TAIL, "value")


def q_cohort_under_rows(spark, sf):
    return under_rows(_panel(spark, sf), "value", UNDER_THRESHOLD).select(
        "area_name", "state_name", *TAIL, "value", "seasonal")


# --- scalar functions ----------------------------------------------------------

IDS = ["l_orderkey", "l_linenumber"]


def q_strip_text(spark, sf):
    feed = analog_feed_text(spark, sf)
    return feed.select(*[strip_all(c).alias(c) for c in ("series_id", "year", "value")])


def q_zero_pad(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*IDS,
                     zero_pad(F.col("l_suppkey").cast("string"), 5).alias("area_code"),
                     zero_pad(F.col("l_partkey").cast("string"), 8).alias("industry_code"),
                     zero_pad(F.col("l_linenumber").cast("string"), 2).alias("data_type_code"),
                     zero_pad(F.col("l_orderkey").cast("string"), 4).alias("order_code"))


def q_remove_substrings(spark, sf):
    raw = analog_facts(spark, sf, with_ids=True)
    return raw.select(*IDS,
                      remove(remove("area_name", " NECTA"), "Metropolitan Statistical Area")
                      .alias("area_name"),
                      remove("state_name", "\r").alias("state_name"),
                      remove("supersector_name", "\r").alias("supersector_name"))


def q_month_from_period(spark, sf):
    raw = analog_facts(spark, sf, with_ids=True)
    return raw.select(*IDS, "period", month_from_period("period").alias("Month"))


def q_lenient_numeric(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        *IDS,
        lenient_double(strip_all(F.lpad(F.col("l_quantity").cast("string"), 12, " "))).alias("value"),
        lenient_double(F.col("l_extendedprice").cast("string")).alias("price"),
        lenient_double("l_returnflag").alias("flag_value"))


def q_round_half_even(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(*IDS,
                     round2(F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
                     pct_round(F.col("l_discount")).alias("discount_pct"),
                     round2(F.col("l_quantity") / F.lit(8.0)).alias("eighths"))


# --- filters, enrichment, sources, sinks -----------------------------------------

PANEL_COLS = ["area_name", "state_name", "supersector_name", "industry_name", "Month", "year",
              "value", "data_type_code", "seasonal"]


def _id_panel(spark, sf, seasonal=("U", "S")):
    return split_state_metro(clean_state_metro(analog_facts(spark, sf, with_ids=True),
                                               extra=IDS), seasonal)


def q_area_exclusion(spark, sf):
    return area_exclusion(analog_facts(spark, sf, with_ids=True)).select(*IDS, "area_name")


def q_panel_split_u(spark, sf):
    return _id_panel(spark, sf, "U").select(*IDS, *PANEL_COLS)


def q_panel_split_s(spark, sf):
    return _id_panel(spark, sf, "S").select(*IDS, *PANEL_COLS)


def q_national_split(spark, sf):
    from panelgrowth.operators.filters import national_split_condition
    facts = analog_national_facts(spark, sf, with_ids=True)
    return (facts.filter(national_split_condition(("U", "S")))
            .withColumn("Month", month_from_period("period"))
            .select(*IDS, "supersector_name", "industry_name", "Month", "year", "value", "seasonal"))


def q_statewide_only(spark, sf):
    return statewide_only(_id_panel(spark, sf)).select(*IDS, *PANEL_COLS)


def q_not_statewide(spark, sf):
    return not_statewide(_id_panel(spark, sf)).select(*IDS, *PANEL_COLS)


def q_enrich_state_metro(spark, sf):
    cleaned = clean_state_metro(analog_facts(spark, sf, with_ids=True), extra=IDS)
    return cleaned.select(*IDS, "area_name", "state_name", "supersector_name", "industry_name",
                          "period", "year", "value", "data_type_code", "seasonal")


def q_enrich_national(spark, sf):
    return analog_national_facts(spark, sf, with_ids=True)


def q_run_date_row(spark, sf):
    return date_ref_from_column(table(spark, sf, "lineitem"), "l_shipdate")


def q_read_tsv_round_trip(spark, sf):
    path = scratch_path(spark, "feed")
    write_feed_tsv(analog_feed_text(spark, sf), path)
    facts = read_facts(spark, path)
    return facts.withColumn("value", lenient_double("value"))


def q_append_files(spark, sf):
    feed = analog_feed_text(spark, sf)
    a, b = scratch_path(spark, "feed-a"), scratch_path(spark, "feed-b")
    write_feed_tsv(feed.filter(F.col("footnote_codes").isNull()), a)
    write_feed_tsv(feed.filter(F.col("footnote_codes").isNotNull()), b)
    facts = read_facts(spark, [a, b])
    return facts.withColumn("value", lenient_double("value"))


def q_sink_round_trip(spark, sf):
    from panelgrowth.plans.fused import fused_metrics, split_levels
    from panelgrowth.sinks.writers import materialize
    metrics = materialize(fused_metrics(_panel(spark, sf), K, levels=("state", "msa")), "levels", partition_by=["level"])
    levels = split_levels(metrics)
    states, metros = levels["state"], levels["msa"]
    combined = R.combined_report(states, metros)
    target = SinkTarget("parquet", scratch_path(spark, "reports"))
    write_reports({"state_rankings": combined}, target, index=True,
                  entity_parts={"state_rankings": [
                      states, metros.withColumnRenamed("area_name", "state_name")]})
    return spark.read.parquet(target.path("state_rankings"))


# --- the analog as real feeds: text facts + coded lookups -> readers -> joins ------

FEED_OVER_THRESHOLD = 49.0             # on value (the feed has no size column)
_LANDINGS: dict = {}


def _landing(spark, sf):
    from panelgrowth.sources.analog import write_analog_landing
    key = (spark.sparkContext.applicationId, sf)
    if key not in _LANDINGS:
        _LANDINGS[key] = write_analog_landing(spark, sf)
    return _LANDINGS[key]


def _feed_sm_panel(spark, sf):
    from panelgrowth.plans.job import build_state_metro_panel, feed_paths
    landing, lookups = _landing(spark, sf)
    return build_state_metro_panel(spark, feed_paths(landing)["sm"], lookups)


def _feed_ce_panel(spark, sf):
    from panelgrowth.plans.job import build_national_panel, feed_paths
    landing, lookups = _landing(spark, sf)
    return build_national_panel(spark, feed_paths(landing)["ce"], lookups)


def q_feed_state_report(spark, sf):
    return R.state_report(_feed_sm_panel(spark, sf), AS_OF)


def q_feed_metro_report(spark, sf):
    return R.metro_report(_feed_sm_panel(spark, sf), AS_OF)


def q_feed_metro_under_report(spark, sf):
    return R.metro_under_report(_feed_sm_panel(spark, sf), AS_OF, threshold=UNDER_THRESHOLD)


def q_feed_metro_over_report(spark, sf):
    return R.metro_over_report(_feed_sm_panel(spark, sf), AS_OF, threshold=FEED_OVER_THRESHOLD)


def q_feed_national_report(spark, sf):
    return R.national_report(_feed_ce_panel(spark, sf), AS_OF)


def q_feed_panel(spark, sf):
    return _feed_sm_panel(spark, sf)


# --- fused state/metro sections ------------------------------------------------

def q_fused_sections(spark, sf):
    from panelgrowth.plans.fused import fused_metrics
    return fused_metrics(_panel(spark, sf), K, OVER_THRESHOLD, UNDER_THRESHOLD, over_size=OVER_SIZE)


def q_rank_first_sorted(spark, sf):
    cells = _state_cells(spark, sf)
    df = growth_fractions(cells, ["state_name", "supersector_name", "industry_name"], K)
    from panelgrowth.operators.ranks import peer_ranks
    return peer_ranks(df, "state_name", {"rank": ("_f_yoy", "first")}, strategy="sorted").select(
        "state_name", *TAIL, "rank")


def q_rank_average_sorted(spark, sf):
    cells = _metro_cells(spark, sf)
    df = growth_fractions(cells, ["area_name", "supersector_name", "industry_name"], K)
    from panelgrowth.operators.ranks import peer_ranks
    return peer_ranks(df, "area_name", {"rank_mom": ("_f_mom", "average")}, strategy="sorted").select(
        "area_name", *TAIL, "rank_mom")


def q_state_report_frame(spark, sf):
    return R.state_report(_panel(spark, sf), AS_OF, scope="frame")


def q_metro_over_report_frame(spark, sf):
    return R.metro_over_report(_panel(spark, sf), AS_OF, scope="frame", threshold=OVER_THRESHOLD,
                               size=OVER_SIZE)


def q_metro_under_report_frame(spark, sf):
    return R.metro_under_report(_panel(spark, sf), AS_OF, scope="frame", threshold=UNDER_THRESHOLD)


# --- frame scope -------------------------------------------------------------

METRO_KEYS = ["area_name"] + TAIL


def _frame_metrics(cells: DataFrame, entity: str, keep_index: bool = False) -> DataFrame:
    from panelgrowth.operators.frame import frame_growth_fractions
    keys = [entity, "supersector_name", "industry_name", "year", "Month"]
    return finish_growth(frame_growth_fractions(cells, keys, K, keep_index=keep_index))


def q_frame_index(spark, sf):
    from panelgrowth.operators.frame import series_index
    return series_index(_metro_cells(spark, sf), METRO_KEYS[:3]).select(*METRO_KEYS, "value", "frame_index")


def q_frame_lag_growth_12(spark, sf):
    return _frame_metrics(_metro_cells(spark, sf), "area_name").select(
        *METRO_KEYS, "value", "pct_change", "abs_change")


def q_frame_lag_growth_1(spark, sf):
    return _frame_metrics(_metro_cells(spark, sf), "area_name").select(
        *METRO_KEYS, "value_mom", "pct_change_mom", "abs_change_mom")


def q_frame_rolling_mean(spark, sf):
    return _frame_metrics(_metro_cells(spark, sf), "area_name").select(
        *METRO_KEYS, "value_ytd_avg", "value_ann_avg", "pct_change_ytd", "abs_change_ytd",
        "pct_change_ann", "abs_change_ann")


def q_metro_report_frame(spark, sf):
    return R.metro_report(_panel(spark, sf), AS_OF, scope="frame")


def q_national_report_frame(spark, sf):
    return R.national_report(_national_panel(spark, sf), AS_OF, scope="frame")


def q_national_index(spark, sf):
    """K7: numbered by the names before their clean-up, which here merges two."""
    from panelgrowth.sinks.writers import SinkTarget, scratch_path, write_reports
    name = F.col("supersector_name")
    panel = _national_panel(spark, sf).withColumn(
        "supersector_name", F.when(name == "BUILDING", "Goods-Producing")
        .when(name == "MACHINERY", "Goods Producing\r").otherwise(name))
    target = SinkTarget("parquet", scratch_path(spark, "national"))
    write_reports({"national_rankings_t": R.national_report(panel, AS_OF, raw_keys=True)}, target, index=True)
    return spark.read.parquet(target.path("national_rankings_t"))


def _monthly_table(table: str):
    """K1, K3-K6, M8: a table of the whole monthly job, read back."""
    def query(spark, sf):
        from panelgrowth.plans.job import run_monthly
        from panelgrowth.sinks.writers import SinkTarget, scratch_path
        target = SinkTarget("parquet", scratch_path(spark, "monthly"))
        run_monthly(spark, _panel(spark, sf), _national_panel(spark, sf), target, AS_OF,
                    over_threshold=OVER_THRESHOLD, under_threshold=UNDER_THRESHOLD, over_size="size")
        return spark.read.parquet(target.path(table))
    return query


# --- values that the rules act on (edge analog) -----------------------------------

EDGE_UNDER = 2000.0                    # on value, an eighth of the price


def _edge_panel(spark, sf):
    return state_metro_panel(edge_facts(spark, sf), extra=("size",))


def q_edge_panel(spark, sf):
    """Rows of the panel, with an excluded state, missing names and values."""
    return split_state_metro(clean_state_metro(edge_facts(spark, sf, with_ids=True), extra=IDS)).select(
        *IDS, *PANEL_COLS)


def q_edge_state_report(spark, sf):
    return R.state_report(_edge_panel(spark, sf), AS_OF)


def q_edge_state_report_january(spark, sf):
    """k = 0: the year-to-date columns are missing."""
    return R.state_report(_edge_panel(spark, sf), _dt.date(2002, 1, 5))


def q_edge_state_report_march(spark, sf):
    """k = 2."""
    return R.state_report(_edge_panel(spark, sf), _dt.date(2001, 3, 5))


def q_edge_metro_report(spark, sf):
    return R.metro_report(_edge_panel(spark, sf), AS_OF)


def q_edge_metro_report_sorted(spark, sf):
    """W10, W11 over many ties, from one range sort."""
    return R.metro_report(_edge_panel(spark, sf), AS_OF, rank_strategy="sorted")


def q_edge_metro_under_report(spark, sf):
    return R.metro_under_report(_edge_panel(spark, sf), AS_OF, threshold=EDGE_UNDER)


def q_edge_metro_over_report(spark, sf):
    return R.metro_over_report(_edge_panel(spark, sf), AS_OF, threshold=OVER_THRESHOLD, size=OVER_SIZE)


def q_edge_metro_report_frame(spark, sf):
    """Fills over missing values that reach across series."""
    return R.metro_report(_edge_panel(spark, sf), AS_OF, scope="frame")


def q_edge_national_report(spark, sf):
    return R.national_report(national_panel(edge_national_facts(spark, sf)), AS_OF)


def q_edge_strip_text(spark, sf):
    """Fields padded with every white-space character on both sides."""
    li = table(spark, sf, "lineitem")
    pad = lambda c: F.concat(F.lit(" \t\r"), c.cast("string"), F.lit("\x0b\x0c\n "))
    return li.select(*IDS, strip_all(pad(F.col("l_quantity"))).alias("value"),
                     strip_all(pad(F.concat_ws("\t", "l_returnflag", "l_linestatus"))).alias("flags"),
                     strip_all(F.concat(F.lit("\t"), F.lit("\r\n"))).alias("blank"))


def q_paired_sums_fractional(spark, sf):
    """Sums of prices, whatever the order of the rows."""
    panel = _panel(spark, sf).withColumn("value", F.col("size"))
    return paired_sums(statewide_only(panel), ["state_name"] + TAIL, "left")


def q_single_sums_fractional(spark, sf):
    return single_sums(not_statewide(_panel(spark, sf)).withColumn("value", F.col("size")), ["area_name"] + TAIL)


def q_salted_enrichment(spark, sf):
    """Lines joined to their orders' attributes with the hot keys salted; a third of
    the lines carry one key."""
    from panelgrowth.operators.enrich import hot_keys, salted_join
    li = table(spark, sf, "lineitem")
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.col("l_suppkey"))
    facts = li.select(*IDS, key.cast("long").alias("code"), "l_quantity")
    supplier = table(spark, sf, "supplier")
    lookup = supplier.select(F.col("s_suppkey").cast("long").alias("code"), "s_name").unionByName(
        supplier.agg(F.lit(-1).cast("long").alias("code"), F.lit("hot").alias("s_name")))
    return salted_join(facts, lookup, ["code"], hot_keys(facts, ["code"], share=0.2), salts=8)


def q_feed_load_report(spark, sf):
    """A feed of three folders, one listed twice, and an empty file."""
    from panelgrowth.sources.feeds import feed_headers, load_by_feed, load_report
    feed = analog_feed_text(spark, sf)
    paths = {x: scratch_path(spark, f"feed-{x}") for x in ("open", "shipped", "none")}
    write_feed_tsv(feed.filter(F.col("footnote_codes").isNotNull()), paths["open"])
    write_feed_tsv(feed.filter(F.col("footnote_codes").isNull()), paths["shipped"])
    spark.createDataFrame([("\t".join(feed.columns),)], "line string").coalesce(1).write.text(paths["none"])
    listed = [paths["open"], paths["shipped"], paths["none"], paths["open"]]
    files = feed_headers(spark, listed)
    facts = read_facts(spark, listed, file_column="source_file", files=files)
    return load_by_feed(load_report(files, facts, "source_file"), F.regexp_extract("file", "feed-([a-z]+)-", 1))


def q_published_under(spark, sf):
    """K8, M7: a table of a set that was published at once, from the text feeds."""
    from panelgrowth.plans.job import run_published
    from panelgrowth.sinks.publish import read_published
    target = SinkTarget("parquet", scratch_path(spark, "published"))
    landing, lookups = _landing(spark, sf)
    run_published(spark, landing, lookups, target, AS_OF, over_threshold=FEED_OVER_THRESHOLD,
                  under_threshold=UNDER_THRESHOLD)
    return read_published(spark, target, "msa_rankings_under")


def q_monthly_date_ref(spark, sf):
    """K6: the run-date table of the whole job, of a run date taken from the data."""
    from panelgrowth.plans.job import run_monthly
    target = SinkTarget("parquet", scratch_path(spark, "dated"))
    as_of = table(spark, sf, "lineitem").agg(F.max("l_shipdate").cast("date")).first()[0]
    run_monthly(spark, _panel(spark, sf), _national_panel(spark, sf), target, as_of,
                over_threshold=OVER_THRESHOLD, under_threshold=UNDER_THRESHOLD, over_size="size")
    return spark.read.parquet(target.path("date_ref_t"))


def q_states_only_tables(spark, sf):
    """M7: one section alone; its table holds the states without the metros."""
    from panelgrowth.plans.job import run_monthly
    target = SinkTarget("parquet", scratch_path(spark, "states-only"))
    run_monthly(spark, _panel(spark, sf), None, target, AS_OF, sections=["states"])
    return spark.read.parquet(target.path("state_rankings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **{f.__name__[2:]: f for f in (
        q_edge_panel, q_edge_state_report, q_edge_state_report_january, q_edge_state_report_march,
        q_edge_metro_report, q_edge_metro_report_sorted, q_edge_metro_under_report, q_edge_metro_over_report,
        q_edge_metro_report_frame, q_edge_national_report, q_edge_strip_text, q_paired_sums_fractional,
        q_single_sums_fractional, q_salted_enrichment, q_feed_load_report, q_published_under,
        q_monthly_date_ref, q_states_only_tables)},
    "national_report": q_national_report,
    "state_report": q_state_report,
    "metro_report": q_metro_report,
    "metro_over_report": q_metro_over_report,
    "metro_under_report": q_metro_under_report,
    "combined_report": q_combined_report,
    "combined_sections": q_combined_sections,
    "state_report_nation": q_state_report_nation,
    "paired_sums_left": q_paired_sums_left,
    "paired_sums_inner": q_paired_sums_inner,
    "lag_growth_12": q_lag_growth_12,
    "lag_growth_1": q_lag_growth_1,
    "rolling_mean_12": q_rolling_mean_12,
    "rolling_mean_ytd": q_rolling_mean_ytd,
    "growth_ann": q_growth_ann,
    "growth_ytd": q_growth_ytd,
    "rank_first": q_rank_first,
    "rank_average": q_rank_average,
    "cohort_over_semi": q_cohort_over_semi,
    "cohort_under_rows": q_cohort_under_rows,
    "strip_text": q_strip_text,
    "zero_pad": q_zero_pad,
    "remove_substrings": q_remove_substrings,
    "month_from_period": q_month_from_period,
    "lenient_numeric": q_lenient_numeric,
    "round_half_even": q_round_half_even,
    "area_exclusion": q_area_exclusion,
    "panel_split_u": q_panel_split_u,
    "panel_split_s": q_panel_split_s,
    "national_split": q_national_split,
    "statewide_only": q_statewide_only,
    "not_statewide": q_not_statewide,
    "enrich_state_metro": q_enrich_state_metro,
    "enrich_national": q_enrich_national,
    "run_date_row": q_run_date_row,
    "read_tsv_round_trip": q_read_tsv_round_trip,
    "append_files": q_append_files,
    "sink_round_trip": q_sink_round_trip,
    "frame_index": q_frame_index,
    "frame_lag_growth_12": q_frame_lag_growth_12,
    "frame_lag_growth_1": q_frame_lag_growth_1,
    "frame_rolling_mean": q_frame_rolling_mean,
    "metro_report_frame": q_metro_report_frame,
    "state_report_frame": q_state_report_frame,
    "metro_over_report_frame": q_metro_over_report_frame,
    "metro_under_report_frame": q_metro_under_report_frame,
    "fused_sections": q_fused_sections,
    "feed_panel": q_feed_panel,
    "feed_state_report": q_feed_state_report,
    "feed_metro_report": q_feed_metro_report,
    "feed_metro_under_report": q_feed_metro_under_report,
    "feed_metro_over_report": q_feed_metro_over_report,
    "feed_national_report": q_feed_national_report,
    "rank_first_sorted": q_rank_first_sorted,
    "rank_average_sorted": q_rank_average_sorted,
    "national_report_frame": q_national_report_frame,
    "national_index": q_national_index,
    "monthly_msa": _monthly_table("msa_rankings"),
    "monthly_under": _monthly_table("msa_rankings_under"),
    "monthly_over": _monthly_table("msa_rankings_over"),
}


def _over_where(size: str = "size", threshold: float = OVER_THRESHOLD) -> str:
    return (f"area_name IN (SELECT area_name FROM panel WHERE seasonal = 'S' "
            f"AND {NOT_STATEWIDE_SQL} AND industry_name = 'Total Nonfarm' "
            f"AND {size} > {threshold}{O.D})")


def _under_where() -> str:
    return (f"{NOT_STATEWIDE_SQL} AND industry_name = 'Total Nonfarm' "
            f"AND value < {UNDER_THRESHOLD}{O.D}")


def _block(entity: str, where: str, select: str) -> str:
    keys = [entity, "supersector_name", "industry_name"]
    return (f"{O.BASE},\n{O.pair_ctes('panel', where, entity, 'left')},\n"
            f"{O.metric_ctes(keys, K)}\nSELECT {select} FROM m2")


def _frame_block(select: str) -> str:
    keys = ["area_name", "supersector_name", "industry_name"]
    order = ", ".join(keys + ["year", "Month"])
    return (f"{O.BASE},\n{O.pair_ctes('panel', NOT_STATEWIDE_SQL, 'area_name', 'left')},\n"
            f"{O.metric_ctes(keys, K, order, frame_order=True)}\nSELECT {select} FROM m2")


WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"
PANEL_SQL = ", ".join(PANEL_COLS)
FEED_SQL = f"""SELECT
  'L' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS series_id,
  CAST(year(l_shipdate) AS VARCHAR) AS year,
  CASE WHEN l_linenumber = 7 THEN 'M13'
       ELSE 'M' || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') END AS period,
  CAST(l_quantity AS DOUBLE) AS value,
  CASE WHEN l_linestatus = 'O' THEN 'P' END AS footnote_codes
FROM lineitem"""


def _pad_sql(x: str, n: int) -> str:
    return f"CASE WHEN length({x}) < {n} THEN lpad({x}, {n}, '0') ELSE {x} END"


def _lenient_sql(x: str) -> str:
    num = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
    return f"CASE WHEN regexp_matches({x}, '{num}') THEN TRY_CAST({x} AS DOUBLE) END"


def _tail_sql(entity: str) -> str:
    return ", ".join([entity] + TAIL)


def _oracles() -> dict[str, str]:
    fin = O.finish_cols()
    ms, ss = _tail_sql("area_name"), _tail_sql("state_name")
    combined = (
        f"SELECT * FROM ({O.report_sql('state_name', STATEWIDE_SQL, 'left', K, 'first')}) "
        f"UNION ALL SELECT * FROM ({O.report_sql('area_name', NOT_STATEWIDE_SQL, 'left', K, 'first')})")
    edge = {"base": O.BASE_EDGE}
    edge_under = f"{NOT_STATEWIDE_SQL} AND industry_name = 'Total Nonfarm' AND value < {EDGE_UNDER}{O.D}"
    cents = "sum(CAST(value AS DECIMAL(18, 2)))::DOUBLE"
    priced = O.BASE.replace("CAST(l.l_quantity AS DOUBLE) AS value", "CAST(l.l_extendedprice AS DOUBLE) AS value")
    summed = f"{priced},\n" + O.pair_ctes("panel", STATEWIDE_SQL, "state_name", "left", total=cents)
    return {
        "edge_panel": f"{O.BASE_EDGE}\nSELECT l_orderkey, l_linenumber, {PANEL_SQL} FROM panel",
        "edge_state_report": O.report_sql("state_name", STATEWIDE_SQL, "left", K, "first", **edge),
        "edge_state_report_january": O.report_sql("state_name", STATEWIDE_SQL, "left", 0, "first", **edge),
        "edge_state_report_march": O.report_sql("state_name", STATEWIDE_SQL, "left", 2, "first", **edge),
        "edge_metro_report": O.report_sql("area_name", NOT_STATEWIDE_SQL, "left", K, "first", **edge),
        "edge_metro_report_sorted": O.report_sql("area_name", NOT_STATEWIDE_SQL, "left", K, "first", **edge),
        "edge_metro_under_report": O.report_sql("area_name", edge_under, "left", K, "average", **edge),
        "edge_metro_over_report": O.report_sql("area_name", _over_where(), "left", K, "average", value_from="S", **edge),
        "edge_metro_report_frame": O.report_sql("area_name", NOT_STATEWIDE_SQL, "left", K, "first", frame=True, **edge),
        "edge_national_report": O.national_sql(K, **edge),
        "edge_strip_text": """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS VARCHAR) AS value,
  concat_ws(chr(9), l_returnflag, l_linestatus) AS flags, '' AS blank FROM lineitem""",
        "paired_sums_fractional": f"{summed}\nSELECT * FROM cells",
        "single_sums_fractional": f"""{priced}
SELECT {ms}, {cents} AS value, {cents} AS value_mom FROM panel
WHERE {NOT_STATEWIDE_SQL} AND area_name IS NOT NULL GROUP BY {ms}""",
        "salted_enrichment": """SELECT l_orderkey, l_linenumber, l_quantity,
  CASE WHEN l_orderkey % 3 = 0 THEN -1 ELSE l_suppkey END AS code,
  CASE WHEN l_orderkey % 3 = 0 THEN 'hot' ELSE s_name END AS s_name
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey
WHERE l_orderkey % 3 = 0 OR s_suppkey IS NOT NULL""",
        "feed_load_report": """SELECT 'open' AS feed, CAST(2 AS INTEGER) AS listed, 2 * count(*) AS rows, 'listed twice' AS status
FROM lineitem WHERE l_linestatus = 'O'
UNION ALL SELECT 'shipped', 1, count(*), 'ok' FROM lineitem WHERE l_linestatus IS DISTINCT FROM 'O'
UNION ALL SELECT 'none', 1, 0, 'empty'""",
        "published_under": O.report_sql("area_name", _under_where(), "left", K, "average"),
        "monthly_date_ref": ("SELECT CAST(month(max(l_shipdate)) - 1 AS VARCHAR) AS month, "
                             "CAST(year(max(l_shipdate)) AS VARCHAR) AS year FROM lineitem"),
        "states_only_tables": O.report_sql("state_name", STATEWIDE_SQL, "left", K, "first"),
        "national_report": O.national_sql(K),
        "state_report": O.report_sql("state_name", STATEWIDE_SQL, "left", K, "first"),
        "metro_report": O.report_sql("area_name", NOT_STATEWIDE_SQL, "left", K, "first"),
        "metro_over_report": O.report_sql("area_name", _over_where(), "left", K, "average",
                                          value_from="S"),
        "metro_under_report": O.report_sql("area_name", _under_where(), "left", K, "average"),
        "combined_report": combined,
        "combined_sections": combined,
        "state_report_nation": O.report_sql("state_name", STATEWIDE_SQL, "left", K, "first",
                                            base=O.BASE_NATION),
        "paired_sums_left": (f"{O.BASE},\n{O.pair_ctes('panel', NOT_STATEWIDE_SQL, 'area_name', 'left')}\n"
                             "SELECT * FROM cells"),
        "paired_sums_inner": f"{O.BASE},\n{O.pair_ctes('npanel', 'TRUE', None, 'inner')}\nSELECT * FROM cells",
        "lag_growth_12": _block("area_name", NOT_STATEWIDE_SQL,
                                f"{ms}, value, {fin['pct_change']} AS pct_change, "
                                f"{fin['abs_change']} AS abs_change"),
        "lag_growth_1": _block("area_name", NOT_STATEWIDE_SQL,
                               f"{ms}, value_mom, {fin['pct_change_mom']} AS pct_change_mom, "
                               f"{fin['abs_change_mom']} AS abs_change_mom"),
        "rolling_mean_12": _block("state_name", STATEWIDE_SQL, f"{ss}, value, value_ann_avg"),
        "rolling_mean_ytd": _block("state_name", STATEWIDE_SQL, f"{ss}, value, value_ytd_avg"),
        "growth_ann": _block("state_name", STATEWIDE_SQL,
                             f"{ss}, value_ann_avg, {fin['pct_change_ann']} AS pct_change_ann, "
                             f"{fin['abs_change_ann']} AS abs_change_ann"),
        "growth_ytd": _block("state_name", STATEWIDE_SQL,
                             f"{ss}, value_ytd_avg, {fin['pct_change_ytd']} AS pct_change_ytd, "
                             f"{fin['abs_change_ytd']} AS abs_change_ytd"),
        "rank_first": _block("state_name", STATEWIDE_SQL,
                             f"{ss}, {O.rank_first_sql('f_yoy', 'state_name')} AS rank"),
        "rank_average": _block("area_name", NOT_STATEWIDE_SQL,
                               f"{ms}, {O.rank_average_sql('f_mom')} AS rank_mom"),
        "cohort_over_semi": (f"{O.BASE}\nSELECT area_name, state_name, {', '.join(TAIL)}, value "
                             f"FROM panel WHERE seasonal = 'S' AND {_over_where()}"),
        "cohort_under_rows": (f"{O.BASE}\nSELECT area_name, state_name, {', '.join(TAIL)}, value, "
                              f"seasonal FROM panel WHERE {_under_where()}"),
        "strip_text": f"""SELECT
  trim(rpad('L' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR), 30, ' '), {WS}) AS series_id,
  trim(CAST(year(l_shipdate) AS VARCHAR), {WS}) AS year,
  trim(lpad(CAST(l_quantity AS VARCHAR), 12, ' '), {WS}) AS value
FROM lineitem""",
        "zero_pad": f"""SELECT l_orderkey, l_linenumber,
  {_pad_sql('CAST(l_suppkey AS VARCHAR)', 5)} AS area_code,
  {_pad_sql('CAST(l_partkey AS VARCHAR)', 8)} AS industry_code,
  {_pad_sql('CAST(l_linenumber AS VARCHAR)', 2)} AS data_type_code,
  {_pad_sql('CAST(l_orderkey AS VARCHAR)', 4)} AS order_code
FROM lineitem""",
        "remove_substrings": f"""{O.BASE}
SELECT l_orderkey, l_linenumber,
  replace(replace(area_name, ' NECTA', ''), 'Metropolitan Statistical Area', '') AS area_name,
  replace(state_name, chr(13), '') AS state_name,
  replace(supersector_name, chr(13), '') AS supersector_name
FROM raw""",
        "month_from_period": f"{O.BASE}\nSELECT l_orderkey, l_linenumber, period, replace(period, 'M', '') AS Month FROM raw",
        "lenient_numeric": f"""SELECT l_orderkey, l_linenumber,
  {_lenient_sql("trim(lpad(CAST(l_quantity AS VARCHAR), 12, ' '), " + WS + ")")} AS value,
  {_lenient_sql('CAST(l_extendedprice AS VARCHAR)')} AS price,
  {_lenient_sql('l_returnflag')} AS flag_value
FROM lineitem""",
        "round_half_even": f"""SELECT l_orderkey, l_linenumber,
  {O.round2('l_extendedprice::DOUBLE * l_discount::DOUBLE')} AS discount_amount,
  {O.pct('l_discount::DOUBLE')} AS discount_pct,
  {O.round2('l_quantity::DOUBLE / 8.0::DOUBLE')} AS eighths
FROM lineitem""",
        "area_exclusion": f"""{O.BASE}
SELECT l_orderkey, l_linenumber, area_name FROM raw
WHERE NOT coalesce(contains(area_name, 'Metropolitan Division'), false)
  AND NOT coalesce(contains(area_name, 'NECTA Division'), false)""",
        "panel_split_u": f"{O.BASE}\nSELECT l_orderkey, l_linenumber, {PANEL_SQL} FROM panel WHERE seasonal = 'U'",
        "panel_split_s": f"{O.BASE}\nSELECT l_orderkey, l_linenumber, {PANEL_SQL} FROM panel WHERE seasonal = 'S'",
        "national_split": (f"{O.BASE}\nSELECT l_orderkey, l_linenumber, supersector_name, industry_name, "
                           "Month, year, value, seasonal FROM npanel"),
        "statewide_only": f"{O.BASE}\nSELECT l_orderkey, l_linenumber, {PANEL_SQL} FROM panel WHERE {STATEWIDE_SQL}",
        "not_statewide": f"{O.BASE}\nSELECT l_orderkey, l_linenumber, {PANEL_SQL} FROM panel WHERE {NOT_STATEWIDE_SQL}",
        "enrich_state_metro": (f"{O.BASE}\nSELECT l_orderkey, l_linenumber, area_name, state_name, "
                               "supersector_name, industry_name, period, year, value, data_type_code, "
                               "seasonal FROM cleaned"),
        "enrich_national": (f"{O.BASE}\nSELECT l_orderkey, l_linenumber, supersector_name, industry_name, "
                            "period, year, value, data_type_code, seasonal FROM raw"),
        "run_date_row": ("SELECT CAST(month(max(l_shipdate)) - 1 AS VARCHAR) AS month, "
                         "CAST(year(max(l_shipdate)) AS VARCHAR) AS year FROM lineitem"),
        "read_tsv_round_trip": FEED_SQL,
        "append_files": FEED_SQL,
        "sink_round_trip": f"""SELECT row_number() OVER (ORDER BY state_name, supersector_name, industry_name, year, Month) - 1 AS "index", *
FROM ({O.report_sql('state_name', STATEWIDE_SQL, 'left', K, 'first')})
UNION ALL
SELECT row_number() OVER (ORDER BY state_name, supersector_name, industry_name, year, Month) - 1 AS "index", *
FROM (SELECT * RENAME (area_name AS state_name) FROM ({O.report_sql('area_name', NOT_STATEWIDE_SQL, 'left', K, 'first')}))""",
        "frame_index": (f"{O.BASE},\n{O.pair_ctes('panel', NOT_STATEWIDE_SQL, 'area_name', 'left')}\n"
                        f"SELECT {ms}, value, row_number() OVER (ORDER BY {ms}) - 1 AS frame_index "
                        "FROM cells"),
        "frame_lag_growth_12": _frame_block(f"{ms}, value, {fin['pct_change']} AS pct_change, "
                                            f"{fin['abs_change']} AS abs_change"),
        "frame_lag_growth_1": _frame_block(f"{ms}, value_mom, {fin['pct_change_mom']} AS pct_change_mom, "
                                           f"{fin['abs_change_mom']} AS abs_change_mom"),
        "frame_rolling_mean": _frame_block(
            f"{ms}, value_ytd_avg, value_ann_avg, {fin['pct_change_ytd']} AS pct_change_ytd, "
            f"{fin['abs_change_ytd']} AS abs_change_ytd, {fin['pct_change_ann']} AS pct_change_ann, "
            f"{fin['abs_change_ann']} AS abs_change_ann"),
        "metro_report_frame": O.report_sql("area_name", NOT_STATEWIDE_SQL, "left", K, "first",
                                           frame=True),
        "national_report_frame": O.national_sql(K, frame=True),
        "state_report_frame": O.report_sql("state_name", STATEWIDE_SQL, "left", K, "first", frame=True),
        "metro_over_report_frame": O.report_sql("area_name", _over_where(), "left", K, "average",
                                                value_from="S", frame=True),
        "metro_under_report_frame": O.report_sql("area_name", _under_where(), "left", K, "average",
                                                 frame=True),
        "fused_sections": "\nUNION ALL\n".join(
            f"SELECT '{lvl}' AS level, * RENAME ({ent} AS entity) FROM ({sql})" for lvl, ent, sql in (
                ("state", "state_name", O.report_sql("state_name", STATEWIDE_SQL, "left", K, "first")),
                ("msa", "area_name", O.report_sql("area_name", NOT_STATEWIDE_SQL, "left", K, "first")),
                ("under", "area_name", O.report_sql("area_name", _under_where(), "left", K, "average")),
                ("over", "area_name", O.report_sql("area_name", _over_where(), "left", K, "average",
                                                   value_from="S")))),
        "feed_panel": (f"{O.BASE}\nSELECT area_name, state_name, supersector_name, industry_name, Month, "
                       "year, value, data_type_code, seasonal FROM panel"),
        "feed_state_report": O.report_sql("state_name", STATEWIDE_SQL, "left", K, "first"),
        "feed_metro_report": O.report_sql("area_name", NOT_STATEWIDE_SQL, "left", K, "first"),
        "feed_metro_under_report": O.report_sql("area_name", _under_where(), "left", K, "average"),
        "feed_metro_over_report": O.report_sql(
            "area_name", _over_where("value", FEED_OVER_THRESHOLD), "left", K, "average", value_from="S"),
        "feed_national_report": O.national_sql(K),
        "national_index": O.national_index_sql(K),
        "monthly_msa": "SELECT * RENAME (area_name AS state_name) FROM ("
                       + O.report_sql("area_name", NOT_STATEWIDE_SQL, "left", K, "first") + ")",
        "monthly_under": O.report_sql("area_name", _under_where(), "left", K, "average"),
        "monthly_over": O.report_sql("area_name", _over_where(), "left", K, "average", value_from="S"),
        "rank_first_sorted": _block("state_name", STATEWIDE_SQL,
                                    f"{ss}, {O.rank_first_sql('f_yoy', 'state_name')} AS rank"),
        "rank_average_sorted": _block("area_name", NOT_STATEWIDE_SQL,
                                      f"{ms}, {O.rank_average_sql('f_mom')} AS rank_mom"),
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the state report (year-over-year, ytd, annual and monthly
    growth with peer ranks) on the smoke tables."""
    return q_state_report(spark, SMOKE_DIR)


# The training-data operators live in one subpackage and the pipeline at the
# top of the repository; without them the other queries work as they are.
try:
    import corpus_pipeline as _pipeline
    from panelgrowth.llm import queries as _llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "panelgrowth.llm"):
        raise
    _pipeline = _llm = None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = dict(QUERIES)
    if _llm:
        found |= _llm.QUERIES
        found["pipeline"] = _pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = _oracles()
    if _llm:
        found |= _llm.ORACLES
        if _pipeline.ORACLE_SQL:
            found["pipeline"] = _pipeline.ORACLE_SQL
    return found
