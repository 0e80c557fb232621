"""The edge analog holds rows that each rule acts on (a green row is not vacuous)."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from panelgrowth.operators.growth import growth_fractions
from panelgrowth.operators.pairing import paired_sums
from panelgrowth.plans.panels import state_metro_panel
from panelgrowth.sources.analog import edge_facts

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def facts(spark):
    return edge_facts(spark, SF).persist()


@pytest.fixture(scope="module")
def report(spark):
    return E.queries()["edge_metro_report"](spark, SF).persist()


@pytest.mark.parametrize("rule,where", [
    ("F2: an excluded state", "state_name = 'Puerto Rico' AND data_type_code = '1' AND period <> 'M13'"),
    ("F2: a missing state stays", "state_name IS NULL AND data_type_code = '1' AND period <> 'M13'"),
    ("F2: M13", "period = 'M13'"), ("F2: another data type", "data_type_code <> '1'"),
    ("X3a: a carriage return in a state", "contains(state_name, '\r')"),
    ("X3a: one in a supersector", "contains(supersector_name, '\r')"),
    ("X5: text that is no number", "value = '-'"), ("X5: zero", "value = '0'"),
    ("A1-A5: fractions", "try_cast(value AS DOUBLE) % 1 <> 0"),
    ("F1: divisions", "contains(area_name, 'Metropolitan Division') OR contains(area_name, 'NECTA Division')"),
    ("X3c: NECTA", "endswith(area_name, ' NECTA')")])
def test_facts_that_a_rule_acts_on(facts, rule, where):
    assert facts.where(where).count() > 0, rule


def test_excluded_and_merged_rows(spark, facts):
    panel = state_metro_panel(facts, extra=("size",))
    states = {r[0] for r in panel.select("state_name").distinct().collect()}
    assert "Puerto Rico" not in states and None in states and "ASIA" in states
    assert not any("\r" in s for s in states if s)
    # the two spellings meet in one cell
    asia = facts.where("replace(state_name, '\r', '') = 'ASIA'").select("state_name").distinct().count()
    assert asia == 2


def test_missing_values_are_filled_over(spark, facts):
    """A base that is not the value 12 rows back, as that one is missing."""
    panel = state_metro_panel(facts)
    cells = paired_sums(panel.where("area_name <> 'Statewide'"), ["area_name", *E.TAIL])
    fr = growth_fractions(cells, ["area_name", "supersector_name", "industry_name"], 2)
    assert cells.where("value IS NULL").count() > 0 and cells.where("value_mom IS NULL").count() > 0
    assert fr.where("_lag_yoy IS NULL AND _f_yoy IS NOT NULL").count() > 0
    # W6 with k = 2 is missing where a value of the frame is, and at the start
    w = Window.partitionBy("area_name", "supersector_name", "industry_name").orderBy("year", "Month")
    seen = fr.withColumn("was", F.lag("value").over(w))
    assert seen.where("value IS NOT NULL AND was IS NULL AND value_ytd_avg IS NOT NULL").count() == 0
    assert fr.where("value_ytd_avg IS NOT NULL").count() > 0


def test_ties(spark, report):
    """Equal fractions in a peer group, far apart in rank or averaged."""
    peers = ["supersector_name", "industry_name", "year", "Month"]
    ties = report.where("rank IS NOT NULL").groupBy(*peers, "pct_change").count().where("count > 1")
    assert ties.count() > 20
    under = E.queries()["edge_metro_under_report"](spark, SF)
    assert report.count() > 0 and under.columns == report.columns


def test_january_and_march(spark):
    zero = E.queries()["edge_state_report_january"](spark, SF)
    assert zero.where("value_ytd_avg IS NOT NULL OR rank_ytd IS NOT NULL").count() == 0 and zero.count() > 0
    assert E.queries()["edge_state_report_march"](spark, SF).where("rank_ytd IS NOT NULL").count() > 0
