"""A1-A5: sums do not depend on the order of the rows."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from panelgrowth.operators.exact import exact_sums
from panelgrowth.operators.pairing import over_cells, paired_sums, single_sums
from panelgrowth.plans.fused import entity_cells

KEYS = ["area_name", "supersector_name", "industry_name", "year", "Month"]


def _panel(spark):
    """Cells of many values of one to three decimals, as the feeds hold them."""
    d = spark.range(40_000).select(
        F.concat(F.lit("A"), (F.col("id") % 5).cast("string")).alias("area_name"), F.lit("X").alias("state_name"),
        F.lit("ss").alias("supersector_name"), F.lit("Total Nonfarm").alias("industry_name"), F.lit("2001").alias("year"),
        F.lpad((F.col("id") % 3 + 1).cast("string"), 2, "0").alias("Month"),
        ((F.pmod(F.xxhash64("id"), F.lit(1_000_000)) - 300_000) / 1000.0).alias("value"),
        F.when(F.col("id") % 2 == 0, "U").otherwise("S").alias("seasonal"))
    return d


def _hash(df):
    return df.agg(F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()[0]


@pytest.mark.parametrize("sums", [
    lambda p: paired_sums(p, KEYS), lambda p: single_sums(p, KEYS), lambda p: over_cells(p, KEYS, threshold=0.0),
    lambda p: entity_cells(p)], ids=["paired", "single", "over", "entity"])
def test_equal_at_any_number_of_partitions(spark, sums):
    panel, found = _panel(spark), set()
    was = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 7, 64):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            # other tasks, another order in each
            found.add(_hash(sums(panel.repartition(n, F.xxhash64("value", F.lit(n))).sortWithinPartitions(F.rand(n)))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert len(found) == 1


def test_plain_sums_do_depend_on_it(spark):
    panel = _panel(spark).select("area_name", "value")
    found = {_hash(panel.coalesce(1).sortWithinPartitions(F.rand(n)).groupBy("area_name").agg(F.sum("value").alias("v")))
             for n in range(6)}
    assert len(found) > 1


def _sum_of(spark, values):
    df = spark.createDataFrame([(1, v) for v in values], "k int, v double").repartition(3)
    return exact_sums(df, ["k"], {"s": F.col("v")}, F.count(F.lit(1)).alias("n")).first()


@pytest.mark.parametrize("values", [
    [0.1] * 10, [0.1, 0.2, -0.3], [1.5, None, 2.25], [None, None], [-0.5, -0.25], [1e9 + 0.1, -1e9], [0.0, -0.0],
    [123456.789, 987654.321, 0.001], [4e9 + 0.123456] * 3, [float(2 ** 39), 0.5], [-7.999999, 8.0], [-0.1, 2.0 ** 40 + 0.5, -(2.0 ** 41) - 0.25],
    [-1e-6, 1e-6, 3e-6], [2.0 ** 52, 1.0, -0.5]])
def test_nearest_double_of_the_decimal_sum(spark, values):
    got = _sum_of(spark, values)
    some = [Fraction(repr(v)) for v in values if v is not None]
    assert got["n"] == len(values)
    assert got["s"] == (float(sum(some)) if some else None)


def test_large_values(spark):
    assert _sum_of(spark, [3e12, 0.1, -3e12])["s"] == 0.1
    assert _sum_of(spark, [1e20, 1.0, -1e20])["s"] == 1.0
    assert _sum_of(spark, [1e12])["s"] == 1e12
    assert math.isclose(_sum_of(spark, [2e30] * 4)["s"], 8e30)
    with pytest.raises(Exception, match="OVERFLOW|OUT_OF_RANGE|out of range"):
        _sum_of(spark, [1e300])


def test_no_row(spark):
    df = spark.createDataFrame([], "k int, v double")
    assert exact_sums(df, ["k"], {"s": F.col("v")}).count() == 0
