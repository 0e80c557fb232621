"""Hot keys of the series join are measured and salted."""

import pytest
from pyspark.sql import functions as F

from panelgrowth.operators import enrich
from panelgrowth.operators.enrich import hot_keys, join_lookup, salted_join


def _facts(spark, n=20_000):
    """Half of the rows carry one id."""
    return spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "HOT").when(F.col("id") % 1001 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("S"), (F.col("id") % 997).cast("string"))).alias("series_id"), F.col("id").alias("row"))


def _lookup(spark):
    return (spark.range(900).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("series_id"), F.col("id").alias("code"))
            .unionByName(spark.createDataFrame([("HOT", -1), ("HOT", -2), (None, -3)], "series_id string, code long")))


def rows(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


def test_hot_keys(spark):
    assert [r[0] for r in hot_keys(_facts(spark), ["series_id"]).collect()] == ["HOT"]
    assert hot_keys(_facts(spark).where("false"), ["series_id"]).count() == 0
    assert 900 < hot_keys(_facts(spark), ["series_id"], share=0.0004).count() < 1 / 0.0004


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_the_plain_join(spark, how):
    facts, lookup = _facts(spark), _lookup(spark)
    got = salted_join(facts, lookup, ["series_id"], hot_keys(facts, ["series_id"]), salts=7, how=how)
    want = facts.join(lookup, "series_id", how)
    assert got.columns == want.columns and rows(got) == rows(want)


def test_full_joins_are_refused(spark):
    facts = _facts(spark, 10)
    with pytest.raises(ValueError):
        salted_join(facts, _lookup(spark), ["series_id"], hot_keys(facts, ["series_id"]), how="full")


def test_the_hot_id_spreads_over_the_tasks(spark):
    """An id with half of the facts: the exchange is by (id, salt), and no task gets half."""
    was = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # the salt alone, without AQE's split
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        facts = _facts(spark)
        for salted in (False, True):
            out = join_lookup(facts, _lookup(spark), "series_id", broadcast_max_rows=0, salt=salted)
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert ("hashpartitioning(series_id" in plan and ", _salt" in plan) == salted
            most = out.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
            total = out.count()
            assert most > 0.45 * total if not salted else most < 0.3 * total, (salted, most, total)
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_small_lookups_are_not_measured(spark, monkeypatch):
    monkeypatch.setattr(enrich, "hot_keys", lambda *a, **k: pytest.fail("measured"))
    assert join_lookup(_facts(spark), _lookup(spark), "series_id", salt=True).count() > 0


def test_no_hot_key_is_the_plain_join(spark):
    facts = _facts(spark).where("series_id <> 'HOT'")
    out = join_lookup(facts, _lookup(spark), "series_id", broadcast_max_rows=0, salt=True)
    assert "_salt" not in out._jdf.queryExecution().executedPlan().toString()
    assert rows(out) == rows(facts.join(_lookup(spark), "series_id"))
