"""Reference-shaped panel built from the TPC-H-style test tables.

The test tables carry no employment data, so a panel with the same columns
and the same edge cases is derived from them (FIXTURES.md section 3):

=================  ==========================================================
value              l_quantity (whole numbers, so sums are exact)
size               l_extendedprice (the column the over-cohort test reads)
year, period       ship date year; 'M13' for line 7, else 'M' + month
seasonal           line status F -> 'U', O -> 'S'
data_type_code     '1' for lines 1-5, else '2' (padded to '01'/'02' later)
supersector_name   customer market segment
industry_name      return flag, 'N' -> 'Total Nonfarm'
state_name         region name (or nation name)
area_name          'Statewide' for even supplier keys, else nation name plus
                   one of four metro suffixes chosen by nation key mod 4
=================  ==========================================================

The per-order attributes (customer, nation, region) are joined to orders
first, so lineitem is joined once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelgrowth.operators.enrich import enrich, join_lookup
from panelgrowth.operators.filters import STATEWIDE, TOTAL_NONFARM

# Metro-area suffixes by nation key mod 4.
AREA_SUFFIXES = (
    " Metropolitan Statistical Area",
    " NECTA",
    " Metropolitan Division",
    " NECTA Division",
)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


_TABLES: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table; the DataFrame (a plan, no data) is reused within a
    session so its schema and file listing are resolved once."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (spark.sparkContext.applicationId, path)
    df = _TABLES.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _TABLES[key] = df
    return df


def order_attributes(spark: SparkSession, sf_dir: str, state_level: str = "region") -> DataFrame:
    """One row per order: segment, nation, region."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("n_regionkey"), "r_name")
    attrs = enrich(orders, [(customer, "c_custkey"), (nation, "c_nationkey"), (region, "n_regionkey")])
    state = F.col("r_name") if state_level == "region" else F.col("n_name")
    suffix = F.element_at(F.array(*[F.lit(s) for s in AREA_SUFFIXES]),
                          (F.col("c_nationkey") % 4 + 1).cast("int"))
    return attrs.select("l_orderkey",
                        F.col("c_mktsegment").alias("supersector_name"),
                        state.alias("state_name"),
                        F.concat(F.col("n_name"), suffix).alias("_metro_name"))


def analog_facts(spark: SparkSession, sf_dir: str, state_level: str = "region",
                 with_ids: bool = False) -> DataFrame:
    """The enriched state/metro panel before cleaning."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    # orders is as large as a fact table: no broadcast hint, the planner and
    # AQE decide from measured sizes
    joined = join_lookup(li, order_attributes(spark, sf_dir, state_level), "l_orderkey",
                         broadcast_max_rows=None)
    month = F.lpad(F.month("l_shipdate").cast("string"), 2, "0")
    cols = [
        F.when(F.col("l_suppkey") % 2 == 0, F.lit(STATEWIDE))
         .otherwise(F.col("_metro_name")).alias("area_name"),
        "state_name",
        "supersector_name",
        F.when(F.col("l_returnflag") == "N", F.lit(TOTAL_NONFARM))
         .otherwise(F.col("l_returnflag")).alias("industry_name"),
        F.when(F.col("l_linenumber") == 7, F.lit("M13"))
         .otherwise(F.concat(F.lit("M"), month)).alias("period"),
        F.year("l_shipdate").cast("string").alias("year"),
        F.col("l_quantity").alias("value"),
        F.when(F.col("l_linenumber") <= 5, F.lit("1")).otherwise(F.lit("2")).alias("data_type_code"),
        F.when(F.col("l_linestatus") == "F", F.lit("U"))
         .when(F.col("l_linestatus") == "O", F.lit("S")).alias("seasonal"),
        F.col("l_extendedprice").alias("size"),
    ]
    if with_ids:
        cols = ["l_orderkey", "l_linenumber"] + cols
    return joined.select(*cols)


def analog_national_facts(spark: SparkSession, sf_dir: str, with_ids: bool = False) -> DataFrame:
    """The enriched national panel before the split."""
    facts = analog_facts(spark, sf_dir, with_ids=with_ids)
    keep = ["supersector_name", "industry_name", "period", "year", "value",
            "data_type_code", "seasonal"]
    return facts.select(*((["l_orderkey", "l_linenumber"] if with_ids else []) + keep))


def edge_facts(spark: SparkSession, sf_dir: str, with_ids: bool = False) -> DataFrame:
    """The analog facts with the values that the rules act on: an excluded state, a
    state that is missing, carriage returns in names (which merge two of them), values
    that are no number, zeros, fractions (eighths, so that sums are exact in any engine),
    and one supersector whose small equal values make many ties."""
    facts = analog_facts(spark, sf_dir, with_ids=True)
    state, sector, order = F.col("state_name"), F.col("supersector_name"), F.col("l_orderkey")
    eighths = (F.floor("size") / F.lit(8.0)).cast("string")
    edge = facts.withColumns({
        "state_name": F.when(state == "AFRICA", "Puerto Rico")
        .when((state == "ASIA") & (order % 2 == 1), F.lit("AS\rIA\r"))
        .when((state == "EUROPE") & (order % 11 == 0), F.lit(None)).otherwise(state),
        "supersector_name": F.when((sector == "HOUSEHOLD") & (order % 3 == 0), F.lit("\rHOUSEHOLD\r")).otherwise(sector),
        "value": F.when(order % 4 == 0, "-").when(order % 13 == 0, "0")
        .when(sector == "MACHINERY", "0.125").otherwise(eighths),
    })
    return edge if with_ids else edge.drop("l_orderkey", "l_linenumber")


def edge_national_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edge_facts(spark, sf_dir).select(
        "supersector_name", "industry_name", "period", "year", "value", "data_type_code", "seasonal")


def analog_feed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineitem facts rendered as a text feed laid out like the public
    time-series files: series id padded on the right, value right-aligned,
    footnote 'P' on open lines."""
    li = table(spark, sf_dir, "lineitem")
    month = F.lpad(F.month("l_shipdate").cast("string"), 2, "0")
    return li.select(
        F.rpad(F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("-"),
                        F.col("l_linenumber").cast("string")), 30, " ").alias("series_id"),
        F.year("l_shipdate").cast("string").alias("year"),
        F.when(F.col("l_linenumber") == 7, F.lit("M13"))
         .otherwise(F.concat(F.lit("M"), month)).alias("period"),
        F.lpad(F.col("l_quantity").cast("string"), 12, " ").alias("value"),
        F.when(F.col("l_linestatus") == "O", F.lit("P")).alias("footnote_codes"),
    )


# --- the analog panel as real feeds (text facts + coded lookups) -------------

def _order_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", _segment_code(F.col("c_mktsegment")).alias("supersector_code"))
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    attrs = enrich(orders, [(customer, "c_custkey"), (nation, "c_nationkey")])
    return attrs.select("l_orderkey", "supersector_code", "c_nationkey", "n_regionkey")


def _segment_code(c) -> F.Column:
    # a short numeric code derived from the segment name
    return F.pmod(F.xxhash64(c), F.lit(99991))


def _suffix(nationkey) -> F.Column:
    return F.element_at(F.array(*[F.lit(s) for s in AREA_SUFFIXES]), (nationkey % 4 + 1).cast("int"))


def _coded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line of an order: codes, series ids, text fields, and the national
    feed's file."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus",
        "l_shipdate")
    # orders, of which there are fewer, are hashed: the lines need no sort
    rows = join_lookup(li, _order_codes(spark, sf_dir).hint("shuffle_hash"), "l_orderkey",
                       broadcast_max_rows=None)
    month = F.lpad(F.month("l_shipdate").cast("string"), 2, "0")
    coded = rows.select(
        F.when(F.col("l_linestatus") == "F", F.lit("U"))
         .when(F.col("l_linestatus") == "O", F.lit("S")).alias("seasonal"),
        F.col("n_regionkey").alias("state_code"),
        F.when(F.col("l_suppkey") % 2 == 0, F.lit(0))
         .otherwise(F.col("c_nationkey") + 1).alias("area_code"),
        "supersector_code",
        F.ascii("l_returnflag").alias("industry_code"),
        F.when(F.col("l_linenumber") <= 5, F.lit(1)).otherwise(F.lit(2)).alias("data_type_code"),
        F.year("l_shipdate").cast("string").alias("year"),
        F.when(F.col("l_linenumber") == 7, F.lit("M13"))
         .otherwise(F.concat(F.lit("M"), month)).alias("period"),
        F.lpad(F.col("l_quantity").cast("string"), 12, " ").alias("value"),
    )

    def code(c, n):
        return F.lpad(F.col(c).cast("string"), n, "0")

    sm_id = F.concat(F.lit("SM"), F.coalesce(F.col("seasonal"), F.lit("X")), code("state_code", 2),
                     code("area_code", 5), code("supersector_code", 8), code("industry_code", 8),
                     F.col("data_type_code").cast("string"))
    ce_id = F.concat(F.lit("CE"), F.coalesce(F.col("seasonal"), F.lit("X")),
                     code("supersector_code", 8), code("industry_code", 8),
                     F.col("data_type_code").cast("string"))
    coded = coded.withColumns({"sm_id": sm_id, "ce_id": ce_id})
    return coded.withColumn("_file", F.pmod(F.xxhash64(F.rpad("ce_id", 30, " ")), F.lit(11)))


def analog_feeds(spark: SparkSession, sf_dir: str, coded: DataFrame | None = None) -> dict[str, DataFrame]:
    """The analog panel encoded the way the public feeds are: text facts keyed
    by a series id, and lookups from codes to names.  Codes are numbers
    (padded by the readers), area codes in the area lookup end in a line
    feed, the area lookup carries a clashing ``state_name``, national series
    ids in their lookup carry blanks.  Decoding these through the engine's
    readers and joins gives back the analog panel.  ``coded``: the coded lines,
    where they were written before."""
    coded = _coded_lines(spark, sf_dir) if coded is None else coded

    def facts(id_col, *more):
        return coded.select(F.rpad(F.col(id_col), 30, " ").alias("series_id"), "year", "period",
                            "value", F.lit(None).cast("string").alias("footnote_codes"), *more)

    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer")
    segments = customer.select("c_mktsegment").distinct().select(
        _segment_code(F.col("c_mktsegment")).alias("supersector_code"),
        F.col("c_mktsegment").alias("supersector_name"))
    flags = table(spark, sf_dir, "lineitem").select("l_returnflag").distinct().select(
        F.ascii("l_returnflag").alias("industry_code"),
        F.when(F.col("l_returnflag") == "N", F.lit(TOTAL_NONFARM))
         .otherwise(F.col("l_returnflag")).alias("industry_name"))
    statewide = region.agg(F.lit("00000").alias("area_code")).select(
        "area_code", F.lit(STATEWIDE).alias("area_name"), F.lit("WRONG").alias("state_name"))
    areas = nation.select(
        F.concat(F.lpad((F.col("n_nationkey") + 1).cast("string"), 5, "0"), F.lit("\n")).alias("area_code"),
        F.concat(F.col("n_name"), _suffix(F.col("n_nationkey"))).alias("area_name"),
        F.lit("WRONG").alias("state_name"))
    return {
        "sm_facts": facts("sm_id"),
        "ce_facts": facts("ce_id", "_file"),
        "sm_state": region.select(F.col("r_regionkey").alias("state_code"),
                                  F.col("r_name").alias("state_name")),
        "sm_supersector": segments,
        "sm_series": coded.select(F.col("sm_id").alias("series_id"), "state_code", "area_code",
                                  "supersector_code", "industry_code", "data_type_code",
                                  "seasonal").distinct(),
        "sm_industry": flags,
        "sm_area": statewide.unionByName(areas),
        "ce_series": coded.select(F.concat(F.lit(" "), F.col("ce_id"), F.lit(" ")).alias("series_id"),
                                  "supersector_code", "industry_code", "data_type_code",
                                  "seasonal").distinct(),
        "ce_industry": flags,
        "ce_supersector": segments,
    }


def write_analog_landing(spark: SparkSession, sf_dir: str) -> tuple[str, "LookupSource"]:
    """Write ``analog_feeds`` as a landing folder (text feeds under the
    manifest's file names) plus parquet lookups, under the session's shared
    folder.  The lines are joined to their orders and written once, narrow; feeds
    and series lookups are read from there.  Returns (landing folder, lookup source)."""
    from panelgrowth.plans.job import CE_FILES, SM_FILES, materialize
    from panelgrowth.sinks.writers import scratch_path, write_feed_tsv
    from panelgrowth.sources.feeds import LookupSource

    base = scratch_path(spark, "landing")
    # by national file, so each file's write reads its own rows only
    coded = materialize(_coded_lines(spark, sf_dir), "coded_lines", partition_by=["_file"])
    feeds = analog_feeds(spark, sf_dir, coded)
    write_feed_tsv(feeds["sm_facts"], f"{base}/{SM_FILES[0]}.txt")
    for i, name in enumerate(CE_FILES):
        write_feed_tsv(feeds["ce_facts"].filter(F.col("_file") == i).drop("_file"), f"{base}/{name}.txt")
    lookups = LookupSource("parquet", f"{base}/lookups")
    for name, df in feeds.items():
        if not name.endswith("_facts"):
            df.write.mode("overwrite").parquet(lookups.path(name))
    return base, lookups
