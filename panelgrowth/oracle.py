"""DuckDB statements that restate each registered query, for the
correctness gate (``__spark_entry__.oracle_sql``).

They are written the way the source job reads: the unadjusted and adjusted
sums are separate aggregations joined afterwards; average ranks count ties
with a second window; rounding is DuckDB's half-even on doubles.  Tables
``region nation customer orders lineitem ...`` are views over the parquet
files.
"""

from __future__ import annotations

D = "::DOUBLE"

RAW = f"""raw AS (
  SELECT l.l_orderkey, l.l_linenumber,
    CASE WHEN l.l_suppkey % 2 = 0 THEN 'Statewide'
         ELSE n.n_name || CASE n.n_nationkey % 4
                            WHEN 0 THEN ' Metropolitan Statistical Area'
                            WHEN 1 THEN ' NECTA'
                            WHEN 2 THEN ' Metropolitan Division'
                            ELSE ' NECTA Division' END
    END AS area_name,
    r.r_name AS state_name,
    c.c_mktsegment AS supersector_name,
    CASE WHEN l.l_returnflag = 'N' THEN 'Total Nonfarm' ELSE l.l_returnflag END AS industry_name,
    CASE WHEN l.l_linenumber = 7 THEN 'M13'
         ELSE 'M' || lpad(CAST(month(l.l_shipdate) AS VARCHAR), 2, '0') END AS period,
    CAST(year(l.l_shipdate) AS VARCHAR) AS year,
    CAST(l.l_quantity AS DOUBLE) AS value,
    CASE WHEN l.l_linenumber <= 5 THEN '1' ELSE '2' END AS data_type_code,
    CASE l.l_linestatus WHEN 'F' THEN 'U' WHEN 'O' THEN 'S' END AS seasonal,
    CAST(l.l_extendedprice AS DOUBLE) AS size
  FROM lineitem l
  JOIN orders o ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON c.c_custkey = o.o_custkey
  JOIN nation n ON n.n_nationkey = c.c_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey
)"""

CLEANED = """cleaned AS (
  SELECT l_orderkey, l_linenumber,
    replace(replace(area_name, ' NECTA', ''), 'Metropolitan Statistical Area', '') AS area_name,
    replace(state_name, chr(13), '') AS state_name,
    replace(supersector_name, chr(13), '') AS supersector_name,
    industry_name, period, year, value,
    CASE WHEN length(data_type_code) < 2 THEN lpad(data_type_code, 2, '0')
         ELSE data_type_code END AS data_type_code,
    seasonal, size
  FROM raw
  WHERE NOT coalesce(contains(area_name, 'Metropolitan Division'), false)
    AND NOT coalesce(contains(area_name, 'NECTA Division'), false)
)"""

SPLIT_WHERE = """data_type_code = '01'
    AND state_name IS DISTINCT FROM 'District of Columbia'
    AND state_name IS DISTINCT FROM 'Virgin Islands'
    AND state_name IS DISTINCT FROM 'Puerto Rico'
    AND period IS DISTINCT FROM 'M13'"""

PANEL = f"""panel AS (
  SELECT l_orderkey, l_linenumber, area_name, state_name, supersector_name, industry_name,
         replace(period, 'M', '') AS Month, year, value, data_type_code, seasonal, size
  FROM cleaned
  WHERE seasonal IN ('U', 'S') AND {SPLIT_WHERE}
)"""

NATIONAL_PANEL = """npanel AS (
  SELECT l_orderkey, l_linenumber, supersector_name, industry_name,
         replace(period, 'M', '') AS Month, year, value, data_type_code, seasonal
  FROM raw
  WHERE seasonal IN ('U', 'S') AND period IS DISTINCT FROM 'M13'
)"""

BASE = f"WITH {RAW},\n{CLEANED},\n{PANEL},\n{NATIONAL_PANEL}"
# the same panel with nation names as state names
BASE_NATION = BASE.replace("r.r_name AS state_name", "n.n_name AS state_name")

# the analog facts with the values that the rules act on
EDGE_RAW = RAW.replace("raw AS (", "raw0 AS (", 1) + """,
raw AS (
  SELECT * REPLACE (
    CASE WHEN state_name = 'AFRICA' THEN 'Puerto Rico'
         WHEN state_name = 'ASIA' AND l_orderkey % 2 = 1 THEN 'AS' || chr(13) || 'IA' || chr(13)
         WHEN state_name = 'EUROPE' AND l_orderkey % 11 = 0 THEN NULL ELSE state_name END AS state_name,
    CASE WHEN supersector_name = 'HOUSEHOLD' AND l_orderkey % 3 = 0
         THEN chr(13) || 'HOUSEHOLD' || chr(13) ELSE supersector_name END AS supersector_name,
    CASE WHEN l_orderkey % 4 = 0 THEN NULL WHEN l_orderkey % 13 = 0 THEN 0
         WHEN supersector_name = 'MACHINERY' THEN 0.125 ELSE floor(size) / 8 END::DOUBLE AS value)
  FROM raw0
)"""
BASE_EDGE = f"WITH {EDGE_RAW},\n{CLEANED},\n{PANEL},\n{NATIONAL_PANEL}"

TAIL = ["supersector_name", "industry_name", "year", "Month"]


def round2(x: str) -> str:
    return f"(round_even(({x}) * 100{D}, 0) / 100{D})"


def pct(x: str) -> str:
    return round2(f"({x}) * 100{D}")


def pair_ctes(source: str, where: str, entity: str | None, how: str,
              value_from: str = "U", total: str = "sum(value)") -> str:
    """Two group sums (``total``) joined on the cell keys."""
    keys = ([entity] if entity else []) + TAIL
    k = ", ".join(keys)
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    join = "LEFT JOIN" if how == "left" else "JOIN"
    on = " AND ".join(f"u.{c} = s.{c}" for c in keys)
    uk = ", ".join(f"u.{c}" for c in keys)
    return f"""u AS (
  SELECT {k}, {total} AS value FROM {source}
  WHERE seasonal = '{value_from}' AND {where} AND {notnull} GROUP BY {k}
),
s AS (
  SELECT {k}, {total} AS value_mom FROM {source}
  WHERE seasonal = 'S' AND {where} AND {notnull} GROUP BY {k}
),
cells AS (
  SELECT {uk}, u.value, s.value_mom FROM u {join} s ON {on}
)"""


def metric_ctes(series_keys: list[str], k: int, order: str = "year, Month",
                frame_order: bool = False) -> str:
    """Rolling means, unrounded fractions and raw lags over ``cells``."""
    part = "" if frame_order else f"PARTITION BY {', '.join(series_keys)} "
    ordr = f"ORDER BY {order}"
    w = f"{part}{ordr}"

    def roll(n: int) -> str:
        if n <= 0:
            return "CAST(NULL AS DOUBLE)"
        f = f"({w} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
        return f"CASE WHEN count(value) OVER {f} = {n} THEN avg(value) OVER {f} END"

    def frac(x: str, p: int) -> str:
        base = f"last_value({x} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND {p} PRECEDING)"
        return f"CASE WHEN {x} IS NOT NULL THEN {x} / nullif({base}, 0) - 1 END"

    fams = {"mom": ("value_mom", 1), "ytd": ("value_ytd_avg", 12),
            "ann": ("value_ann_avg", 12), "yoy": ("value", 12)}
    fr = ",\n    ".join(
        f"{frac(x, p)} AS f_{fam},\n    lag({x}, {p}) OVER ({w}) AS lag_{fam}"
        for fam, (x, p) in fams.items())
    return f"""m1 AS (
  SELECT *, {roll(k)} AS value_ytd_avg, {roll(12)} AS value_ann_avg FROM cells
),
m2 AS (
  SELECT *,
    {fr}
  FROM m1
)"""


def finish_cols() -> dict[str, str]:
    out = {}
    for fam in ("mom", "ytd", "ann", "yoy"):
        sfx = "" if fam == "yoy" else f"_{fam}"
        out[f"pct_change{sfx}"] = pct(f"f_{fam}")
        out[f"abs_change{sfx}"] = round2(f"lag_{fam} * f_{fam}")
    return out


PEER = "supersector_name, industry_name, year, Month"


def rank_first_sql(f: str, entity: str) -> str:
    return (f"CASE WHEN {f} IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY {PEER} "
            f"ORDER BY {f} DESC NULLS LAST, {entity} ASC) AS DOUBLE) END")


def rank_average_sql(f: str) -> str:
    return (f"CASE WHEN {f} IS NOT NULL THEN CAST(rank() OVER (PARTITION BY {PEER} "
            f"ORDER BY {f} DESC NULLS LAST) AS DOUBLE) + "
            f"(count(*) OVER (PARTITION BY {PEER}, {f}) - 1) / 2.0{D} END")


def report_sql(entity: str, where: str, how: str, k: int, mom_ties: str,
               value_from: str = "U", source: str = "panel", frame: bool = False,
               extra_ctes: str = "", base: str = BASE) -> str:
    keys = [entity, "supersector_name", "industry_name"]
    order = ", ".join(keys + ["year", "Month"]) if frame else "year, Month"
    rk_mom = rank_first_sql("f_mom", entity) if mom_ties == "first" else rank_average_sql("f_mom")
    fin = finish_cols()
    cols = [entity, "supersector_name", "industry_name", "year", "Month", "value", "value_mom",
            f"{fin['pct_change_mom']} AS pct_change_mom", f"{rk_mom} AS rank_mom",
            f"{fin['abs_change_mom']} AS abs_change_mom",
            "value_ytd_avg", f"{fin['pct_change_ytd']} AS pct_change_ytd",
            f"{rank_first_sql('f_ytd', entity)} AS rank_ytd",
            f"{fin['abs_change_ytd']} AS abs_change_ytd",
            "value_ann_avg", f"{fin['pct_change_ann']} AS pct_change_ann",
            f"{rank_first_sql('f_ann', entity)} AS rank_ann",
            f"{fin['abs_change_ann']} AS abs_change_ann",
            f"{fin['pct_change']} AS pct_change",
            f"{rank_first_sql('f_yoy', entity)} AS rank",
            f"{fin['abs_change']} AS abs_change"]
    sel = ",\n  ".join(cols)
    return (f"{base},\n{extra_ctes}{pair_ctes(source, where, entity, how, value_from)},\n"
            f"{metric_ctes(keys, k, order, frame)}\nSELECT\n  {sel}\nFROM m2")


def national_index_sql(k: int) -> str:
    """National table over names that the clean-up changes and merges, numbered
    by the names before it."""
    renamed = """rpanel AS (
  SELECT * REPLACE (CASE supersector_name WHEN 'BUILDING' THEN 'Goods-Producing'
    WHEN 'MACHINERY' THEN 'Goods Producing' || chr(13) ELSE supersector_name END AS supersector_name)
  FROM npanel
)"""
    sql = national_sql(k).replace(f"{BASE},\n", f"{BASE},\n{renamed},\n", 1)
    head, tail = sql.split(renamed)
    tail = tail.replace("FROM npanel", "FROM rpanel")
    tail = tail.replace("\nSELECT\n  ", "\nSELECT\n  row_number() OVER (ORDER BY m2.supersector_name, "
                        "m2.industry_name, m2.year, m2.Month) - 1 AS index,\n  ")
    return head + renamed + tail


def national_sql(k: int, frame: bool = False, base: str = BASE) -> str:
    keys = ["supersector_name", "industry_name"]
    order = "supersector_name, industry_name, year, Month"
    fin = finish_cols()
    def clean(c):
        return f"replace(replace({c}, chr(13), ''), 'Goods-Producing', 'Goods Producing') AS {c}"
    cols = [clean("supersector_name"), clean("industry_name"), "year", "Month", "value",
            "value_mom", "value_ytd_avg", f"{fin['pct_change_ytd']} AS pct_change_ytd",
            "'' AS rank_ytd", f"{fin['abs_change_ytd']} AS abs_change_ytd",
            "value_ann_avg", f"{fin['pct_change_ann']} AS pct_change_ann", "'' AS rank_ann",
            f"{fin['abs_change_ann']} AS abs_change_ann", "'' AS rank",
            f"{fin['pct_change']} AS pct_change", f"{fin['abs_change']} AS abs_change",
            "'United States' AS area_name", "'United States' AS state_name",
            f"{fin['pct_change_mom']} AS pct_change_mom", "'' AS rank_mom",
            f"{fin['abs_change_mom']} AS abs_change_mom"]
    sel = ",\n  ".join(cols)
    return (f"{base},\n{pair_ctes('npanel', 'TRUE', None, 'inner')},\n"
            f"{metric_ctes(keys, k, order if frame else 'year, Month', frame)}\n"
            f"SELECT\n  {sel}\nFROM m2")
