"""Peer ranks.

An entity's rank among the entities of the same supersector, industry,
year and month, by descending growth fraction (unrounded).  Missing
fractions stay unranked.

* ``first``: ties broken by frame order, which inside one peer group is the
  entity name ascending.
* ``average``: tied entities share the mean of the positions they cover:
  (lowest position + highest position) / 2, both from one ordered window.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PEER_KEYS = ("supersector_name", "industry_name", "year", "Month")


def rank_first(frac: Column, entity: str, peer_keys: Sequence[str] = PEER_KEYS) -> Column:
    w = Window.partitionBy(*peer_keys).orderBy(frac.desc_nulls_last(), F.col(entity).asc())
    return F.when(frac.isNotNull(), F.row_number().over(w).cast("double"))


def rank_average(frac: Column, peer_keys: Sequence[str] = PEER_KEYS) -> Column:
    w = Window.partitionBy(*peer_keys).orderBy(frac.desc_nulls_last())
    # default frame: RANGE unbounded preceding .. current row, ties included
    highest = F.count(frac).over(w)
    lowest = F.rank().over(w)
    return F.when(frac.isNotNull(), (lowest + highest).cast("double") / F.lit(2.0))


def with_peer_ranks(df: DataFrame, entity: str, ranks: dict[str, tuple[str, str]],
                    peer_keys: Sequence[str] = PEER_KEYS) -> DataFrame:
    """``ranks``: output column -> (fraction column, 'first' | 'average')."""
    cols = {}
    for out, (frac, method) in ranks.items():
        if method == "first":
            cols[out] = rank_first(F.col(frac), entity, peer_keys)
        elif method == "average":
            cols[out] = rank_average(F.col(frac), peer_keys)
        else:
            raise ValueError(f"unknown tie rule {method!r}")
    return df.withColumns(cols)


# --- peer groups too large for one task -------------------------------------

# A window keeps one peer group in one task.  Above this many rows in the
# largest group, ranks are computed from a distributed global sort instead.
MAX_WINDOW_GROUP_ROWS = 2_000_000


def largest_peer_group(df: DataFrame, peer_keys: Sequence[str] = PEER_KEYS) -> int:
    """Rows in the largest peer group (one aggregation, partial sums map-side)."""
    row = df.groupBy(*peer_keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n")).first()
    return int(row[0] or 0)


def sorted_ranks(df: DataFrame, entity: str, ranks: dict[str, tuple[str, str]],
                 peer_keys: Sequence[str] = PEER_KEYS) -> DataFrame:
    """W10/W11 without a window over a peer group, from one range sort for all
    rank columns.

    A row is melted into one row a fraction column (the first of them carries the
    whole row), and all are numbered in (fraction column, peer group, fraction
    descending, entity) order by ``frame_index``: range-partitioned, so a peer
    group spreads over many tasks.  A position in the group is the number minus
    that of the group's first row; tied rows share the first and the last of
    theirs.  The melted rows then meet again by (peer group, entity), of which a
    frame holds one row each."""
    from panelgrowth.operators.enrich import sized_broadcast
    from panelgrowth.operators.frame import frame_index

    unknown = {m for _, m in ranks.values()} - {"first", "average"}
    if unknown:
        raise ValueError(f"unknown tie rule {unknown.pop()!r}")
    peer_keys, fractions = list(peer_keys), list(dict.fromkeys(f for f, _ in ranks.values()))
    key = [*peer_keys, entity]
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in key])
    melted = df.select(*key, F.explode(F.array(*[
        F.struct(F.lit(i).alias("_fam"), F.col(f).alias("_frac"), (row if i == 0 else F.lit(None)).alias("_row"))
        for i, f in enumerate(fractions)])).alias("_m")).select(*key, "_m.*")
    # unranked rows last, each in its own group's order
    melted = melted.withColumns({"_none": F.col("_frac").isNull(), "_down": -F.col("_frac")})
    numbered, _ = frame_index(melted, ["_fam", *peer_keys, "_none", "_down", entity], name="_at")
    starts = numbered.groupBy("_fam", *peer_keys).agg(F.min("_at").alias("_start"))
    placed = _null_safe(numbered, sized_broadcast(starts), ["_fam", *peer_keys])
    tied = {fractions.index(f) for f, m in ranks.values() if m == "average"}
    if tied:
        ties = (numbered.filter(F.col("_fam").isin(*tied) & ~F.col("_none")).groupBy("_fam", *peer_keys, "_frac")
                .agg(F.min("_at").alias("_low"), F.max("_at").alias("_high")).filter("_low < _high"))
        placed = _null_safe(placed, sized_broadcast(ties), ["_fam", *peer_keys, "_frac"])
    place = {"first": F.col("_at") - F.col("_start") + 1.0}
    if tied:
        place["average"] = F.coalesce((F.col("_low") + F.col("_high")) / 2.0, F.col("_at")) - F.col("_start") + 1.0
    out = placed.groupBy(*key).agg(
        F.first("_row", ignorenulls=True).alias("_row"),
        *[F.max(F.when((F.col("_fam") == fractions.index(f)) & ~F.col("_none"), place[m].cast("double"))).alias(name)
          for name, (f, m) in ranks.items()])
    cols = [F.col(c) if c in key else F.col(f"_row.`{c}`") for c in df.columns]
    return out.select(*cols, *ranks)


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join in which missing keys match, with the left copy of the keys."""
    other = right.select(*[F.col(c).alias(f"_r{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(c).eqNullSafe(F.col(f"_r{c}")) for c in keys]
    return left.join(other, on, "left").drop(*[f"_r{c}" for c in keys])


def peer_ranks(df: DataFrame, entity: str, ranks: dict[str, tuple[str, str]],
               peer_keys: Sequence[str] = PEER_KEYS, strategy: str = "auto",
               max_window_rows: int = MAX_WINDOW_GROUP_ROWS) -> DataFrame:
    """Peer ranks with a strategy: ``window`` (one task per peer group),
    ``sorted`` (distributed sort), or ``auto`` (window unless the largest
    group exceeds ``max_window_rows``)."""
    if strategy == "auto":
        strategy = "window" if largest_peer_group(df, peer_keys) <= max_window_rows else "sorted"
    if strategy == "window":
        return with_peer_ranks(df, entity, ranks, peer_keys)
    if strategy != "sorted":
        raise ValueError("strategy must be 'auto', 'window' or 'sorted'")
    return sorted_ranks(df, entity, ranks, peer_keys)
