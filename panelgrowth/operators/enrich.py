"""Enrichment joins.

Facts are joined to lookups with inner equi-joins.  Before each join the
lookup drops every non-key column the left side already has, so the left
value wins (the source job keeps the left copy of a clashing name).

A lookup is broadcast only after its rows and bytes were checked against bounds;
above the bound the join is a shuffle join (or AQE's own runtime broadcast when the
shuffled side turns out small), and keys that hold more than ``HOT_SHARE`` of the
facts, which are counted first, are salted: their rows are dealt out over
``SALTS`` tasks, and their lookup rows copied to each.  AQE splits such a key only
where the exchange is the join's own and its rows lie in many map outputs; the salt
holds in any plan.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more than this share of the facts is hot; at most 1 / HOT_SHARE keys are.
HOT_SHARE = 0.01
# Tasks that a hot key's rows are dealt out over.
SALTS = 64
# Lookups at or under this many rows and bytes are broadcast.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 128 << 20


def within_bounds(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                  max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of
    values: one aggregation, of which each task sends one row."""
    size = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + F.lit(16)
                for c in df.columns), F.lit(0))
    row = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return row[0] <= max_rows and row[1] <= max_bytes


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast-hint ``df`` only if it is within the bounds.  Checked anew each
    time: a table that grew is never taken for the small one it was."""
    return F.broadcast(df) if within_bounds(df, max_rows) else df


def hot_keys(facts: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of the rows that have one: fewer than
    1 / ``share`` rows.  One pass over the key columns alone, counted with partial
    counts on the map side, so a hot key is one row a task."""
    from panelgrowth.sinks.writers import materialize
    counts = materialize(facts.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), "key_counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return counts.filter(F.col("_n") > F.lit(share) * F.lit(total)).select(*keys)


def salted_join(facts: DataFrame, lookup: DataFrame, keys: Sequence[str], hot: DataFrame,
                salts: int = SALTS, how: str = "inner") -> DataFrame:
    """``facts`` joined to ``lookup`` with the rows of the ``hot`` keys (a bounded
    list, broadcast) dealt out over ``salts`` tasks each.  A row's salt is a hash of
    its values, so a recomputed task deals the same rows to the same place."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("salted joins keep the rows of the left side: inner, left, left_semi or left_anti")
    keys = list(keys)
    # in a generated column's name no input column can be
    salt, flag = "_salt", "_hot"
    marks = F.broadcast(hot.select(*keys, F.lit(True).alias(flag)).distinct())
    spread = F.when(F.col(flag), F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), F.lit(salts))).otherwise(F.lit(0))
    left = facts.join(marks, keys, "left").withColumn(salt, spread.cast("int")).drop(flag)
    copies = F.when(F.col(flag), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = lookup.join(marks, keys, "left").withColumn(salt, F.explode(copies)).drop(flag)
    return left.join(right, [*keys, salt], how).drop(salt)


def join_lookup(facts: DataFrame, lookup: DataFrame, key: str | Sequence[str],
                how: str = "inner", broadcast_max_rows: int | None = BROADCAST_MAX_ROWS,
                salt: bool = False) -> DataFrame:
    """``facts`` with the lookup's columns; ``salt``: salt measured hot keys where
    the lookup is too large to broadcast."""
    keys = [key] if isinstance(key, str) else list(key)
    keep = [c for c in lookup.columns if c in keys or c not in facts.columns]
    right = lookup.select(*keep)
    if broadcast_max_rows is not None and within_bounds(right, broadcast_max_rows):
        return facts.join(F.broadcast(right), keys, how)
    if salt:
        hot = hot_keys(facts, keys)
        if hot.head(1):
            return salted_join(facts, right, keys, hot, how=how)
    return facts.join(right, keys, how)


def enrich(facts: DataFrame, lookups: Iterable[tuple[DataFrame, str | Sequence[str]]],
           broadcast_max_rows: int | None = BROADCAST_MAX_ROWS, salt: bool = False) -> DataFrame:
    """A chain of inner lookups, in the order given.  ``salt`` holds for the
    first, the series lookup: the others are codes with few values."""
    out = facts
    for i, (lookup, key) in enumerate(lookups):
        out = join_lookup(out, lookup, key, "inner", broadcast_max_rows, salt and i == 0)
    return out
