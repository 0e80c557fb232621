"""Sums of doubles that do not depend on the order of the rows.

A sum of doubles rounds at every step, so its last digits follow the order in
which a shuffle delivers the partial sums.  Here a value is split into multiples of
2^40, a whole part and millionths, all added up as whole numbers, and the total is
turned into the nearest double once.  Values are taken to ``DIGITS`` decimals: exact for
decimal values up to 4 * 10^9 (where a double still tells millionths apart);
larger ones are taken to the decimals they have.  A value or total of 10^31 is an
error, not a loss.  All of it stays in generated code, with partial sums of 24 bytes
a measure on the map side.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Decimals of a value.
DIGITS = 6
UNIT = 10 ** DIGITS
#: Whole numbers below it are added by themselves, so that no sum of them overflows.
HIGH = 1 << 40


def _parts(name: str, value: Column) -> list[Column]:
    """The partial sums of ``value``: multiples of ``HIGH``, whole parts, millionths."""
    high = (value / F.lit(float(HIGH))).cast("long")  # towards zero
    low = value - high.cast("double") * F.lit(float(HIGH))
    rest = F.rint((low - F.floor(low)) * F.lit(float(UNIT)))
    return [F.sum(high).alias(f"_{name}_high"), F.sum(F.floor(low)).alias(f"_{name}_whole"),
            F.sum(rest.cast("long")).alias(f"_{name}_rest")]


def _total(name: str) -> Column:
    high, whole, rest = (F.col(f"_{name}_{x}") for x in ("high", "whole", "rest"))
    millionths = (rest.cast("decimal(19,0)") / F.lit(UNIT).cast("decimal(7,0)")).cast(f"decimal(26,{DIGITS})")
    units = high.cast("decimal(20,0)") * F.lit(HIGH).cast("decimal(13,0)") + whole.cast("decimal(20,0)") + millionths
    # the usual case has a whole part alone, which a double holds as it is
    return F.when((high == 0) & (rest == 0), whole.cast("double")).otherwise(units.cast("double"))


def exact_sums(df: DataFrame, keys: list[str], sums: Mapping[str, Column], *others: Column) -> DataFrame:
    """``keys``, the named sums, and the other aggregates of each group.

    A sum of no value is NULL, as the plain one."""
    kept = df.groupBy(*keys).agg(*[p for name, value in sums.items() for p in _parts(name, value)], *others)
    names = [c for c in kept.columns if c not in keys and not any(
        c in (f"_{s}_high", f"_{s}_whole", f"_{s}_rest") for s in sums)]
    return kept.select(*[F.col(f"`{c}`") for c in keys], *[_total(s).alias(s) for s in sums], *[F.col(c) for c in names])
