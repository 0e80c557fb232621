"""Cleaning and rounding as built-in column expressions.

Every function takes and returns a ``Column`` so Catalyst can fold it into
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
# The characters Python's str.strip() removes from byte strings.
WHITESPACE = " \t\n\r\x0b\x0c"
# Text that the lenient numeric parse accepts; anything else becomes NULL.
NUMERIC_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_all(c) -> Column:
    """Trim all ASCII whitespace from both ends (Spark's trim only strips
    blanks)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def zero_pad(c, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer text is kept whole."""
    c = _col(c)
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def remove(c, fragment: str) -> Column:
    """Remove every occurrence of a literal fragment."""
    return F.replace(_col(c), F.lit(fragment), F.lit(""))


def month_from_period(c) -> Column:
    """X3f: 'M01' -> '01' (every 'M' removed)."""
    return remove(c, "M")


def lenient_double(c) -> Column:
    """Parse text as double; text that is not a plain decimal or
    exponent number (blank, '-', 'NaN', '1,000', '1d', ...) becomes NULL, and so
    does a number beyond the range of a double ('1e400')."""
    c = _col(c)
    return finite(F.when(c.rlike(NUMERIC_TEXT), c.try_cast("double")))


def finite(c) -> Column:
    """The value; NULL where it is NaN or infinite."""
    c = _col(c)
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def round2(c) -> Column:
    """Round to 2 decimals, half to even on the binary double
    (numpy's ``round(x, 2)``: rint(x * 100) / 100)."""
    return F.rint(_col(c) * F.lit(100.0)) / F.lit(100.0)


def pct_round(c) -> Column:
    """Fraction -> percent with 2 decimals: round2(x * 100)."""
    return round2(_col(c) * F.lit(100.0))


def ytd_months_for(as_of: _dt.date) -> int:
    """The year-to-date width for a run date: the previous month number
    (0 in January)."""
    return as_of.month - 1
