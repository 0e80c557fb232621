from panelgrowth.functions.clean import (  # noqa: F401
    NUMERIC_TEXT, WHITESPACE, lenient_double, month_from_period, pct_round,
    remove, round2, strip_all, zero_pad, ytd_months_for,
)
