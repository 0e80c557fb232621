"""panelgrowth: monthly employment-panel growth and peer ranks on Spark.

Sub-packages
------------
functions  column expressions for cleaning and rounding (no Python UDFs)
sources    feed and lookup readers, run-date row, TPC-H-shaped analog panel
operators  enrichment joins, filters, U/S pairing, growth windows, ranks,
           frame-scope (whole-frame order) variants
plans      the panel builds and the five report sections
sinks      overwrite writers (parquet / JDBC) with optional positional index
streaming  (none: the source job is a monthly batch, see module docstring)
"""

from panelgrowth.session import get_spark, checkpoint_dir  # noqa: F401
