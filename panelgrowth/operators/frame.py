"""Frame scope: the source job runs its shifts, percent
changes and rolling means down the whole key-sorted frame, with no grouping,
so the first rows of each series use the previous series' rows.  This
module reproduces that without ever putting the frame in one task.

``series_index``
    0-based position of every row of a frame of series in key order: the rows of
    all series before its own, and its place in its series.  The former is a prefix
    sum over the list of series (one row each, counted on the cluster), taken level
    by level: over the first characters of the first key, over the values of the
    first key that share them, over the series that share its value.  So no task
    orders the series, let alone the rows; positions follow from the values alone, so a
    recomputed task finds the same ones and nothing needs to be checkpointed.

``frame_index``
    The same of any table, whatever its keys.  Rows are range-partitioned
    on the sort keys and sorted within partitions; ``monotonically_increasing_id``
    then carries (partition, position).  The table is checkpointed so the
    numbering is fixed even if executors are lost; per-partition counts (one
    row per partition, a proven bound) give each partition's offset.

bucketed windows
    Rows go to buckets of B consecutive positions.  Each bucket also receives
    a copy of the last H rows of the previous bucket (a halo), so any
    look-back of at most H rows is a plain window inside the bucket.

forward fill across buckets
    The percent-change base is the last non-missing value at or before p
    rows back, which can lie any distance back.  Each bucket's last
    non-missing value is summarised (one row per bucket), carried forward
    over the bucket list, and joined back as the fill for rows that find
    nothing inside their own bucket.  The list is carried level by level
    (summaries of runs of ``CARRY_FAN`` summaries), so no task orders all buckets.

Cost compared with series scope: the cells are written once (a plain table: the
facts are read once, and the passes below read the cells), the lists of series and of
buckets too; then one shuffle by series for the positions and one per bucketed pass.
What a single task orders are the first characters of the first key and the runs of
``CARRY_FAN`` buckets.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelgrowth.operators.enrich import sized_broadcast
from panelgrowth.operators.growth import FAMILIES, ORDER, YEAR_BACK
from panelgrowth.session import checkpoint_dir
from panelgrowth.sinks.writers import materialize

#: Rows of a bucket, at most.
BUCKET_ROWS = 65_536
#: Buckets that the forward fill carries in one task.
CARRY_FAN = 1024
#: Characters of the first key by which its values are dealt out to be ordered.
HEAD_CHARS = 3

_ID_BITS = 33  # monotonically_increasing_id: partition id << 33 | row number


def frame_index(df: DataFrame, sort_keys: Sequence[str], partitions: int | None = None,
                name: str = "frame_index") -> tuple[DataFrame, int]:
    """Add ``name`` = 0-based position in ``sort_keys`` order.

    Returns the indexed frame and its row count.  ``sort_keys`` should be
    unique per row (cells are), so the order is total.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n_parts, *sort_keys)
              .sortWithinPartitions(*sort_keys)
              .withColumn("_mid", F.monotonically_increasing_id())
              .checkpoint(eager=True))
    pid = F.shiftright(F.col("_mid"), _ID_BITS)
    pos = F.col("_mid").bitwiseAND(F.lit((1 << _ID_BITS) - 1))
    counts = ranged.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_pn"))
    # one row per range partition: a bounded table, ordered in one task
    offsets = counts.withColumn("_off", F.coalesce(
        F.sum("_pn").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
    bounds = offsets.agg(F.sum("_pn").alias("n")).collect()[0]["n"] or 0
    indexed = (ranged.withColumn("_pid", pid)
               .join(F.broadcast(offsets.select("_pid", "_off")), "_pid")
               .withColumn(name, F.col("_off") + pos)
               .drop("_pid", "_off", "_mid"))
    return indexed, int(bounds)


def series_starts(df: DataFrame, series_keys: Sequence[str]) -> DataFrame:
    """``series_keys``, ``_base`` (rows of the series before it in key order), ``_n``
    (its own rows): a row per series."""
    first, *rest = series_keys
    counts = df.groupBy(*series_keys).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.unboundedPreceding, -1
    prior = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(*before)), F.lit(0))
    lead = F.substring(F.col(first).cast("string"), 1, HEAD_CHARS)
    values = counts.groupBy(first).agg(F.sum("_n").alias("_n")).withColumn("_head", lead)
    heads = values.groupBy("_head").agg(F.sum("_n").alias("_n")).select("_head", prior(Window.orderBy("_head")).alias("_in_heads"))
    values = (values.withColumn("_in_values", prior(Window.partitionBy("_head").orderBy(first))).join(heads, "_head")
              .select(first, (F.col("_in_heads") + F.col("_in_values")).alias("_base")))
    own = prior(Window.partitionBy(first).orderBy(*rest)) if rest else F.lit(0)
    return counts.withColumn("_own", own).join(values, first).select(
        *series_keys, (F.col("_base") + F.col("_own")).cast("long").alias("_base"), "_n")


def series_index(df: DataFrame, series_keys: Sequence[str], order: Sequence[str] = ORDER,
                 name: str = "frame_index", starts: DataFrame | None = None) -> DataFrame:
    """Add ``name`` = 0-based position in (``series_keys``, ``order``) order.  Keys
    have no missing values (cells have none); (series, order) is unique per row.
    ``starts``: ``series_starts`` of the same rows, written."""
    if starts is None:
        starts = materialize(series_starts(df, series_keys), "series_starts")
    place = F.row_number().over(Window.partitionBy(*series_keys).orderBy(*order)) - 1
    return (df.withColumn("_place", place).join(sized_broadcast(starts.drop("_n")), list(series_keys))
            .select(*[F.col(c) for c in df.columns], (F.col("_base") + F.col("_place")).alias(name)))


def _with_halo(df: DataFrame, idx: str, size: int, halo: int) -> DataFrame:
    """Bucket ``_b`` per row plus a copy of each bucket's last ``halo`` rows
    in the next bucket; ``_own`` marks the original row."""
    b0 = F.floor(F.col(idx) / F.lit(size)).cast("long")
    tail = (F.col(idx) % F.lit(size)) >= F.lit(size - halo)
    out = df.withColumn("_b0", b0).withColumn(
        "_b", F.explode(F.when(tail, F.array(b0, b0 + 1)).otherwise(F.array(b0))))
    return out.withColumn("_own", F.col("_b") == F.col("_b0")).drop("_b0")


def _last_known(x: str, idx: str) -> Column:
    return F.max_by(F.col(x), F.when(F.col(x).isNotNull(), F.col(idx)))


def frame_rolling_means(indexed: DataFrame, idx: str, ytd_months: int, size: int) -> DataFrame:
    """W5/W6 down the frame: ``value_ytd_avg`` and ``value_ann_avg``, in buckets
    (``_b``) of ``size`` rows."""
    w = Window.partitionBy("_b").orderBy(idx)

    def roll(n: int) -> Column:
        if n <= 0:
            return F.lit(None).cast("double")
        f = w.rowsBetween(-(n - 1), 0)
        return F.when(F.count("value").over(f) == F.lit(n), F.avg("value").over(f))

    return (_with_halo(indexed, idx, size, max(ytd_months, YEAR_BACK) - 1)
            .withColumns({"value_ytd_avg": roll(ytd_months), "value_ann_avg": roll(YEAR_BACK)})
            .filter(F.col("_own"))
            .drop("_own"))


def carry_forward(summary: DataFrame, measures: Sequence[str], fan: int = CARRY_FAN) -> DataFrame:
    """``_b`` and ``_carry_<m>``: of each bucket, the last non-missing value of the
    buckets before it.  ``summary`` has one row per bucket (``_b``, ``_last_<m>``).

    Runs of ``fan`` buckets are summarised the same way, that list is carried first,
    and each run is then carried by itself from there."""
    def before(w) -> dict[str, Column]:
        w = w.rowsBetween(Window.unboundedPreceding, -1)
        return {m: F.last(f"_last_{m}", ignorenulls=True).over(w) for m in measures}

    summary = summary.withColumn("_run", F.floor(F.col("_b") / F.lit(fan)).cast("long"))
    runs = summary.groupBy("_run").agg(*[_last_known(f"_last_{m}", "_b").alias(f"_last_{m}") for m in measures])
    above = runs.select("_run", *[c.alias(f"_above_{m}") for m, c in before(Window.orderBy("_run")).items()])
    own = {f"_carry_{m}": c for m, c in before(Window.partitionBy("_run").orderBy("_b")).items()}
    return (summary.withColumns(own).join(above, "_run")
            .select("_b", *[F.coalesce(f"_carry_{m}", f"_above_{m}").alias(f"_carry_{m}") for m in measures]))


def frame_growth_fractions(cells: DataFrame, sort_keys: Sequence[str], ytd_months: int,
                           bucket_rows: int | None = None, idx: str = "frame_index",
                           keep_index: bool = False, fan: int = CARRY_FAN) -> DataFrame:
    """Frame-scope version of ``growth.growth_fractions``: same output
    columns (rolling means, ``_f_<family>``, ``_lag_<family>``).  ``sort_keys`` are
    the series keys, then the two of the order in a series.  The cells are written
    when this is called, and with them the list of series and that of buckets."""
    keys, order = list(sort_keys[:-len(ORDER)]), list(sort_keys[-len(ORDER):])
    cells = materialize(cells, "frame_cells")
    starts = materialize(series_starts(cells, keys), "series_starts")
    if not bucket_rows:  # two buckets a task, of a bounded size
        total = starts.agg(F.sum("_n")).first()[0] or 0
        tasks = int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        bucket_rows = min(-(-total // (2 * tasks)), BUCKET_ROWS)
    size = max(bucket_rows, max(ytd_months, YEAR_BACK) + 1)
    means = frame_rolling_means(series_index(cells, keys, order, idx, starts), idx, ytd_months, size)
    measures = sorted({m for m, _ in FAMILIES.values()})

    # carry: last non-missing value of every measure before each bucket
    summary = means.groupBy("_b").agg(*[_last_known(m, idx).alias(f"_last_{m}") for m in measures])
    carry = sized_broadcast(materialize(carry_forward(summary, measures, fan), "frame_carry"))
    to_here = Window.partitionBy("_b").orderBy(idx).rowsBetween(Window.unboundedPreceding, 0)
    filled = (means.join(carry, "_b", "left")
              .withColumns({f"_ff_{m}": F.coalesce(F.last(m, ignorenulls=True).over(to_here), F.col(f"_carry_{m}"))
                            for m in measures})
              .drop("_b", *[f"_carry_{m}" for m in measures]))

    w = Window.partitionBy("_b").orderBy(idx)
    cols = {}
    for fam, (m, p) in FAMILIES.items():
        base = F.lag(f"_ff_{m}", p).over(w)
        cols[f"_f_{fam}"] = F.when(F.col(m).isNotNull(), F.try_divide(F.col(m), base) - F.lit(1.0))
        cols[f"_lag_{fam}"] = F.lag(m, p).over(w)
    out = (_with_halo(filled, idx, size, YEAR_BACK)
           .withColumns(cols)
           .filter(F.col("_own"))
           .drop("_own", "_b", *[f"_ff_{m}" for m in measures]))
    return out if keep_index else out.drop(idx)
