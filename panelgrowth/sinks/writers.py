"""Sinks.

Every report table is written in overwrite mode, as parquet under a base
folder or through JDBC with the source job's batch sizes.  The positional
index the source job's writer adds (K7) is optional: it is the row's
position in key order, computed distributed by ``frame_index``; in the
combined state table it restarts at 0 for the metro part, as the source
job's append does.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelgrowth.session import checkpoint_dir

# Insert batch sizes per table.
BATCH_SIZES = {
    "national_rankings_t": 10000,
    "state_rankings": 20000,
    "msa_rankings": 20000,
    "msa_rankings_under": 20000,
    "msa_rankings_over": 20000,
}

# Files that a task of a partitioned write holds open before it sorts its rows.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
MAX_OPEN_FILES = 16


@dataclass
class SinkTarget:
    fmt: str = "parquet"            # parquet | orc | jdbc | any Spark writer format
    base: str = ""
    url: str | None = None
    properties: dict = field(default_factory=dict)
    # JDBC only: at most this many concurrent connections (Spark coalesces
    # the written partitions down to it), so a large cluster does not
    # overwhelm the database
    max_connections: int = 16

    def path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back
    (optionally partitioned, so later filters on those columns prune)."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write.mode("overwrite")
    if not partition_by:
        writer.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    # a task holds a file of each value open, where there are few, and sorts no rows
    before = spark.conf.get(OPEN_FILES, None)
    spark.conf.set(OPEN_FILES, str(MAX_OPEN_FILES))
    try:
        writer.partitionBy(*partition_by).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(OPEN_FILES)
        else:
            spark.conf.set(OPEN_FILES, before)
    return spark.read.schema(df.schema).parquet(path)


def with_position_index(df: DataFrame, sort_keys: Sequence[str], name: str = "index") -> DataFrame:
    """K7: 0-based position in ``sort_keys`` order as column ``name``."""
    from panelgrowth.operators.frame import frame_index
    indexed, _ = frame_index(df, sort_keys, name=name)
    return indexed.select(name, *df.columns)


def write_table(df: DataFrame, name: str, target: SinkTarget, batchsize: int | None = None) -> None:
    """K1-K6, K8: replace the table."""
    if target.fmt == "jdbc":
        props = dict(target.properties)
        props.setdefault("numPartitions", str(target.max_connections))
        if batchsize:
            props["batchsize"] = str(batchsize)
        df.write.mode("overwrite").jdbc(target.url, name, properties=props)
    else:
        df.write.mode("overwrite").format(target.fmt).save(target.path(name))


KEY_ORDER = ("state_name", "area_name", "supersector_name", "industry_name", "year", "Month")
# names before their clean-up, by which a table is ordered where it carries them;
# they are not written
RAW_KEYS = {"supersector_name": "_raw_supersector_name", "industry_name": "_raw_industry_name"}


def _keys(df: DataFrame) -> list[str]:
    return [RAW_KEYS[c] if RAW_KEYS.get(c) in df.columns else c for c in KEY_ORDER if c in df.columns]


def write_reports(reports: dict[str, DataFrame], target: SinkTarget, index: bool = False,
                  entity_parts: dict[str, Sequence[DataFrame]] | None = None,
                  sort: bool = False) -> None:
    """M8: write every report.

    ``index``: add the positional index over the key order (per part, for
    tables listed in ``entity_parts``).  ``sort`` (O1): write rows in key
    order (a range-partitioned global sort; parts stay in append order)."""
    for name, df in reports.items():
        parts = (entity_parts or {}).get(name) or [df]
        if index or (sort and len(parts) > 1):
            keyed = [with_position_index(p, _keys(p)) if index else p for p in parts]
            if sort:
                keyed = [p.withColumn("_part", F.lit(i)) for i, p in enumerate(keyed)]
            df = keyed[0]
            for p in keyed[1:]:
                df = df.unionByName(p)
            if sort:
                df = df.orderBy("_part", *_keys(df)).drop("_part")
        elif sort:
            df = df.orderBy(*_keys(df))
        write_table(df.drop(*RAW_KEYS.values()), name, target, BATCH_SIZES.get(name))


def write_feed_tsv(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write a text feed (tab-separated, header) keeping field padding;
    ``files`` caps the number of part files (one per feed file, as
    published)."""
    if files:
        df = df.coalesce(files)
    (df.write.mode("overwrite")
     .option("sep", "\t").option("header", True)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
