"""Shared helpers: written tables, input columns, connected components."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelgrowth.session import checkpoint_dir
from panelgrowth.sinks.writers import scratch_path

#: Fixed value: characters that are not part of a word separator.
WORD = r"[^\x20\x09-\x0D]+"
#: Fixed value: a run of word separators.
GAP = r"[\x20\x09-\x0D]+"
#: Edges of a task of the union-find.
EDGES_OF_TASK = 250_000


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a table in the shared folder and read back.

    Cuts the lineage: a lost executor rereads files instead of recomputing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, label: str) -> str:
    """URI of a fresh folder in the shared checkpoint folder, for files that tasks write."""
    return scratch_path(spark, label)


def pinned(df: DataFrame) -> DataFrame:
    """``df`` checkpointed in the shared folder (small iteration state)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def only(df: DataFrame, **columns: tuple[str, str]) -> DataFrame:
    """The named input columns cast to their types; a missing one becomes NULL.

    ``columns`` maps the output name to (input column, type).  Extra columns,
    whatever their names, never reach the operator.
    """
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{src}`").cast(kind) if src in have else F.lit(None).cast(kind)).alias(out)
        for out, (src, kind) in columns.items()])


def words_of(text: Column) -> Column:
    """Array of the words of ``text``; NULL and blank texts give an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words of ``text`` (NULL: 0), without building the words.

    A leading or trailing separator makes one empty field each.
    """
    t = F.coalesce(text, F.lit(""))
    fields = F.size(F.split(t, GAP))
    edge = lambda c: F.when(c.isin(" ", "\t", "\n", "\x0b", "\f", "\r"), 1).otherwise(0)
    # a text of separators only splits into two empty fields, as both edges say
    return F.when(t == "", F.lit(0)).otherwise(
        fields - edge(F.substring(t, 1, 1)) - edge(F.substring(t, -1, 1))).cast("long")


def components(edges: DataFrame, a: str, b: str, kind: str = "long") -> DataFrame:
    """Distributed union-find: ``node``, ``component`` = least node reachable.

    ``edges`` are undirected pairs of comparable ids.  Alternates the large
    star and the small star until no edge changes: every node points at a
    smaller neighbour of its neighbours.  A hub's neighbours are reduced to
    their minimum before the shuffle and joined back (a join that adaptive
    execution splits), never gathered in one task.  Each round is
    checkpointed; only a count and a checksum reach the driver.  Nodes
    without an edge to another node have no row.  Self edges and NULL ends
    are ignored.
    """
    e = edges.select(F.col(a).cast(kind).alias("u"), F.col(b).cast(kind).alias("v"))
    e = e.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = pinned(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    # a round makes at most twice the rows: tasks (and shuffle files) by the state's size
    parts = max(8, 1 + e.count() // EDGES_OF_TASK)
    state = None
    while True:
        # large star: every larger neighbour of u (and u) points at u's least neighbour
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").coalesce(parts))
        # small star: u and its smaller neighbours point at the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").coalesce(parts)
        e = pinned(small.unionByName(least.select("u", F.col("m").alias("v")).coalesce(parts)).distinct().coalesce(parts))
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == state:
            break
        state = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def schema(**fields: str) -> str:
    """DDL of the given fields, in order."""
    return ", ".join(f"`{k}` {v}" for k, v in fields.items())


def empty_like(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], T.StructType.fromDDL(ddl))


def batches(rows: Iterable, size: int) -> Iterable[list]:
    """Lists of up to ``size`` items."""
    out: list = []
    for x in rows:
        out.append(x)
        if len(out) >= size:
            yield out
            out = []
    if out:
        yield out
