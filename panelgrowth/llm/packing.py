"""Conflict-constrained best-fit packing of documents into sequences.

Documents are cut into pieces of at most the capacity; pieces are placed,
largest first, into the tightest bin with enough room that has no conflict:
a bin holds no two documents of one duplicate cluster, and at most
``source_limit`` pieces of one source.  Bins are ordered by their residual;
each carries a bitmap of the sources that are at their limit and one of its
clusters.  The search starts at the tightest bin that has the room and goes
on to its successors until one is compatible.  A bitmap may say "conflict"
for another source or cluster with the same bit; the bin's exact set decides
then, so no compatible bin is passed over.

The work is split into blocks by a hash of the piece, about ``BLOCK_ROWS``
pieces each, so one task never holds more than a block.  Each block packs its
own bins; at most one bin in thousands is less full for it.

Defined results: a document without words (NULL or blank text) takes no room
and gets no bin (``bin`` NULL, one row).  NULL is a source like another.  A
NULL cluster conflicts with nothing.  Rows that repeat a document are placed
like others (and, being of one cluster, in different bins).  An empty table
gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrowth.llm.common import GAP, only, word_count, written

CAPACITY = 2048      # words of a sequence
SOURCE_LIMIT = 4     # pieces of one source in a bin
BLOCK_ROWS = 50_000  # pieces of a block, about
BITS = 64

SCHEMA = ("doc_id long, piece int, piece_start long, n_words long, bin string, "
          "bin_offset long, block long")


class Bins:
    """Open bins of one block in order of residual, then age."""

    def __init__(self, capacity: int, source_limit: int):
        self.capacity, self.limit = capacity, source_limit
        self.order: list[tuple[int, int]] = []   # (residual, bin)
        self.full: list[int] = []                # bitmap of sources at their limit
        self.seen: list[int] = []                # bitmap of clusters
        self.sources: list[dict] = []
        self.clusters: list[set] = []

    def conflict(self, b: int, source, cluster, sbit: int, cbit: int) -> bool:
        if self.full[b] & sbit and self.sources[b].get(source, 0) >= self.limit:
            return True
        return cluster is not None and bool(self.seen[b] & cbit) and cluster in self.clusters[b]

    def place(self, size: int, source, cluster, sbit: int, cbit: int) -> tuple[int, int]:
        """(bin, offset in it) of the tightest compatible bin; a new one if none is."""
        for i in range(bisect_left(self.order, (size, -1)), len(self.order)):
            residual, b = self.order[i]
            if not self.conflict(b, source, cluster, sbit, cbit):
                del self.order[i]
                break
        else:
            residual, b = self.capacity, len(self.full)
            self.full.append(0)
            self.seen.append(0)
            self.sources.append({})
            self.clusters.append(set())
        n = self.sources[b][source] = self.sources[b].get(source, 0) + 1
        if n >= self.limit:
            self.full[b] |= sbit
        if cluster is not None:
            self.seen[b] |= cbit
            self.clusters[b].add(cluster)
        if residual > size:  # a full bin can take nothing more
            insort(self.order, (residual - size, b))
        return b, self.capacity - residual


def pack_block(rows: pd.DataFrame, capacity: int, source_limit: int) -> pd.DataFrame:
    """Places the pieces of one block: columns ``b`` and ``bin_offset``."""
    rows = rows.sort_values(["n_words", "cluster", "doc_id", "piece", "source"],
                            ascending=[False, True, True, True, True], na_position="last", kind="stable")
    bins = Bins(capacity, source_limit)
    out = [bins.place(int(n), s, None if pd.isna(c) else c, 1 << int(sb), 1 << int(cb)) for n, s, c, sb, cb in
           zip(rows["n_words"], rows["source"], rows["cluster"], rows["sbit"], rows["cbit"])]
    return rows.assign(b=[x[0] for x in out], bin_offset=[x[1] for x in out])


def pieces(docs: DataFrame, capacity: int, cluster: str | None) -> DataFrame:
    """One row per piece of at most ``capacity`` words, without the text."""
    d = only(docs, doc_id=("doc_id", "long"), text=("text", "string"), source=("source", "string"),
             cluster=(cluster or "cluster", "string"))
    if cluster is None:
        # copies up to case and spacing form a cluster
        d = d.withColumn("cluster", F.hex(F.xxhash64(F.regexp_replace(F.lower(F.trim("text")), GAP, " "))))
    d = d.select("doc_id", F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1")).alias("source"), "cluster",
                 word_count(F.col("text")).alias("size"))
    d = d.withColumn("piece", F.explode(F.sequence(F.lit(0), F.greatest(
        F.ceil(F.col("size") / capacity).cast("int") - 1, F.lit(0)))))
    return d.withColumn("piece_start", F.col("piece").cast("long") * capacity).withColumn(
        "n_words", F.least(F.lit(capacity).cast("long"), F.col("size") - F.col("piece_start"))).drop("size")


def best_fit(docs: DataFrame, capacity: int = CAPACITY, source_limit: int = SOURCE_LIMIT,
             cluster: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """doc_id, piece, piece_start (first word), n_words, bin, bin_offset, block:
    one row per piece.  ``cluster`` names the duplicate-cluster column; without
    it copies up to case and spacing are a cluster."""
    rows = written(pieces(docs, capacity, cluster), "pack-pieces")
    todo = rows.where("n_words > 0")
    n_blocks = max(1, -(-todo.count() // block_rows))
    # copies of one document differ in nothing but the draw that deals them out
    todo = todo.withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(n_blocks)))
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS))
    todo = todo.withColumn("sbit", bit("source")).withColumn("cbit", bit("cluster"))

    def packed(key, rows: pd.DataFrame) -> pd.DataFrame:
        out = pack_block(rows, capacity, source_limit)
        out["bin"] = [f"{key[0]}-{b}" for b in out["b"]]
        return out[["doc_id", "piece", "piece_start", "n_words", "bin", "bin_offset", "block"]]

    done = todo.groupBy("block").applyInPandas(packed, SCHEMA)
    rest = rows.where("n_words = 0").select(
        "doc_id", "piece", "piece_start", "n_words", F.lit(None).cast("string").alias("bin"),
        F.lit(None).cast("long").alias("bin_offset"), F.lit(None).cast("long").alias("block"))
    return done.unionByName(rest)
