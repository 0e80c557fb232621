"""Shards by a k-d tree over document metadata.

The tree is cut from the top.  A node that stands for k shards is split for
k // 2 and the rest, along the dimension in which its documents spread widest
(its extent as a share of the table's own; ties to the dimension listed
first), at the weighted median: the bytes to its left are to those to its
right as the shards are.  Leaves are the shards, of near equal bytes.

Medians are found on the cluster, all nodes of a level at once.  Each round adds
up the bytes of each node by ``BINS`` ranges of its dimension, and goes on in the
range in which the median lies, until that holds ``tolerance`` of a shard or one
row.  Rows of the same value are told apart by a hash of the text (copies stay
together unless the cut falls into their group), then the id, then a row number
that is written once, so that no value, however frequent, makes a shard too
large.  The driver sees at most ``BINS`` sums a node; a row is read once a round.

Defined results: a NULL text has size 1 and checksum 0, as an empty one.  A NULL
source, language or id is a value below all others.  Rows that repeat an id or a
text are rows of their own.  Fewer rows than shards leave some empty.  An empty
table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelgrowth.llm.common import only, written
from panelgrowth.operators.frame import frame_index

SHARDS = 16
BINS = 4096
#: Share of a shard's bytes that a cut may be off, where a range of rows is not taken apart further.
TOLERANCE = 1 / 2000
#: Levels after which the nodes are written.
WRITTEN_LEVELS = 4
#: Values that tell rows of one dimension value apart, in order.
TIES = ("_tie", "_id", "_row")
LAST = (1 << 63) - 1
FIRST = -(1 << 63)


def category(c: str) -> Column:
    """A text as a number: equal texts together, spread over 31 bits."""
    return F.when(F.col(c).isNull(), F.lit(-1)).otherwise(F.shiftrightunsigned(F.xxhash64(c), 33)).cast("long")


def log_size() -> Column:
    return F.rint(F.log2("size") * F.lit(float(1 << 20))).cast("long")


#: Dimensions of ``documents``, as numbers.
DIMENSIONS = {"source": lambda: category("source"), "lang": lambda: category("lang"),
              "size": log_size, "doc_id": lambda: F.coalesce("doc_id", F.lit(-1))}


@dataclass
class Search:
    """Where a node's weighted median is looked for."""

    dim: int                     # its dimension
    wanted: int                  # bytes that belong to the left
    lo: int
    hi: int
    before: int = 0              # bytes known to lie before the range
    fixed: tuple[int, ...] = ()  # values that come before the one searched
    cut: tuple[int, ...] | None = None

    @property
    def shift(self) -> int:
        s = 0
        while (self.hi >> s) - (self.lo >> s) >= BINS:
            s += 1
        return s

    def ends(self, *last: int) -> None:
        """Rows up to this place go to the left."""
        place = (*self.fixed, *last)
        self.cut = place + (LAST,) * (1 + len(TIES) - len(place))


def keyed(docs: DataFrame, dimensions: dict | None = None) -> DataFrame:
    """The documents with ``size``, ``text_crc32``, their dimensions and ties."""
    dims = dimensions or DIMENSIONS
    body = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return (docs.withColumns({"size": (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long"),
                              "text_crc32": F.crc32(body),
                              "_tie": F.shiftrightunsigned(F.xxhash64("text"), 1),
                              "_id": F.coalesce("doc_id", F.lit(FIRST)),
                              "_row": F.monotonically_increasing_id()})
            .withColumn("_dims", F.array(*[f() for f in dims.values()])))


def _place(dim: str = "_dim") -> Column:
    return F.struct(F.element_at("_dims", F.col(dim) + 1).alias("v"), *TIES)


def _root() -> Column:
    """Node 1, as a value of the row: joins by a constant would lose their key."""
    return F.when(F.col("size") > 0, F.lit(1)).otherwise(F.lit(0)).cast("long")


class KdTree:
    """The cuts of a table; ``assign`` adds the shard of each row."""

    def __init__(self, table: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None,
                 tolerance: float = TOLERANCE):
        """``table``: written ``keyed`` rows.  ``target_bytes`` gives the number of shards where that is None."""
        self.spark = table.sparkSession
        self.levels: list[list[tuple]] = []  # (node, dim, place...) of each level
        self.shard_of = {1: 0}
        n_dims = table.select(F.max(F.size("_dims"))).head()[0] or 0
        dims = [F.element_at("_dims", i + 1) for i in range(n_dims)]
        extents = [f(c) for c in (*dims, *map(F.col, TIES)) for f in (F.min, F.max)]
        stats = [F.count(F.lit(1)), F.sum("size"), *extents]
        whole = table.agg(*[c.alias(f"s{i}") for i, c in enumerate(stats)]).head()
        if not whole[0]:
            return
        self.total = whole[1]
        k = shards or max(1, math.ceil(self.total / target_bytes))
        slack = int(self.total / k * tolerance)
        extent = lambda row, i: (row[2 + 2 * i], row[3 + 2 * i])
        ties = [extent(whole, n_dims + i) for i in range(len(TIES))]
        span = [max(extent(whole, i)[1] - extent(whole, i)[0], 1) for i in range(n_dims)]
        nodes, rows = {1: (0, k)}, {1: whole}  # node: its first shard, how many
        level = table.withColumn("node", _root())
        while any(n > 1 for _, n in nodes.values()):
            found = {}
            for node, (_, n) in nodes.items():
                if n > 1 and node in rows:
                    own = [extent(rows[node], i) for i in range(n_dims)]
                    dim = max(range(n_dims), key=lambda i: ((own[i][1] - own[i][0]) / span[i], -i))
                    found[node] = Search(dim, rows[node][1] * (n // 2) // n, *own[dim])
            self._search(level, found, ties, slack)
            self.levels.append([(node, s.dim, *s.cut) for node, s in found.items()])
            new = {}
            for node, (first, n) in nodes.items():
                if node in found:
                    new |= {2 * node: (first, n // 2), 2 * node + 1: (first + n // 2, n - n // 2)}
                elif n == 1:
                    new[node] = first, n
            nodes, level = new, self._down(level, self.levels[-1])
            if len(self.levels) % WRITTEN_LEVELS == 0:
                level = written(level, "kd-level")
            open_nodes = [x for x, (_, n) in nodes.items() if n > 1]
            rows = {r[0]: r[1:] for r in level.join(F.broadcast(self._nodes(open_nodes)), "node").groupBy("node").agg(
                *[c.alias(f"s{i}") for i, c in enumerate(stats)]).collect()} if open_nodes else {}
        self.shard_of = {node: first for node, (first, _) in nodes.items()}

    def _nodes(self, nodes: list[int]) -> DataFrame:
        return self.spark.createDataFrame([(x,) for x in nodes], "node long")

    def _down(self, rows: DataFrame, cuts: list[tuple]) -> DataFrame:
        """Each row one level down; a row for each cut is broadcast, as many as there are nodes."""
        if not cuts:
            return rows
        names = ["_v", *(f"_c{t}" for t in TIES)]
        ddl = "node long, _dim int, " + ", ".join(f"{c} long" for c in names)
        to = F.struct(F.col("_v").alias("v"), *[F.col(f"_c{t}").alias(t) for t in TIES])
        down = F.when(F.col("_dim").isNull(), F.col("node")).when(_place() <= to, 2 * F.col("node")).otherwise(2 * F.col("node") + 1)
        return (rows.join(F.broadcast(self.spark.createDataFrame(cuts, ddl)), "node", "left")
                .withColumn("node", down).drop("_dim", *names))

    def _search(self, level: DataFrame, found: dict[int, Search], ties: list[tuple], slack: int) -> None:
        """Weighted medians of the nodes, in rounds of ``BINS`` sums each."""
        while left := {n: s for n, s in found.items() if s.cut is None}:
            asked = [(n, s.dim, len(s.fixed), s.shift, s.lo, s.hi, *s.fixed, *[None] * (len(TIES) - len(s.fixed)))
                     for n, s in left.items()]
            names = [f"_f{i}" for i in range(len(TIES))]
            ask = self.spark.createDataFrame(asked, "node long, _dim int, _n int, _shift int, _lo long, _hi long, "
                                             + ", ".join(f"{c} long" for c in names))
            keys = F.array(F.element_at("_dims", F.col("_dim") + 1), *TIES)
            rows = level.join(F.broadcast(ask), "node").withColumn("_keys", keys)
            for i, c in enumerate(names):
                rows = rows.where(F.col(c).isNull() | (F.element_at("_keys", i + 1) == F.col(c)))
            rows = rows.withColumn("_k", F.element_at("_keys", F.col("_n") + 1)).where("_k BETWEEN _lo AND _hi")
            sums = rows.groupBy("node", F.expr("shiftright(_k, _shift)").alias("bin")).agg(
                F.sum("size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("_k").alias("lo"), F.max("_k").alias("hi"))
            by: dict[int, list] = {}
            for r in sums.collect():  # at most BINS a node
                by.setdefault(r["node"], []).append(r)
            for node, s in left.items():
                for r in sorted(by[node], key=lambda r: r["bin"]):
                    if s.before + r["size"] >= s.wanted:
                        break
                    s.before += r["size"]
                if r["n"] == 1 or r["size"] <= slack or len(s.fixed) == len(TIES) and r["lo"] == r["hi"]:
                    # the nearer end of the range
                    s.ends(r["hi"] if 2 * (s.wanted - s.before) >= r["size"] else r["lo"] - 1)
                elif r["lo"] == r["hi"]:  # one value: rows are told apart by the next
                    s.fixed += (r["lo"],)
                    s.lo, s.hi = ties[len(s.fixed) - 1]
                else:
                    s.lo, s.hi = r["lo"], r["hi"]

    def assign(self, rows: DataFrame) -> DataFrame:
        """``keyed`` rows with their ``shard``."""
        out = rows.withColumn("node", _root())
        for cuts in self.levels:
            out = self._down(out, cuts)
        shards = self.spark.createDataFrame([(n, s) for n, s in self.shard_of.items()], "node long, shard int")
        return out.join(F.broadcast(shards), "node").drop("node")


def kd_shards(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None,
              tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (by id, gapless in each shard),
    grown_shard (NULL: the shards follow the bytes)."""
    d = only(docs, doc_id=("doc_id", "long"), text=("text", "string"), source=("source", "string"), lang=("lang", "string"))
    table = written(keyed(d).select("doc_id", "size", "text_crc32", "_dims", *TIES), "kd-metadata")
    placed = KdTree(table, shards, target_bytes, tolerance).assign(table).select(
        "doc_id", "size", "text_crc32", "shard", "_id", "_row")
    # numbered over the sorted table: no shard stands in one task
    numbered, _ = frame_index(placed, ["shard", "_id", "_row"], name="_at")
    starts = numbered.groupBy("shard").agg(F.min("_at").alias("_start"))
    return numbered.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_at") - F.col("_start")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, path: str, shards: int | None = SHARDS, target_bytes: int | None = None,
                 files: int = 8) -> None:
    """The documents, whole, as a table at ``path`` partitioned by ``shard`` (in place of a column of that
    name), of up to ``files`` files a shard."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != "shard"]).alias("_doc"))
    have = {c.lower() for c in docs.columns}
    kinds = {"doc_id": "long", "text": "string", "source": "string", "lang": "string"}
    full = keyed(whole.select("_doc", *[(F.col(f"_doc.{c}") if c in have else F.lit(None)).cast(kind).alias(c)
                                        for c, kind in kinds.items()]))
    table = written(full.select("size", "_dims", *TIES), "kd-metadata")
    tree = KdTree(table, shards, target_bytes)
    placed = tree.assign(full).withColumn("_file", F.pmod(F.xxhash64("_tie", "_id"), F.lit(files)))
    (placed.repartition(files * len(tree.shard_of), "shard", "_file")
     .select("_doc.*", "shard").write.partitionBy("shard").parquet(path))


def shard_sizes(assigned: DataFrame) -> DataFrame:
    """shard, n_docs, n_bytes of ``kd_shards`` rows."""
    return assigned.groupBy("shard").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("n_bytes"))
