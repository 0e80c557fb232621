"""Embedding near-duplicates by randomised-rotation binary codes.

A vector is normalised, rotated by a fixed random orthogonal matrix into
``CODE_BITS`` dimensions and coded by the signs.  With the code the correction
factor <code vector, rotated vector> is stored.  The inner product of a code
with a rotated vector, divided by the factor, is an unbiased estimate of the
cosine; its error is bounded by ``CONFIDENCE`` standard deviations, which the
factor gives.  A pair whose upper bound is below the threshold is no link; all
others are recomputed exactly in double precision.

Pairs are compared inside buckets: bands of the code's bits per label.  The
number of bits of a band grows with the largest label, the number of bands so
that a pair at the threshold is missed with probability ``MISS`` at most (the bands
are drawn from the same bits, which is reckoned in).
Equal vectors (after normalisation, bit by bit) are one row with a
multiplicity.  A pair that meets in several bands is decided in the first.  A
bucket beyond ``CELL_ROWS`` rows is cut into groups, and each pair of groups is
a cell of its own, so no task holds more than two groups.  A cell returns counts
and one edge per linked vector, not the pairs.

Defined results: a vector that is NULL, empty, zero or has a NULL or non-finite
component, and one with a NULL label, links with nothing (``n_links`` 0, its own
component).  Vectors of different lengths do not link.  Rows that repeat an id
count as one vector per distinct vector and label; a NULL id is kept in the
result, with NULL as component.  An empty table gives an empty result.  Extra
columns are ignored.
"""

from __future__ import annotations

import math
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrowth.llm.common import components, only, written

THRESHOLD = 0.98
CODE_BITS = 256
CONFIDENCE = 5.0
MISS = 1e-5
CELL_ROWS = 2048
SEED = 20

CODED = "uid long, label int, dim int, code binary, factor double, unit binary"


def rotation(dim: int, bits: int, seed: int = SEED) -> np.ndarray:
    """``dim`` orthonormal rows of ``bits`` numbers: a random rotation after
    padding with zeros."""
    q, r = np.linalg.qr(np.random.default_rng(seed + dim).standard_normal((max(bits, dim), dim)))
    return np.ascontiguousarray((q * np.sign(np.diag(r))).T)


def encode(units: np.ndarray, bits: int = CODE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """(packed sign codes, correction factors) of unit vectors, row by row."""
    turned = units @ rotation(units.shape[1], bits)
    d = turned.shape[1]
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / math.sqrt(d)


def miss_probability(n: int, width: int, threshold: float, bits: int = CODE_BITS) -> float:
    """That a pair at the threshold shares none of ``n`` bands of ``width`` of the
    same ``bits`` bits, each of which differs with the pair's angle: summed over
    the number of bits that differ."""
    p = math.acos(min(threshold, 1.0)) / math.pi
    total, same = 0.0, 1.0  # same: that a band has none of the d bits that differ
    for d in range(bits + 1):
        total += math.comb(bits, d) * p ** d * (1 - p) ** (bits - d) * (1 - same) ** n
        same *= max(bits - d - width, 0) / max(bits - d, 1)
    return total


def bands_for(largest: int, threshold: float, bits: int = CODE_BITS, miss: float = MISS) -> list[np.ndarray]:
    """Bit positions of each band: about log2 of the largest label less 7 bits,
    and as many bands as the miss probability asks for."""
    width = int(min(max(round(math.log2(max(largest, 2))) - 7, 4), 24))
    n = 1
    while miss_probability(n, width, threshold, bits) > miss:
        n *= 2
    few = n // 2  # too few, or 0
    while n - few > 1:
        mid = (n + few) // 2
        few, n = (few, mid) if miss_probability(mid, width, threshold, bits) <= miss else (mid, n)
    rng = np.random.default_rng(SEED + 1)
    return [np.sort(rng.permutation(bits)[:width]) for _ in range(n)]


def band_keys(codes: np.ndarray, bands: list[np.ndarray]) -> np.ndarray:
    """(vectors, bands) integers: each band's bits."""
    bits = np.unpackbits(codes, axis=1)
    return np.stack([bits[:, b].astype(np.int64) @ (1 << np.arange(len(b), dtype=np.int64)) for b in bands], axis=1)


def linked(codes: np.ndarray, factors: np.ndarray, units: np.ndarray, keys: np.ndarray, band: int,
           left: np.ndarray, right: np.ndarray | None, threshold: float, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (i, j) of row numbers in left x right (in left, i < j, where
    right is None) that meet first in ``band``."""
    out_i, out_j = [], []
    d = turn.shape[1]
    other = left if right is None else right
    signs = np.unpackbits(codes[other], axis=1).astype(np.float32) * 2 - 1
    error = np.sqrt(np.maximum(1 - factors[other] ** 2, 0) / (factors[other] ** 2 * max(d - 1, 1)))
    for k in range(0, len(left), 256):
        rows = left[k:k + 256]
        turned = (units[rows] @ turn).astype(np.float32)
        estimate = (turned @ signs.T) / (math.sqrt(d) * factors[other])[None, :]
        # beyond the upper confidence bound a pair is no link
        maybe = estimate + CONFIDENCE * error[None, :] + 1e-6 >= threshold
        if right is None:
            maybe &= np.arange(k, k + len(rows))[:, None] < np.arange(len(other))[None, :]
        a, b = np.nonzero(maybe)
        for m in range(0, len(a), 65536):
            i, j = rows[a[m:m + 65536]], other[b[m:m + 65536]]
            first = (keys[i, :band] != keys[j, :band]).all(1) if band else np.ones(len(i), bool)
            i, j = i[first], j[first]
            exact = np.einsum("ij,ij->i", units[i], units[j]) >= threshold
            out_i.append(i[exact])
            out_j.append(j[exact])
    none = np.zeros(0, np.int64)
    return (np.concatenate(out_i) if out_i else none), (np.concatenate(out_j) if out_j else none)


def _cell(uid: np.ndarray, mult: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Per vector of a cell: its links there and the least vector it is linked
    with through the cell's links."""
    n = len(uid)
    links = np.bincount(a, mult[b], n) + np.bincount(b, mult[a], n)
    root = np.arange(n)
    while True:  # least label along links, with pointer jumping
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = np.minimum(new, new[new])
        if (new == root).all():
            break
        root = new
    on = links > 0
    return pa.record_batch([pa.array(uid[on]), pa.array(uid[root[on]]), pa.array(links[on].astype(np.int64))],
                           names=["uid", "to", "links"])


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, bits: int = CODE_BITS,
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row."""
    spark = vectors.sparkSession
    v = only(vectors, vec_id=("vec_id", "long"), embedding=("embedding", "array<double>"), label=("label", "int"))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x))
    fine = (F.col("label").isNotNull() & (F.size("embedding") > 0)
            & F.coalesce(~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))),
                         F.lit(False)))
    v = v.withColumn("scale", F.when(fine, F.array_max(F.transform("embedding", F.abs))))
    # scaled first, so that tiny and huge components neither vanish nor overflow
    v = v.withColumn("embedding", F.when(F.col("scale") > 0, F.transform(
        "embedding", lambda x: x / F.col("scale"))))
    v = v.withColumn("embedding", F.when(F.col("embedding").isNotNull(), F.transform(
        "embedding", lambda x: x / norm)))
    v = written(v.select("vec_id", "label", "embedding", F.when(
        F.col("embedding").isNotNull(), F.sha2(F.concat_ws(",", F.transform(
            "embedding", lambda x: x.cast("string"))), 256)).alias("same")), "embed-units")
    # equal unit vectors of a label: one row, named by the least id
    groups = written(v.where("same IS NOT NULL AND vec_id IS NOT NULL").groupBy("label", "same").agg(
        F.min("vec_id").alias("uid"), F.countDistinct("vec_id").alias("mult"),
        F.min("embedding").alias("embedding")), "embed-groups")
    largest = groups.groupBy("label").count().agg(F.max("count")).head()[0] or 0
    bands = bands_for(largest, threshold, bits)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            dims = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            at = np.concatenate(([0], np.cumsum(dims)))
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                units = flat[(at[rows][:, None] + np.arange(dim)[None, :])]
                codes, factors = encode(units, bits)
                keys = band_keys(codes, bands)
                raw = [u.tobytes() for u in units]
                pick = pa.array(rows)
                # one row per band
                for t in range(len(bands)):
                    yield pa.record_batch([
                        batch.column(0).take(pick), batch.column(1).take(pick), batch.column(2).take(pick),
                        pa.array(np.full(len(rows), dim, np.int32)), pa.array(np.full(len(rows), t, np.int32)),
                        pa.array(keys[:, t]), pa.array([c.tobytes() for c in codes]), pa.array(factors), pa.array(raw)],
                        names=["uid", "label", "mult", "dim", "band", "bucket", "code", "factor", "unit"])

    coded = groups.select("uid", "label", "mult", "embedding").mapInArrow(
        code, "uid long, label int, mult long, dim int, band int, bucket long, code binary, factor double, unit binary")
    where = ["label", "dim", "band", "bucket"]
    # sizes come from the keys alone; buckets of one row compare nothing
    coded = written(coded, "embed-coded")
    sizes = coded.groupBy(*where).count().where("count > 1")
    parts = F.ceil(F.col("count") / cell_rows).cast("int")
    sized = coded.join(sizes, where).withColumn("parts", parts).withColumn(
        "part", F.pmod(F.xxhash64("uid"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    cells = sized.withColumn("other", other).withColumn("lo", F.least("part", "other")).withColumn(
        "hi", F.greatest("part", "other")).select("uid", "mult", "code", "factor", "unit", "part", *where, "lo", "hi")

    def compare(key, table):
        uid, mult, part, factors = (table.column(c).to_numpy() for c in ("uid", "mult", "part", "factor"))
        dim, band, lo, hi = (int(table.column(c)[0].as_py()) for c in ("dim", "band", "lo", "hi"))
        codes = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(len(uid), -1)
        units = np.frombuffer(b"".join(table.column("unit").to_pylist()), np.float64).reshape(len(uid), dim)
        order = np.argsort(uid)
        uid, mult, part, factors, codes, units = (x[order] for x in (uid, mult, part, factors, codes, units))
        left = np.flatnonzero(part == lo)
        right = None if lo == hi else np.flatnonzero(part == hi)
        a, b = linked(codes, factors, units, band_keys(codes, bands), band, left, right, threshold,
                      rotation(dim, bits))
        return pa.Table.from_batches([_cell(uid, mult, a, b)])

    got = written(cells.groupBy(*where, "lo", "hi").applyInArrow(compare, "uid long, to long, links long"), "embed-links")
    links = got.groupBy("uid").agg(F.sum("links").alias("links"))
    comp = components(got.select("uid", "to"), "uid", "to")
    named = (groups.select("label", "same", "uid", "mult").join(links, "uid", "left")
             .join(comp.withColumnRenamed("node", "uid"), "uid", "left")
             .select(F.col("label").alias("_l"), F.col("same").alias("_s"),
                     (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n"),
                     F.coalesce("component", "uid").alias("c")))
    j = v.select("vec_id", "label", "same").join(
        named, (F.col("label") == F.col("_l")) & (F.col("same") == F.col("_s")) & F.col("vec_id").isNotNull(), "left")
    return j.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("c", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))
