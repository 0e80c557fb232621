"""A Bloom filter of a fixed size over a column of 64-bit hashes."""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelgrowth.llm import wordhash
from panelgrowth.llm.common import written

#: Bits of the filter (16 MB), bytes of its pieces, probes of a key.
BITS = 1 << 27
PIECE_BYTES = 1 << 18
PROBES = 4
#: Blocks of a piece that one group merges, about.
BLOCKS_OF_GROUP = 32


def _slots(keys: np.ndarray, bits: int) -> np.ndarray:
    shift = np.uint64(64 - bits.bit_length() + 1)
    return np.stack([wordhash.mix64(keys + np.uint64(0x1234567 * (i + 1))) >> shift for i in range(PROBES)]).astype(np.int64)


def bloom_hits(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys (uint64) may be in the filter."""
    slots = _slots(keys, len(held) * 8)
    return ((held[slots >> 3] >> (slots & 7)) & 1).all(0)


def merged(blocks: DataFrame, merge: Callable, label: str) -> DataFrame:
    """One block a piece, of written blocks (piece int, bits binary): ``merge``
    makes a table of one block of a group's table.  As many rounds as keep the
    groups at ``BLOCKS_OF_GROUP`` blocks, whatever the number of tasks."""
    while True:
        n = blocks.groupBy("piece").count().agg(F.max("count")).head()[0] or 0
        groups = -(-n // BLOCKS_OF_GROUP)
        part = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(max(groups, 1))).cast("int")
        out = blocks.withColumn("part", part).groupBy("piece", "part").applyInArrow(merge, "piece int, bits binary")
        if groups <= 1:
            return out
        blocks = written(out, label)


def bloom_filter(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """Packed bits of the filter of the first column: a fixed size, whatever
    the number of keys.  Its errors only let more keys through."""
    piece = min(PIECE_BYTES, bits // 8)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        held = None
        for batch in batches:
            if held is None:
                held = np.zeros(bits // 8, np.uint8)
            slots = _slots(batch.column(0).to_numpy().view(np.uint64), bits).ravel()
            np.bitwise_or.at(held, slots >> 3, (1 << (slots & 7)).astype(np.uint8))
        if held is not None:
            z = zstandard.ZstdCompressor(level=1)
            for k in range(0, len(held), piece):
                part = held[k:k + piece]
                if part.any():
                    yield pa.record_batch([pa.array([k // piece], pa.int32()),
                                           pa.array([z.compress(part.tobytes())])], names=["piece", "bits"])

    def join(key, rows):
        import zstandard
        z, out = zstandard.ZstdDecompressor(), None
        for raw in rows.column("bits").to_pylist():
            own = np.frombuffer(z.decompress(raw), np.uint8)
            out = own if out is None else out | own
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()),
                         "bits": pa.array([zstandard.ZstdCompressor(level=1).compress(out.tobytes())])})

    import zstandard
    z = zstandard.ZstdDecompressor()
    out = np.zeros(bits // 8, np.uint8)
    blocks = written(keys.mapInArrow(fill, "piece int, bits binary"), "bloom-blocks")
    for k, raw in merged(blocks, join, "bloom-merged").collect():
        out[k * piece:(k + 1) * piece] = np.frombuffer(z.decompress(raw), np.uint8)
    return out
