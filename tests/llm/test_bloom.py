import numpy as np
import pyarrow as pa

from panelgrowth.llm import bloom


def test_merged_in_groups_of_few_blocks(spark):
    """400 blocks a piece, as of 400 tasks: no group holds many of them."""
    blocks = spark.range(1200).selectExpr("CAST(id % 3 AS int) AS piece", "CAST('1' AS binary) AS bits").repartition(16)

    def add(key, rows):
        assert rows.num_rows <= 3 * bloom.BLOCKS_OF_GROUP
        n = sum(int(x) for x in rows.column("bits").to_pylist())
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([str(n).encode()])})

    got = sorted((r["piece"], int(r["bits"])) for r in bloom.merged(blocks, add, "test-blocks").collect())
    assert got == [(0, 400), (1, 400), (2, 400)]


def test_filter_of_many_tasks(spark):
    keys = spark.range(3000).selectExpr("xxhash64(id) AS key").repartition(70)
    held = bloom.bloom_filter(keys, 1 << 16)
    own = np.array([r["key"] for r in keys.collect()], np.int64).view(np.uint64)
    slots = bloom._slots(own, 1 << 16).ravel()
    want = np.zeros(1 << 16, bool)
    want[slots] = True
    assert bloom.bloom_hits(held, own).all()
    assert (np.unpackbits(held, bitorder="little").astype(bool) == want).all()
