import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from panelgrowth.llm import kd_shards as K
from panelgrowth.llm.common import only, written


def table_of(docs):
    d = only(docs, doc_id=("doc_id", "long"), text=("text", "string"), source=("source", "string"), lang=("lang", "string"))
    return written(K.keyed(d).select("doc_id", "size", "text_crc32", "_dims", *K.TIES), "t")


def brute(rows, n_shards, tolerance=0.0):
    """Shard of each row: the recursion on sorted lists.  Only for cuts at single rows."""
    n_dims = len(rows[0]["_dims"])
    span = [max(max(r["_dims"][i] for r in rows) - min(r["_dims"][i] for r in rows), 1) for i in range(n_dims)]
    out = {}

    def down(own, first, k):
        if k == 1 or not own:
            out.update({r["_row"]: first for r in own})
            return
        width = [(max(r["_dims"][i] for r in own) - min(r["_dims"][i] for r in own)) / span[i] for i in range(n_dims)]
        d = max(range(n_dims), key=lambda i: (width[i], -i))
        own = sorted(own, key=lambda r: (r["_dims"][d], r["_tie"], r["_id"], r["_row"]))
        wanted = sum(r["size"] for r in own) * (k // 2) // k
        at = 0
        for i, r in enumerate(own):
            if at + r["size"] >= wanted:
                break
            at += r["size"]
        if 2 * (wanted - at) >= r["size"]:
            i += 1
        down(own[:i], first, k // 2)
        down(own[i:], first + k // 2, k - k // 2)

    down(rows, 0, n_shards)
    return out


ROWS = ([(i, f"text {i} " * (i % 17 + 1), "en" if i % 3 else "de", f"s{i % 4}") for i in range(150)]
        + [(1000 + i, "the same text", "en", "s0") for i in range(120)]
        + [(7, "one row again", "en", "s1")] * 40
        + [(None, None, None, None), (3, "", "", ""), (None, "x", None, "s0"), (-(1 << 62), "least", "fr", "s2"), (1 << 62, "most", "fr", "s2")])


@pytest.mark.parametrize("n", [1, 2, 5, 16])
@pytest.mark.parametrize("bins", [4, 4096])
def test_tree_equals_brute_force(docs_of, monkeypatch, n, bins):
    monkeypatch.setattr(K, "BINS", bins)
    t = table_of(docs_of(ROWS))
    got = {r["_row"]: r["shard"] for r in K.KdTree(t, n, tolerance=0).assign(t).collect()}
    assert got == brute([r.asDict() for r in t.collect()], n)


def test_contract(docs_of):
    got = [r.asDict() for r in K.kd_shards(docs_of(ROWS)).collect()]
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in ROWS)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    shards, sizes = defaultdict(list), Counter()
    for r in got:
        assert r["law"] == "bytes" and r["grown_shard"] is None
        shards[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
    assert set(shards) <= set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    mean = sum(sizes.values()) / 16
    assert max(abs(sizes[k] - mean) for k in range(16)) <= max(r["size"] for r in got)


def test_prose_near_equal_and_reruns_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    a = K.kd_shards(docs)
    sizes = [r["n_bytes"] for r in K.shard_sizes(a).collect()]
    assert len(sizes) == 16 and max(sizes) < 1.15 * min(sizes)
    rows = lambda d: sorted((r["doc_id"], r["size"], r["shard"], r["slot"]) for r in d.collect())
    assert rows(a) == rows(K.kd_shards(docs.repartition(7)))


def test_hot_copies_are_cut(docs_of):
    got = K.kd_shards(docs_of([(i, "copy", "en", "s") for i in range(1600)]))
    assert sorted(r["n_docs"] for r in K.shard_sizes(got).collect()) == [100] * 16


def test_target_bytes(docs_of):
    rows = [(i, "x" * (50 + i % 9), "en", f"s{i % 3}") for i in range(400)]
    total = sum(len(t) + 1 for _, t, *_ in rows)
    got = K.shard_sizes(K.kd_shards(docs_of(rows), shards=None, target_bytes=3000)).collect()
    assert len(got) == math.ceil(total / 3000) and max(r["n_bytes"] for r in got) < 3000 + 60


def test_written_levels(docs_of, monkeypatch):
    t = table_of(docs_of(ROWS))
    one = {r["_row"]: r["shard"] for r in K.KdTree(t, 16).assign(t).collect()}
    monkeypatch.setattr(K, "WRITTEN_LEVELS", 1)
    assert {r["_row"]: r["shard"] for r in K.KdTree(t, 16).assign(t).collect()} == one


def test_write_shards(docs_of, tmp_path, spark):
    docs = docs_of(ROWS).withColumn("shard", F.lit("clash"))
    K.write_shards(docs, str(tmp_path / "out"), shards=4, files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert set(back.columns) == set(docs.columns)
    key = lambda d: sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "", r["size"]) for r in d.collect())
    assert key(back) == key(docs) and back.select("shard").distinct().count() == 4


def test_few_rows_and_none(docs_of):
    assert sorted(r["slot"] for r in K.kd_shards(docs_of([(1, "a"), (2, "b")])).collect()) == [0, 0]
    assert K.kd_shards(docs_of([(1, "a")]).where("doc_id < 0")).count() == 0
