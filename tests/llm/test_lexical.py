import math
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from panelgrowth.llm import lexical as L

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def brute(docs, items, k=10):
    """(item_id, rank, doc_id, score) by scoring every document."""
    tfs = [Counter(TERM.findall((t or "").translate(FOLD))) for _, t in docs]
    lens = [sum(c.values()) for c in tfs]
    n_docs, n_terms = sum(n > 0 for n in lens), sum(lens)
    df = Counter(t for c in tfs for t in c)
    out = []
    for item, text in items:
        terms = set(TERM.findall((text or "").translate(FOLD)))
        found = []
        for (doc, _), c, n in zip(docs, tfs, lens):
            s = 0
            for t in terms & c.keys():
                m = 100 - 90 + (90 * n * n_docs) // n_terms
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (
                    (1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                found.append((-s, doc is None, doc or 0, doc))
        out += [(item, i + 1, f[3], -f[0]) for i, f in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def tables(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS terms", "3 AS uid", "4 AS score")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS uid", "2 AS rank", "3 AS doc_id")
    return d.repartition(3), i


def test_terms():
    texts = ["A-b c_d É日本x 12\x7f3", "", None, "...", "Zz"]
    h, first = L.text_terms(pa.array(texts))
    assert np.diff(first).tolist() == [len(TERM.findall((t or "").translate(FOLD))) for t in texts]
    same = L.text_terms(pa.array(["a", "zz", "É", "é"]))[0]
    assert h[0] == same[0] and h[-1] == same[1] and same[2] != same[3]


DOCS = ([(i, f"word{i % 7} common word{i % 5} extra{i}" + " common" * (i % 4)) for i in range(90)]
        + [(200 + i, "the very same copy of a text") for i in range(40)]
        + [(None, "the very same copy of a text"), (5, "common rare"), (5, "common rare"), (7, None), (8, ""), (9, "!!!"),
           (300, "long " * 5000 + "rare"), (301, "word1 " * 400 + "Common"), (-4, "common"), ((1 << 63) - 2, "copy")])
ITEMS = [(1, "common word3"), (2, "The same COPY"), (3, "rare"), (4, "nothing holds this"), (5, None), (6, ""), (None, "extra7 text"),
         (7, "common common common"), (7, "common"), (8, "word1 word2 word3 word4 extra9 extra10 rare long copy")]


@pytest.mark.parametrize("slice_docs,cells", [(4096, 32_000_000), (16, 32_000_000), (7, 500), (64, 40)])
def test_equals_brute_force(spark, monkeypatch, slice_docs, cells):
    monkeypatch.setattr(L, "CELLS", cells)
    d, i = tables(spark, DOCS, ITEMS)
    assert rows(L.rank_documents(d, i, slice_docs=slice_docs)) == brute(DOCS, ITEMS)


def test_items_in_several_passes_and_indexes(spark, monkeypatch):
    monkeypatch.setattr(L, "ITEMS_OF_PASS", 4)
    monkeypatch.setattr(L, "ITEMS_OF_INDEX", 2)
    d, i = tables(spark, DOCS, ITEMS)
    assert rows(L.rank_documents(d, i, k=3)) == brute(DOCS, ITEMS, 3)


def test_prose_equals_sql_and_skips_blocks(spark):
    at = "/root/testdata/sf0.01"
    docs, items = (spark.read.parquet(f"{at}/{t}.parquet") for t in ("documents", "benchmark"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{at}/{t}.parquet'")
    assert rows(L.rank_documents(docs, items)) == sorted(con.execute(L.ORACLE_SQL).fetchall(), key=str)
    told = L.search_tasks(docs, items, slice_docs=256).groupBy().sum("opened", "blocks").head()
    assert 0 < told[0] < 0.7 * told[1]


def test_sql_equals_brute_force_on_edges(spark):
    con = duckdb.connect()
    for t, own, name in (("documents", DOCS, "doc_id"), ("benchmark", ITEMS, "item_id")):
        con.register("given", pa.table({name: pa.array([r[0] for r in own], pa.int64()), "text": [r[1] for r in own]}))
        con.execute(f"CREATE TABLE {t} AS SELECT * FROM given")
    assert sorted(con.execute(L.ORACLE_SQL).fetchall(), key=str) == brute(DOCS, ITEMS)


def test_summaries_bound_their_documents():
    r = np.random.default_rng(3)
    v = (r.random((300, 40)) < 0.2) * r.integers(1, 1_000_000, (300, 40))
    w = r.integers(0, 20_000, 40)
    index = L.SliceIndex(np.arange(300), v.astype(np.float32), w, 16)
    for c in range(40):
        own = range(index.blocks[c], index.blocks[c + 1])
        docs = [index.doc[index.first[b]:index.ends[b]] for b in own]
        assert sorted(np.concatenate(docs).tolist()) == np.flatnonzero(v[:, c]).tolist()
        for b, d in zip(own, docs):
            assert len(d) <= 16 and (index.summary[b][c:] == v[d].max(0)[c:]).all() and not index.summary[b][:c].any()


def test_copies_share_blocks():
    r = np.random.default_rng(4)
    kinds = r.integers(1, 1000, (3, 30)) * (r.random((3, 30)) < 0.5)
    v = np.repeat(kinds, 64, 0)[r.permutation(192)].astype(np.float32)
    index = L.SliceIndex(np.arange(192), v, np.ones(30), 32)
    pure = [len(np.unique(v[index.doc[a:b]], axis=0)) == 1 for a, b in zip(index.first, index.ends)]
    assert np.mean(pure) == 1


def test_empty(spark):
    d, i = tables(spark, DOCS, ITEMS)
    assert L.rank_documents(d.where("doc_id < -9"), i).count() == 0
    assert L.rank_documents(d, i.where("item_id < -9")).count() == 0
