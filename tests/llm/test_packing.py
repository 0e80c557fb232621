import random
from collections import Counter, defaultdict

import pandas as pd

from panelgrowth.llm.packing import best_fit, pack_block


def _rows():
    rng = random.Random(4)
    rows = [(i, f"d{i} " + "w " * rng.randint(1, 300), "en", None if i % 11 == 0 else f"s{min(i % 9, 3)}") for i in range(500)]
    rows += [(1000 + i, "same text here " * 20, "en", "s0") for i in range(30)]
    rows += [(2000, "long " * 2500, "en", "s1"), (2001, None, "en", "s1"), (2002, " ", None, None), (3, rows[3][1], "en", "s3"),
             (None, "no id", None, None)]
    return rows


def test_rules_hold_and_nothing_is_lost(docs_of):
    rows = _rows()
    got = best_fit(docs_of(rows), capacity=512, source_limit=3, block_rows=200).collect()
    words = Counter()
    for i, t, *_ in rows:
        words[i] += len((t or "").split())
    placed = Counter()
    bins = defaultdict(list)
    for r in got:
        placed[r["doc_id"]] += r["n_words"]
        if r["n_words"]:
            bins[r["bin"]].append(r)
        else:
            assert r["bin"] is None
    assert placed == words and len({r["doc_id"] for r in got if r["n_words"] == 0}) == 2
    source = {i: s for i, _, _, s in rows}
    copies = {i for i, t, *_ in rows if t and t.startswith("same")}
    for own in bins.values():
        own.sort(key=lambda r: r["bin_offset"])
        assert sum(r["n_words"] for r in own) <= 512
        for a, b in zip(own, own[1:]):
            assert a["bin_offset"] + a["n_words"] == b["bin_offset"]
        assert max(Counter(source[r["doc_id"]] for r in own).values()) <= 3
        assert sum(r["doc_id"] in copies for r in own) <= 1
        assert max(Counter(r["doc_id"] for r in own).values()) == 1


def _brute(rows, capacity, limit):
    """Best fit by trying every bin."""
    bins, out = [], []
    order = rows.sort_values(["n_words", "cluster", "doc_id", "piece", "source"],
                             ascending=[False, True, True, True, True], na_position="last", kind="stable")
    for r in order.itertuples():
        fit = [(b["left"], k) for k, b in enumerate(bins) if b["left"] >= r.n_words
               and b["s"][r.source] < limit and r.cluster not in b["c"]]
        k = min(fit)[1] if fit else len(bins)
        if not fit:
            bins.append({"left": capacity, "s": Counter(), "c": set()})
        out.append((r.doc_id, k, capacity - bins[k]["left"]))
        bins[k]["left"] -= r.n_words
        bins[k]["s"][r.source] += 1
        bins[k]["c"].add(r.cluster)
    return out


def test_block_equals_brute_force():
    rng = random.Random(9)
    rows = pd.DataFrame([(i, 0, rng.randint(1, 60), f"s{rng.randint(0, 3)}", f"c{rng.randint(0, 60)}") for i in range(400)],
                        columns=["doc_id", "piece", "n_words", "source", "cluster"])
    # few bits: different sources and clusters share them
    rows["sbit"] = [hash(x) % 2 for x in rows["source"]]
    rows["cbit"] = [hash(x) % 3 for x in rows["cluster"]]
    got = pack_block(rows, 100, 2)
    assert list(zip(got["doc_id"], got["b"], got["bin_offset"])) == _brute(rows, 100, 2)


def test_given_cluster_column(docs_of):
    d = docs_of([(i, f"text {i}") for i in range(6)]).selectExpr("doc_id", "text", "source", "'c' AS cluster", "1 AS size")
    assert best_fit(d, cluster="cluster").select("bin").distinct().count() == 6


def test_empty(docs_of):
    assert best_fit(docs_of([(1, "a")]).where("doc_id < 0")).count() == 0
