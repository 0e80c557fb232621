import random

import numpy as np

from panelgrowth.llm import ngram_join
from panelgrowth.llm.ngram_join import one_of_each, postings, shared_postings, similar_components

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(rows, k):
    out = []
    for _, t in rows:
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", (t or "").translate(UPPER)) if x]
        out.append(frozenset([tuple(w[j:j + k]) for j in range(len(w) - k + 1)] or ([tuple(w)] if w else [])))
    return out


def brute(rows, k=4, percent=85):
    sets, par = sets_of(rows, k), list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b]:
                same = len(sets[a] & sets[b])
                tie = rows[a][0] == rows[b][0] and rows[a][0] is not None
                if tie or 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                    par[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def _rows():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    rows, base, passage = [], [text(80) for _ in range(5)], text(60)
    for i in range(120):
        t = list(base[i % 5])
        for _ in range(i % 4):
            t[rng.randrange(len(t))] = f"x{i}"
        rows.append((i, " ".join(t)))
    rows += [(200 + i, " ".join(passage + text(25))) for i in range(40)]
    rows += [(300 + i, " ".join(text(rng.randint(1, 9)))) for i in range(30)]
    rows += [(400, None), (401, ""), (402, " \n "), (403, "One Two"), (404, "one\ttwo"), (405, "ONE TWO"), (0, rows[0][1]),
             (406, " ".join(base[0]).upper()), (None, rows[3][1]), (407, "é é é é é"), (408, "É é é é é"), (409, "a a a a a a a a a a a a"),
             (410, " ".join(text(3000)))]
    return rows


def test_matches_brute_force(docs_of):
    rows = _rows()
    d = docs_of(rows)
    for k, percent in ((4, 85), (5, 80)):
        got = sorted((tuple(r) for r in similar_components(d, k, percent, table=1 << 12).collect()), key=str)
        assert got == brute(rows, k, percent)


def test_one_of_each(docs_of):
    rows = _rows()
    d = docs_of(rows)
    got = one_of_each(d, 5, 80, table=1 << 12)
    assert got.columns == d.columns
    want = {c for i, _, c in brute(rows, 5, 80) if i is not None and i == c}
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want) and ids.count(None) == 1


def test_empty(docs_of):
    d = docs_of([(1, "a")]).where("doc_id < 0")
    assert similar_components(d, table=1 << 12).count() == 0 and one_of_each(d, table=1 << 12).count() == 0


def test_one_of_each_judges_rows_by_their_own_text(docs_of):
    rng = random.Random(4)
    text = lambda: " ".join(f"w{rng.randrange(5000)}" for _ in range(60))
    a, b, c, e = text(), text(), text(), text()
    rows = [(1, a), (2, b), (2, c), (3, c + " more"), (4, a + " more"), (None, e), (None, e + " more"), (None, b), (5, b)]
    kept = lambda **k: sorted(((r["doc_id"], r["text"]) for r in one_of_each(
        docs_of(rows), 5, 80, table=1 << 12, **k).collect()), key=str)
    some = kept(null_ids=True)
    assert [x for x in some if x[0] is not None] == [(1, a), *sorted([(2, b), (2, c)])]
    assert [i for i, _ in some].count(None) == 1  # one of e and its near copy
    assert [i for i, _ in kept()].count(None) == 3


def test_postings_are_shuffled_once_and_lists_are_whole(spark, docs_of, monkeypatch):
    d = docs_of(_rows() * 2).select("doc_id", "text").repartition(3)
    level = np.zeros(1 << 12, np.uint8)
    for hot in (False, True):  # all n-grams hot: dealt by set, none is dropped
        if hot:
            monkeypatch.setattr(ngram_join, "hot_level", lambda level: -1.0)
        posts = postings(d, 4, 85, level)
        live = shared_postings(posts)
        assert live._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
        lists = {}
        for gram, sid, n_pos in posts.collect():
            assert (n_pos < 0) == hot
            lists.setdefault(gram, {})[sid] = ~n_pos if hot else n_pos
        want = sorted((g, s, n) for g, x in lists.items() for s, n in x.items() if hot or len(x) > 1)
        assert sorted(map(tuple, live.collect())) == want and want
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        try:  # a list may end anywhere in a batch
            assert sorted(map(tuple, live.collect())) == want
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_hot_grams_match_brute_force(docs_of, monkeypatch):
    rows = _rows()
    monkeypatch.setattr(ngram_join, "HOT_DOCS", 4)
    monkeypatch.setattr(ngram_join, "HOT_TIMES", 0)
    got = sorted((tuple(r) for r in similar_components(docs_of(rows), table=1 << 12).collect()), key=str)
    assert got == brute(rows)
