import random

import numpy as np

from panelgrowth.llm.quality_classifier import fit_votes, quality_classifier


def prose(seed, n):
    """Prose-like text without repeated passages."""
    rng = random.Random(seed)
    small = "the of and to in is that it for was with as on are".split()
    word = lambda: rng.choice(small) if rng.random() < 0.4 else "".join(rng.choice("abdefilnorst") for _ in range(rng.randint(3, 8)))
    return " ".join(" ".join(word() for _ in range(9)).capitalize() + "." for _ in range(n))


def test_fit_votes_learns_accuracies():
    rng = np.random.default_rng(2)
    truth = rng.random(20_000) < 0.7
    accuracy = [0.9, 0.85, 0.7, 0.6, 0.88]
    counts, kept = {}, {}
    for y in truth:
        vote = "".join("1" if rng.random() < 0.2 else ("2" if (rng.random() < a) == y else "0") for a in accuracy)
        counts[vote] = counts.get(vote, 0) + 1
        kept.setdefault(vote, []).append(y)
    post = fit_votes(counts)
    right = sum(sum(y == (post[v] > 0.5) for y in ys) for v, ys in kept.items()) / len(truth)
    majority = sum(sum(y == (v.count("2") >= v.count("0")) for y in ys) for v, ys in kept.items()) / len(truth)
    assert right >= majority and right > 0.9
    assert fit_votes({}) == {}


def test_held_out_accuracy(spark):
    # trained on weak labels only; the table's labels judge it
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_classifier(d, sample_docs=500).join(labels, "doc_id").collect()
    good, bad = [r["kept"] for r in got if r["quality"] == 1], [r["kept"] for r in got if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.2 * len(bad)


def test_edges(docs_of):
    rows = [(i, prose(i, 12), "en") for i in range(60)] + [(100 + i, "JUNK!! " * 80, "en") for i in range(20)]
    rows += [(200, None, None), (201, "", "en"), (202, " ", "xx"), (None, prose(90, 9), "en"), (3, rows[3][1], "en"), (204, prose(91, 2000), "en")]
    got = [(r["doc_id"], r["score"], r["kept"]) for r in quality_classifier(docs_of(rows)).collect()]
    assert len(got) == len(rows) and all(0 <= s <= 1 for _, s, _ in got)
    by = {}
    for i, s, k in got:
        by.setdefault(i, []).append((s, k))
    assert all(k for i in range(60) for _, k in by[i]) and not any(k for i in range(100, 120) for _, k in by[i])
    assert by[200] == by[201] and len(set(by[3])) == 1


def test_the_sample_holds_texts_that_share_an_id(docs_of, monkeypatch):
    from panelgrowth.llm import quality_classifier as Q
    fitted = []
    real = Q.fit_scorer
    monkeypatch.setattr(Q, "fit_scorer", lambda rows, y: fitted.append(len(rows)) or real(rows, y))
    rows = [(7, prose(i, 12), "en") for i in range(120)] + [(None, prose(200 + i, 12), "en") for i in range(30)] + [(9, "a", "en")] * 50
    first = sorted((r["doc_id"] or 0, r["score"]) for r in Q.quality_classifier(docs_of(rows), sample_docs=100).collect())
    again = sorted((r["doc_id"] or 0, r["score"]) for r in Q.quality_classifier(docs_of(rows[::-1]), sample_docs=100).collect())
    assert fitted == [100, 100] and first == again


def test_empty(docs_of):
    assert quality_classifier(docs_of([(1, "a")]).where("doc_id < 0")).count() == 0
