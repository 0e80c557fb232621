import hashlib
import random

import numpy as np

from panelgrowth.llm.repeats import IntervalTree, anchors, common_prefix, maximal_repeats, merge_spans, remove_repeats


def brute(rows, size=400):
    raw = [(i, (t or "").encode()) for i, t, *_ in rows]
    count = {}
    for _, b in raw:
        for j in range(len(b) - size + 1):
            count[b[j:j + size]] = count.get(b[j:j + size], 0) + 1
    out = []
    for i, b in raw:
        spans = merge_spans([(j, j + size) for j in range(len(b) - size + 1) if count[b[j:j + size]] > 1])
        kept, at = b"", 0
        for s, e in spans:
            kept, at = kept + b[at:s], e
        kept += b[at:]
        out.append((i, len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _rows():
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 9))) for _ in range(n))
    passage, other = text(150), text(70)
    rows = [(i, text(rng.randint(1, 200))) for i in range(40)]
    rows += [(100 + i, text(20) + passage[i * 3:] + text(15)) for i in range(12)]
    rows += [(200 + i, passage[:600] + text(i) + other) for i in range(12)]
    rows += [(300, passage + text(3) + passage), (301, "ab " * 400), (302, "x" + "ab " * 300 + "y"), (303, rows[7][1]),
             (304, None), (305, ""), (306, "z" * 399), (307, "z" * 400), (308, "q" * 401), (309, text(4000)),
             (7, rows[7][1]), (None, passage), (310, other[:399]), (311, rows[9][1][:420] if len(rows[9][1]) > 420 else "s")]
    return rows


def test_matches_brute_force(docs_of):
    rows = _rows()
    d = docs_of([(i, t) for i, t in rows])
    want = brute(rows)
    for hot in (10**6, 0):  # both ways for a gram's occurrences
        got = sorted((tuple(r) for r in remove_repeats(d, hot=hot, bloom_bits=1 << 16).collect()), key=str)
        assert got == want


def test_small_sizes(docs_of):
    rows = [(i, "".join(random.Random(i).choice("ab") for _ in range(60))) for i in range(20)]
    got = sorted((tuple(r) for r in remove_repeats(docs_of(rows), size=12, gram=4, bloom_bits=1 << 14).collect()), key=str)
    assert got == brute(rows, 12)


def test_anchor_depends_on_the_string_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    pos, key, lo, hi = anchors(data, np.array([0, 5000]), 40, 8)
    covered = np.concatenate([np.arange(p - h, p - l + 1) for p, l, h in zip(pos, lo, hi)])
    assert sorted(covered.tolist()) == list(range(5000 - 40 + 1))  # one anchor for each string


def test_tree_groups_are_all_pairs():
    rng = random.Random(3)
    word = lambda n: bytes(rng.choice(b"ab") for _ in range(n))
    items = list({(word(rng.randint(2, 6)), word(rng.randint(2, 6))) for _ in range(60)})
    need = 6
    tree = IntervalTree([a for a, _ in items], [b for _, b in items], [False] * len(items), need, groups=True)
    best = [(-1, -1)] * len(items)
    for i, (a, b) in enumerate(items):
        for j, (c, d) in enumerate(items):
            left, right = common_prefix(a, c), common_prefix(b, d)
            if i != j and left + right >= need:
                best[i] = max(best[i][0], left), max(best[i][1], right)
    assert list(zip(tree.left, tree.right)) == best
    for left, right, members in tree.groups:
        assert len({items[i][0][:left] for i in members}) == len({items[i][1][:right] for i in members}) == 1


def test_maximal_repeats(docs_of):
    text = lambda s: " ".join(f"{s}{i * 7919 % 1000}" for i in range(60))
    shared = text("p")[:150]
    d = docs_of([(i, text(f"d{i}") + shared + text(f"e{i}")) for i in range(4)])
    got = maximal_repeats(d, size=100, gram=20, bloom_bits=1 << 16).groupBy("repeat", "length").count().collect()
    assert got and all(r["length"] >= 100 for r in got) and max(r["count"] for r in got) == 4


def test_empty(docs_of):
    assert remove_repeats(docs_of([(1, "a")]).where("doc_id < 0"), bloom_bits=1 << 14).count() == 0


def brute_maximal(rows, size):
    """{string: places} of all maximal repeats; a text's edges differ from all others."""
    raw = [(i, t.encode()) for i, t in rows if t]
    out, n = {}, size
    while True:
        at = {}
        for k, (_, b) in enumerate(raw):
            for j in range(len(b) - n + 1):
                at.setdefault(b[j:j + n], []).append((k, j))
        at = {w: v for w, v in at.items() if len(v) > 1}
        if not at:
            return out
        for w, v in at.items():
            left = {raw[k][1][j - 1] if j else (k, "start") for k, j in v}
            right = {raw[k][1][j + n] if j + n < len(raw[k][1]) else (k, "end") for k, j in v}
            if len(left) > 1 and len(right) > 1:
                out[w] = sorted(((raw[k][0], j) for k, j in v), key=str)
        n += 1


def test_maximal_repeats_match_brute_force(docs_of):
    rng = random.Random(17)
    word = lambda n, of="ab": "".join(rng.choice(of) for _ in range(n))
    long, part = word(260, "abcdefgh"), word(60, "abcdefgh")
    rows = [(i, word(60)) for i in range(12)]
    # much longer than an anchor sees, nested in one another, copies, with and without their ids
    rows += [(20, "x" + long + "y"), (21, long), (22, word(9) + long + word(8)), (23, part), (24, "q" + long[:80] + part + long[150:]),
             (25, part + "r" + part), (30, rows[0][1]), (31, rows[0][1]), (0, rows[0][1]), (None, rows[3][1]), (32, "abc" * 20),
             (33, long[5:]), (34, long[5:]), (35, "z" * 30), (36, None), (37, "short"), (38, word(40, "mnop")), (39, None)]
    rows[-1] = (39, rows[-2][1])
    want = brute_maximal(rows, 12)
    text = {i: t.encode() for i, t in rows if t}
    assert max(map(len, want)) == 260
    for hot in (10**6, 0):
        got = {}
        for r in maximal_repeats(docs_of(rows), size=12, gram=4, hot=hot, bloom_bits=1 << 14).collect():
            got.setdefault((r["repeat"], text[r["doc_id"]][r["start"]:r["start"] + r["length"]]
                            if r["doc_id"] is not None else rows[3][1].encode()[r["start"]:r["start"] + r["length"]]),
                           []).append((r["doc_id"], r["start"]))
        assert len({name for name, _ in got}) == len(got) == len({w for _, w in got})
        assert {w: sorted(v, key=str) for (_, w), v in got.items()} == want
