import re

import panelgrowth.llm.mix as module
from panelgrowth.llm.mix import mix, mix_plan, sized

GAP = re.compile(r"[\x20\x09-\x0D]+")


def _targets(sizes, weights=(5, 2, 1)):
    """Brute force: share by weight, stop at three times the size, reshare."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        ws = sum(w[s] for s in order if s not in capped)
        new = {s for s in order if s not in capped and left * w[s] / ws > 3 * sizes[s]} if ws else set()
        if not new:
            return {s: 3.0 * sizes[s] if s in capped else left * w[s] / ws for s in order}
        capped |= new


def _rows():
    rows = [(i, "w " * (3 + i * 7 % 40), "en", f"s{i % 7}") for i in range(400)]
    return rows + [(1000, None, None, None), (1001, "", None, "s1"), (1002, "a b", None, None), (1003, " \t\n ", None, "s2"),
                   (1004, "x y z", None, "zz"), (1005, "long " * 500, None, "s3"), (7, "w " * 12, "en", "s0")]


def test_targets_and_taken(docs_of):
    d = docs_of(_rows())
    got = mix_plan(d).collect()
    assert len(got) == len(_rows())
    size = lambda t: len([x for x in GAP.split(t or "") if x])
    sizes = {}
    for _, text, _, source in _rows():
        sizes[source] = sizes.get(source, 0) + size(text)
    want = _targets(sizes)
    name = lambda k: None if k == "1" else k[1:]
    taken = {}
    for r in got:
        assert r["source_size"] == sizes[name(r["src"])]
        assert abs(r["target"] - want[name(r["src"])]) < 1e-9
        assert r["taken"] == r["takes"] * r["size"] <= 3 * r["size"]
        taken[name(r["src"])] = taken.get(name(r["src"]), 0) + r["taken"]
    longest = {}
    for _, text, _, source in _rows():
        longest[source] = max(longest.get(source, 0), size(text))
    for s, t in want.items():
        assert abs(taken[s] - t) <= longest[s]


def test_reruns_agree_and_epochs_come_first(docs_of):
    d = docs_of(_rows())
    a = sorted(tuple(r) for r in mix_plan(d).select("doc_id", "size", "taken").collect())
    b = sorted(tuple(r) for r in mix_plan(d.repartition(3)).select("doc_id", "size", "taken").collect())
    assert a == b
    for r in mix_plan(d).where("size > 0").collect():
        epochs = int(r["target"] // r["source_size"])
        assert r["takes"] in (epochs, epochs + 1)


def test_quality_weight_decides_the_order(docs_of):
    # of two kinds of documents of one size, those nearer the mean word length tend to come first
    rows = [(i, ("abcde " if i % 2 else "abcdefghijklmnopqrstuvwxyzabcde ") * 10, None, "s0") for i in range(600)]
    order = [r["doc_id"] for r in sized(docs_of(rows)).orderBy("key").collect()]
    assert sum(i % 2 for i in order[:300]) > 250


def test_mix_keeps_columns_and_counts(docs_of):
    d = docs_of(_rows())
    m = mix(d)
    assert m.columns == d.columns
    assert m.count() == mix_plan(d).agg({"takes": "sum"}).head()[0]


def test_empty(docs_of):
    d = docs_of([(1, "a", None, "s")]).where("doc_id < 0")
    assert mix_plan(d).count() == 0 and mix(d).count() == 0


def test_a_source_of_small_weights_is_ordered_in_small_runs(docs_of, monkeypatch):
    rows = [(i, "y" * 100 + " " + "z" * (60 + i % 9), "en", "b") for i in range(900)] + [(5000 + i, "a b c", "en", "a") for i in range(300)]
    d, most, real = docs_of(rows), [], module.written

    def note(df, label):
        out = real(df, label)
        if label == "mix-last":
            most.append(out.groupBy("src").count().agg({"count": "max"}).head()[0])
        return out

    monkeypatch.setattr(module, "written", note)
    plan = lambda: sorted(tuple(r) for r in mix_plan(d).select("doc_id", "size", "taken").collect())
    monkeypatch.setattr(module, "BIN_ROWS", 10**6)
    want = plan()
    most.clear()
    monkeypatch.setattr(module, "BIN_ROWS", 16)
    assert plan() == want
    assert most[0] > 300 and 0 < most[-1] <= 32
