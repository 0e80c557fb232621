import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from panelgrowth.llm.quality_rules import js_distance, passing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    t = text or ""
    w = WORD.findall(t)
    win = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {i + k for i in range(len(w) - 7) if win[tuple(w[i:i + 8])] > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def prose(seed, n):
    """Prose-like text without repeated passages."""
    rng = random.Random(seed)
    small = "the of and to in is that it for was with as on are".split()
    word = lambda: rng.choice(small) if rng.random() < 0.4 else "".join(rng.choice("abdefilnorst") for _ in range(rng.randint(3, 8)))
    return " ".join(" ".join(word() for _ in range(9)).capitalize() + "." for _ in range(n))


def _rows():
    rows = [(i, prose(i, 15), "en") for i in range(30)]
    rows += [(100, None, "en"), (101, "", None), (102, " \n\t ", "xx"), (103, "a b c d e f g h " * 30, "en"),
             (104, "one\ntwo\none\n \none two", "en"), (105, " ".join("SHOUT!!" + str(i) for i in range(200)), "en"),
             (106, " | ".join(f"cell{i}" for i in range(300)), "en"), (107, "#*$%&|<> é ü\U0001F600 \x0bx\x0cy\rz", "de"),
             (108, "q r s t u v w x y q r s t u v w x z " + " ".join(f"n{i}" for i in range(60)), None),
             (0, rows[0][1], "en"), (None, rows[1][1], None)]
    return rows


def test_base_counts(docs_of):
    rows = _rows()
    got = sorted((tuple(r) for r in quality_rules(docs_of(rows)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()), key=str)
    assert got == sorted([(i, *base(t)) for i, t, _ in rows], key=str)


def test_verdict(docs_of):
    got = {r["doc_id"]: r for r in quality_rules(docs_of(_rows())).collect() if r["doc_id"] is not None}
    assert not any(r["kept"] and r["base_failed"] for r in got.values())
    assert all(got[i]["kept"] for i in range(30) if not got[i]["base_failed"])
    assert not got[105]["kept"] and not got[105]["base_failed"] and got[105]["js_chars"] > 0.32
    assert not got[106]["kept"] and got[106]["js_words"] > 0.305


def test_js_distance(spark):
    cases = [([1, 3, 0], [2, 2, 5]), ([5, 0], [0, 7]), ([4, 4], [9, 9])]

    def want(p, q):
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        m = [(a + b) / 2 for a, b in zip(p, q)]
        kl = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m) if a)
        return math.sqrt((kl(p) + kl(q)) / 2)

    df = spark.createDataFrame(cases + [([0, 0], [1, 1]), (None, [1, 2])], "p array<long>, q array<long>")
    got = [r[0] for r in df.select(js_distance(F.col("p"), F.col("q"))).collect()]
    assert all(abs(a - want(*c)) < 1e-9 for a, c in zip(got, cases)) and got[3:] == [None, None]


def test_passing_keeps_rows_and_columns(docs_of):
    d = docs_of(_rows())
    p = passing(d)
    assert p.columns == d.columns
    assert p.count() == quality_rules(d).where("kept").count()


def test_empty(docs_of):
    d = docs_of([(1, "a")]).where("doc_id < 0")
    assert quality_rules(d).count() == 0 and passing(d).count() == 0
