import math

import numpy as np

from panelgrowth.llm.embed_dedup import CODE_BITS, MISS, bands_for, encode, near_duplicates, rotation


def brute(rows, t=0.98):
    good = [i for i, (_, e, lab) in enumerate(rows) if lab is not None and e and all(x is not None and np.isfinite(x) for x in e)
            and any(e)]
    scaled = {i: np.array(rows[i][1], float) / np.abs(np.array(rows[i][1], float)).max() for i in good}
    unit = {i: x / np.linalg.norm(x) for i, x in scaled.items()}
    links, par = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i in good:
        for j in good:
            if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= t:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                if a != b:
                    par[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(rows)):
        least[find(i)] = min(least.get(find(i), rows[i][0]), rows[i][0])
    return sorted((r[0], links[i], least[find(i)], r[0] == least[find(i)]) for i, r in enumerate(rows))


def _rows():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((30, 16))
    rows = [(i, (centres[i % 30] + rng.standard_normal(16) * 0.12).tolist(), int(i % 3)) for i in range(500)]
    rows += [(1000 + i, rows[i][1], rows[i][2]) for i in range(20)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [float("nan")] * 16, 1), (2004, [float("inf")] * 16, 0),
             (2005, [None] + [1.0] * 15, 0), (2006, rows[0][1], None), (2007, rows[0][1][:8], 0), (2008, [x * 1e-200 for x in rows[0][1]], 0)]
    return rows


def test_matches_brute_force(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr(
        "*", "1 AS uid", "2 AS band", "'x' AS same")
    want = brute(rows)
    for cell in (2048, 16):  # whole buckets, and cells of pairs of groups
        got = sorted(tuple(r) for r in near_duplicates(df, cell_rows=cell).collect())
        assert got == want


def test_estimates_are_unbiased():
    rng = np.random.default_rng(5)
    v = rng.standard_normal((400, 64))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    code, factor = encode(v)
    turned = v @ rotation(64, 256)
    signs = np.unpackbits(code, axis=1) * 2.0 - 1
    estimate = (turned @ signs.T) / (16.0 * factor)[None, :]
    error = (estimate - v @ v.T)[~np.eye(400, dtype=bool)]
    assert abs(error.mean()) < 0.002 and 0.02 < error.std() < 0.08


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_bands_miss_few_pairs_at_any_size():
    p = math.acos(0.98) / math.pi
    for largest in (2_000, 100_000, 10**7, 10**8):
        bands = bands_for(largest, 0.98)
        width = len(bands[0])
        same = [math.comb(CODE_BITS - d, width) / math.comb(CODE_BITS, width) for d in range(CODE_BITS + 1)]
        assert sum(math.comb(CODE_BITS, d) * p ** d * (1 - p) ** (CODE_BITS - d) * (1 - same[d]) ** len(bands)
                   for d in range(CODE_BITS + 1)) <= MISS * (1 + 1e-9)
