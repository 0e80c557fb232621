"""Peer ranks."""

from panelgrowth.operators.ranks import with_peer_ranks


def test_first_and_average_ties(spark):
    vals = {"a": 3.0, "b": 1.0, "c": 3.0, "d": None, "e": 2.0, "f": 3.0}
    rows = [(k, "ss", "ind", "2001", "01", v) for k, v in vals.items()]
    df = spark.createDataFrame(rows, "area_name string, supersector_name string, industry_name string,"
                                     " year string, Month string, f double")
    out = with_peer_ranks(df, "area_name", {"r1": ("f", "first"), "ra": ("f", "average")})
    got = {r["area_name"]: (r["r1"], r["ra"]) for r in out.collect()}
    assert [got[k][0] for k in "abcdef"] == [1.0, 5.0, 2.0, None, 4.0, 3.0]
    assert [got[k][1] for k in "abcdef"] == [2.0, 5.0, 2.0, None, 4.0, 2.0]


def test_ranks_are_per_peer_group(spark):
    rows = [("a", "ss", "ind", "2001", "01", 1.0), ("b", "ss", "ind", "2001", "01", 2.0),
            ("a", "ss", "ind", "2001", "02", 5.0), ("b", "ss2", "ind", "2001", "02", 1.0)]
    df = spark.createDataFrame(rows, "area_name string, supersector_name string, industry_name string,"
                                     " year string, Month string, f double")
    out = with_peer_ranks(df, "area_name", {"r": ("f", "first")})
    got = sorted((r["area_name"], r["Month"], r["supersector_name"], r["r"]) for r in out.collect())
    assert got == [("a", "01", "ss", 2.0), ("a", "02", "ss", 1.0), ("b", "01", "ss", 1.0), ("b", "02", "ss2", 1.0)]


def test_sorted_ranks_equal_window_ranks(spark):
    import random
    rnd = random.Random(11)
    rows = [(f"e{i:03d}", rnd.choice(["s1", "s2"]), "ind", "2001", rnd.choice(["01", "02"]),
             rnd.choice([None, 0.5, 0.25, float(rnd.randint(-5, 5)) / 10]))
            for i in range(400)]
    df = spark.createDataFrame(rows, "area_name string, supersector_name string, industry_name string,"
                                     " year string, Month string, f double")
    from panelgrowth.operators.ranks import peer_ranks
    spec = {"r1": ("f", "first"), "ra": ("f", "average")}
    w = {r["area_name"]: (r["r1"], r["ra"]) for r in peer_ranks(df, "area_name", spec, strategy="window").collect()}
    s = {r["area_name"]: (r["r1"], r["ra"]) for r in peer_ranks(df, "area_name", spec, strategy="sorted").collect()}
    assert w == s
    a = {r["area_name"]: (r["r1"], r["ra"]) for r in peer_ranks(df, "area_name", spec, strategy="auto",
                                                                  max_window_rows=10).collect()}
    assert a == w


def test_five_sorted_ranks_take_one_checkpoint(spark, monkeypatch):
    import random
    from panelgrowth.operators.ranks import peer_ranks
    rnd = random.Random(12)
    pick = lambda: rnd.choice([None, 0.5, 0.25, 0.0, -0.0, rnd.randint(-5, 5) / 10])
    rows = [(f"e{i:03d}", rnd.choice(["s1", None]), "ind", "2001", rnd.choice(["01", "02"]), pick(), pick(), pick(), pick(), float(i))
            for i in range(300)]
    df = spark.createDataFrame(rows, "area_name string, supersector_name string, industry_name string, year string,"
                                     " Month string, f1 double, f2 double, f3 double, f4 double, other double")
    spec = {"a": ("f1", "first"), "b": ("f1", "average"), "c": ("f2", "first"), "d": ("f3", "average"), "e": ("f4", "first")}
    taken, real = [], type(df).checkpoint
    monkeypatch.setattr(type(df), "checkpoint", lambda self, *a, **k: taken.append(1) or real(self, *a, **k))
    got = peer_ranks(df, "area_name", spec, strategy="sorted")
    want = peer_ranks(df, "area_name", spec, strategy="window")
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    assert len(taken) == 1
