"""Links and components against all cosines."""
import math

import numpy as np

from meterflow.llm import cover_tree as ct


def brute(rows, cosine):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    at = {i: i for i, _ in ok}
    links = dict.fromkeys(at, 0)

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for n, (i, a) in enumerate(ok):
        for j, b in ok[n + 1:]:
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                at[y] = x
    return sorted(((i, links.get(i, 0), find(i) if i in at else i, find(i) == i if i in at else True) for i, _ in rows), key=str)


def test_trees_are_covers_and_traversal_is_exact():
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16))
    x = ct.unit(np.concatenate([base[rng.integers(0, 40, 200)] + 0.12 * rng.normal(size=(200, 16)), rng.normal(size=(100, 16))]))
    a, b = ct.CoverTree.build(x[:180]), ct.CoverTree.build(x[180:])
    for t in (a, b):
        assert len(t.centres[-1]) == len(t.x)
        for k, r in enumerate(t.radius[1:-1], 1):
            assert set(t.centres[k - 1]) <= set(t.centres[k]) and r.max() <= math.pi / 2 ** k + math.pi / 2 ** k
    for cosine in (0.5, 0.9, 0.99):
        i, j = ct.dual_traversal(a, b, cosine)
        assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(a.x @ b.x.T >= cosine))))


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ct, "BLOCK", 50)
    monkeypatch.setattr(ct, "GROUP", 2)
    rng = np.random.default_rng(5)
    base = rng.normal(size=(30, 8))
    vs = [*(base[rng.integers(0, 30, 150)] + 0.15 * rng.normal(size=(150, 8))), *[base[0]] * 60, *rng.normal(size=(60, 8))]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vs)]
    rows += [(900, None), (901, [0.0] * 8), (902, [float("nan")] + [1.0] * 7), (903, [float("inf")] * 8), (904, [None] + [1.0] * 7), (905, []),
             (906, [1.0, 2.0]), (907, [2.0, 4.0]), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, n_links int").repartition(4)
    got = sorted(map(tuple, ct.near_duplicates(df, 0.9).collect()), key=str)
    assert got == brute(rows, 0.9)


def test_empty_repeated_and_unusable(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, ct.near_duplicates(df).collect())) == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
    assert ct.near_duplicates(df.limit(0)).collect() == []
    none = spark.createDataFrame([(1, [0.0, 0.0]), (2, None)], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, ct.near_duplicates(none).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]
