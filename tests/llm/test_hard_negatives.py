"""Hard negatives against all scores."""
import math
import random

import numpy as np
from pyspark.sql import functions as F

from meterflow.llm import hard_negatives as hn


def brute(rows, step, k, m, low):
    ok = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = tuple(math.floor(256 * x) for x in v)
        if sum((abs(256 * x) + 1) * (abs(256 * x) + 1) for x in v) < 2.0**62:
            ok[i, label, q] = None
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    anchors = {}
    for i, label, q in ok:
        if i % step == 0:
            anchors[i] = min(anchors.get(i, (label, q)), (label, q))
    out = []
    for a, (label, q) in anchors.items():
        scored = sorted((-dot(q, p), i, lab) for i, lab, p in ok if i != a)
        near = [(-s, i) for s, i, lab in scored if lab == label][:k]
        for ps, p in near:
            fit = [(-s, i) for s, i, lab in scored if lab != label and 80 * ps <= 100 * -s <= 100 * ps]
            out += [(a, p, r + 1, n, ps, s) for r, (s, n) in enumerate(fit[:m])]
    return sorted(out)


def check(spark, rows, step=10):
    df = spark.createDataFrame([(*r, 1, "q") for r in rows], "vec_id long, embedding array<double>, label int, id int, v string").repartition(3)
    got = hn.hard_negatives(df, F.col("vec_id") % step == 0)
    want = brute(rows, step, 5, 5, 80)
    assert sorted(map(tuple, got.collect())) == want
    return want


def test_clusters_and_noise(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK", 64)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(6, 16))
    v = centre[rng.integers(0, 6, 600)] + 0.2 * rng.normal(size=(600, 16))
    v /= np.linalg.norm(v, axis=1)[:, None]
    rows = [(i, x.tolist(), int(rng.integers(0, 4))) for i, x in enumerate(v)]
    assert len(check(spark, rows)) > 200
    coarse = [(i, [round(2 * x) / 256 for x in e], lab) for i, e, lab in rows]  # ties everywhere
    assert len(check(spark, coarse)) > 100


def test_edges(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 0.503]) for _ in range(4)], rng.randrange(3)) for i in range(60)]
    rows += [(60, None, 1), (70, [1.0, None, 0.0, 0.0], 1), (80, [1.0, math.nan, 0.0, 0.0], 1), (90, [math.inf, 0.0, 0.0, 0.0], 1), (100, [1.0] * 4, None),
             (None, [1.0] * 4, 1), (110, [], 1), (120, [0.0] * 4, 2), (130, [0.5] * 6, 0), (131, [1e300] * 4, 0), (140, [2.0**21] * 4, 1), (141, [2.0**21 - 3] * 4, 0),
             (142, [2.0**21 - 1] * 4, 1), (-10, [-0.5] * 4, 2)]
    rows += rows[:30] + [(20, [1.0] * 4, 2), (11, [1.0, 1.0, 0.0, 0.0], 1)]
    assert any(s > 2**53 for *_, s in check(spark, rows))
    check(spark, [(1, [1.0], 0)])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hn.hard_negatives(empty, F.col("vec_id") % 10 == 0).count() == 0


def test_reading_stops_early():
    rng = np.random.default_rng(1)
    x = np.floor(rng.exponential(size=(2048, 3)) * 1000).astype(np.int64)
    block, a = hn.Block(np.arange(2048), np.zeros(2048, np.int64), x, 3), np.array([5, -2, 3])
    best = hn.Best(5, -(1 << 63), (1 << 63) - 1)
    read = block.search(a, block.thresholds(a[None])[0], np.ones(2048, bool), [best])
    assert read < 1024 and [i for _, i in best.rows] == np.lexsort((np.arange(2048), -(x @ a)))[:5].tolist()
