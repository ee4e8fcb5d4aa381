"""Targets against a plain water-filling loop, draws against their definition, the tree against its distribution."""
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from meterflow.llm import mixing

SF = "/root/testdata/sf0.001"


def water_fill(sizes):
    order = sorted([s for s in sizes if s is not None]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(2 * sizes[s] for s in capped)
        target = {s: 2.0 * sizes[s] if s in capped else rest * weight[s] / sum(weight[x] for x in free) for s in order}
        over = {s for s in free if target[s] > 2 * sizes[s]}
        if not over:
            return target
        capped |= over


def check(rows, texts):
    sizes = defaultdict(int)
    for _, s, t in texts:
        sizes[s] += len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    target = water_fill(sizes)
    source = {d: s for d, s, _ in texts}
    taken, largest = Counter(), defaultdict(int)
    for r in rows:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s], rel=1e-9)
        assert r.taken in (0, r.size, 2 * r.size) and len(r.shards) == (r.taken // r.size if r.size else 0)
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(1, largest[s])


def test_draws_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    first = mixing.draws(docs, shards=5, blocks=16).collect()
    check(first, texts)
    again = mixing.draws(docs.repartition(7), shards=5, blocks=16).collect()
    assert sorted(first) == sorted(again)
    mix = mixing.mixed(docs, shards=5, blocks=16)
    assert mix.columns == docs.columns
    assert Counter(r.doc_id for r in mix.collect()) == Counter({r.doc_id: len(r.shards) for r in first if r.shards})


def test_sources_edge_cases(spark):
    texts = [(1, "b", "one two three"), (2, None, "x y"), (3, "a", ""), (4, "a", None), (5, "é", "w " * 50), (6, "", "p q r s"), (7, "b", " \n")]
    df = spark.createDataFrame([(i, s, t, 1.0, 2) for i, s, t in texts], "doc_id long, source string, text string, target double, size int")
    rows = mixing.draws(df, shards=2).collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    assert mixing.draws(df.limit(0)).count() == 0 and mixing.mixed(df.limit(0)).count() == 0
    repeated = df.union(df)
    assert Counter(mixing.draws(repeated, shards=3).groupBy("doc_id").count().collect()) == Counter((i, 2) for i in range(1, 8))


def test_quotas_are_exact_and_balanced(spark):
    n = {1: 4096, 2: 700, 3: 1, 4: 0, 5: 900}
    df = spark.createDataFrame(list(n.items()), "src int, n long")
    rows = mixing.shard_quotas(df, 7, seed=3).collect()
    assert {s: sum(r.n for r in rows if r.src == s) for s in n} == n
    assert all(r.n >= 0 for r in rows)
    per = [sum(r.n for r in rows if r.shard == k) for k in range(7)]
    assert max(per) - min(per) <= 7 and len(per) == 7


def test_hypergeometric_distribution(spark):
    total, good, draws = 60, 21, 25
    sql = mixing.hypergeometric(str(total), str(good), str(draws), "(id + 0.5D) / 4000")
    got = spark.range(4000).selectExpr(f"{sql} as x").groupBy("x").count().collect()
    from math import comb
    for r in got:
        p = comb(good, r.x) * comb(total - good, draws - r.x) / comb(total, draws)
        assert abs(r["count"] / 4000 - p) < 1e-3
    assert abs(sum(r.x * r["count"] for r in got) / 4000 - draws * good / total) < 0.01
    assert np.all([r.x <= min(good, draws) for r in got])


def test_any_column_name_passes(spark):
    names = ["at", "mix", "part", "row", "key", "block", "shards", "_at", "_mix", "_part", "src", "n", "plan_source"]
    rows = [(i, f"s{i % 3}", f"words of {i} " * (i % 5 + 1), *(f"{c}{i}" for c in names)) for i in range(40)]
    df = spark.createDataFrame(rows, ["doc_id", "source", "text", *names])
    got = mixing.mixed(df, shards=3).collect()
    assert len(got) > 20 and all(tuple(r) == rows[r.doc_id] for r in got)
