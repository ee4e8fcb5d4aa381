"""Near-duplicates against brute force on whole sets."""
import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import minhash, texts

WORD = re.compile("[^\x20\x09-\x0d]+")


def low(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


def shingle_set(text, k):
    w = WORD.findall(low(text or ""))
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or {tuple(w)}


def components(rows, k, percent):
    sets = [(i, shingle_set(t, k)) for i, t in rows]
    at = {i: i for i, _ in rows}

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[n + 1:]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                at[y] = x
    return {i: (len(s), find(i), find(i) == i) for i, s in sets}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="aAbBéİ \n\t\x1c ", max_size=30), max_size=8), st.integers(1, 5))
def test_shingles_equal_sets_of_words(rows, k):
    h, row, n = texts.shingles(pa.array(rows, pa.string()), k)
    names = {}
    for i, t in enumerate(rows):
        got = set(h[row == i].tolist())
        assert len(got) == len(shingle_set(t, k))
        names[i] = got
    for i in range(n):
        for j in range(n):
            assert len(names[i] & names[j]) == len(shingle_set(rows[i], k) & shingle_set(rows[j], k))


def test_sketch_fills_every_coordinate_and_estimates():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 3000).astype(np.uint64)
    sets = [base[:1], base[:2], base[:40], base[:2000], base[200:2200]]
    h = np.concatenate(sets)
    row = np.repeat(np.arange(5), [len(s) for s in sets])
    s = minhash.fill_bins(h, row, 5, 125)
    assert (s != minhash.FULL).all()
    assert abs((s[3] == s[4]).mean() - 1800 / 2200) < 0.12
    assert (minhash.fill_bins(h[:0], row[:0], 2, 10) == minhash.FULL).all()


def near_texts(seed=3):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    out = []
    for g in range(12):
        base = [r.choice(words) for _ in range(r.choice([2, 5, 40, 120]))]
        for _ in range(r.choice([1, 2, 6])):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 2])):
                t[r.randrange(len(t))] = r.choice(words)
            out.append(" ".join(t))
    out += ["", None, "   \n", "One two", "one TWO", "One", "tail " * 400]
    return list(enumerate(out))


def test_components_equal_brute_force(spark):
    rows = near_texts()
    for k, percent, bands, per in ((3, 85, 25, 5), (5, 80, 32, 4)):
        df = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, component_id int")
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept)
               for r in minhash.near_duplicates(df.repartition(5), k, percent, bands, per).collect()}
        assert got == components(rows, k, percent)


def test_hot_groups_and_chains(spark):
    base = [f"v{i}" for i in range(60)]
    chain = [" ".join(base[i:i + 40]) for i in range(12)]
    rows = list(enumerate(["same words here again and again"] * 300 + chain + [" ".join(base + [f"x{i}"]) for i in range(150)]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect()}
    assert got == components(rows, 3, 85)


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "a b c d"), (3, None)], "doc_id long, text string")
    got = sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 2, 1, True), (1, 2, 1, True), (None, 2, None, True), (2, 2, 1, False), (3, 0, 3, True)], key=str)
    assert minhash.near_duplicates(df.limit(0)).collect() == []


def test_dense_groups_around_the_threshold(spark):
    """Copies with a few edits each: alike to some of the others only, so the second comparison decides."""
    r = random.Random(9)
    rows = []
    for g in range(3):
        base = [f"g{g}b{i}" for i in range(90)]
        for _ in range(70):
            t = list(base)
            for _ in range(r.choice([1, 2, 3, 4])):
                t[r.randrange(90)] = f"e{r.randrange(4)}"
            rows.append(" ".join(t))
    r.shuffle(rows)
    rows = list(enumerate(rows))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in minhash.near_duplicates(df).collect()}
    assert got == components(rows, 3, 85) and len({c for _, c, _ in got.values()}) > 6
