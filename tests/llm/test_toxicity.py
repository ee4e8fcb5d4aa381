"""Exact neighbours against all cosines; held-out labels."""
import gc
import pickle
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest

from meterflow.llm import toxicity as tox

SF = "/root/testdata/sf0.01"


def test_block_max_search_is_exact():
    rng = np.random.default_rng(8)
    m = rng.random((400, 60)) * (rng.random((400, 60)) < 0.08)
    m = m[m.any(axis=1)]
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    m = np.concatenate([m, m[:30]])  # ties
    index = tox.BlockMaxIndex.build(m)
    for q in [m[5], m[7], *np.eye(60)[:5], *(rng.random((20, 60)) * (rng.random((20, 60)) < 0.1))]:
        at = np.flatnonzero(q)
        cos = m @ q
        want = [i for i in np.lexsort((np.arange(len(m)), -np.round(cos, 12))) if cos[i] > 0][:15]
        ids, got = index.nearest(at, q[at], 15)
        assert ids.tolist() == want and np.allclose(got, cos[want])


def test_search_of_few_and_of_many_blocks_is_exact(monkeypatch):
    monkeypatch.setattr(tox, "BLOCK", 8)
    rng = np.random.default_rng(18)
    m = np.zeros((640, 700))
    for i in range(640):  # 40 topics of 16 examples with words of their own, and words of all
        m[i, 10 + 17 * (i // 16) + rng.choice(17, 6, False)] = 1 + rng.random(6)
        m[i, rng.choice(10, 3, False)] = rng.choice([0.1, 2.0]) * rng.random(3)
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    index = tox.BlockMaxIndex.build(m)
    assert 0 < (index.common >= 0).sum() <= 10
    for i in range(0, 640, 9):
        cos = m @ m[i]
        for skip in (-1, i):
            want = [j for j in np.lexsort((np.arange(640), -np.round(cos, 12))) if cos[j] > 0 and j != skip][:15]
            at = np.flatnonzero(m[i])
            ids, got = index.nearest(at, m[i][at], 15, skip=skip)
            assert ids.tolist() == want and np.allclose(got, cos[want], rtol=1e-12)


def test_counts_equal_a_count_by_words(monkeypatch):
    texts = [None, "", "ABCdefg abcdef ABCD abcde", "İstanbul ΑΣ ΑΣΑΣ Σ² x_y a1b don't", "日本語 ﬁn straße STRASSE", "1234 !!", "q" * 90, "nasty " * 40 + "words", "\n\nend"]
    words = {f for t in texts[:-2] for w in tox.words_of(t) for f in tox.forms(w)}
    terms = {w: i for i, w in enumerate(sorted(words | {"nast-", "words", "absent"}))}
    want = []
    for t in texts:
        want.append({})
        for w, n in tox.words_of(t).items():
            for f in tox.forms(w):
                if f in terms:
                    want[-1][terms[f]] = want[-1].get(terms[f], 0) + n
    count = tox.TermCounter(terms)
    for piece in (1, 7, 50, 1 << 20):
        monkeypatch.setattr(tox, "PIECE", piece)
        assert [dict(zip(at.tolist(), n.tolist(), strict=True)) for at, n in count.arrays(texts)] == want
        assert all(at.tolist() == sorted(at.tolist()) for at, _ in count.arrays(texts))
    assert [len(at) for at, _ in tox.TermCounter({}).arrays(["some words", None])] == [0, 0]


def test_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = tox.fit(docs, labels)
    rows = tox.scores(docs, model).collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([p for y, p in held if y == 1]) >= 0.75  # few of the examples are not English here
    assert np.mean([p for y, p in held if y == 0]) <= 0.01
    assert all(e.cosine > 0 and truth[e.doc_id] == 1 for r in rows for e in r.evidence)


def test_edges(spark):
    docs = [(i, "awful nasty words" if i % 2 else "kind gentle words") for i in range(60)] + [(100, None), (101, ""), (None, "awful"), (102, "awful " * 50000), (3, "awful nasty words")]
    df = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 1), (None, 1), (7, None)], "doc_id long, toxic int")
    rows = tox.scores(df, tox.fit(df, labels)).collect()
    assert len(rows) == len(docs)
    for (i, t), r in zip(docs, rows, strict=True):
        assert r.doc_id == i and r.predicted == int("awful" in (t or ""))
    assert tox.scores(df.limit(0), tox.fit(df.limit(0), labels)).count() == 0
    assert tox.scores(df, tox.fit(df, labels.limit(0))).filter("predicted = 1").count() == 0


def test_all_words_of_the_examples_count(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.read.parquet(f"{SF}/documents.parquet")
    model = tox.fit(df, spark.read.parquet(f"{SF}/labels.parquet"))
    count = tox.TermCounter(model.terms)
    texts = dict(docs)
    for i in model.doc_ids[::20].tolist():
        assert {f for w in tox.words_of(texts[i]) for f in tox.forms(w)} <= model.terms.keys()
    rows = [model.vector(count(texts[i])) for i in model.doc_ids.tolist()]
    held = {}
    for _, t in docs:
        for i in count(t):
            held[i] = held.get(i, 0) + 1
    association = model.weight / (np.log((1 + len(docs)) / (1 + np.array([held[i] for i in range(len(model.terms))]))) + 1)
    assert association.min() >= min(tox.FLOORS) - 1e-9 and association.max() <= 1 + max(tox.FLOORS) + 1e-9
    without = 0
    for _, t in docs[:300]:
        at, x = model.vector(count(t))
        without += not len(at)
        query = np.zeros(len(model.terms))
        query[at] = x
        cos = np.array([query[a] @ w for a, w in rows])
        ids, got = model.index.nearest(at, x, 15)
        want = [i for i in np.lexsort((np.arange(len(cos)), -np.round(cos, 12))) if cos[i] > 0][:15]
        assert ids.tolist() == want and np.allclose(got, cos[want])
    assert without <= 3


def test_a_rare_toxic_word_finds_its_example(spark):
    docs = [(i, ("awful nasty " if i % 2 else "kind gentle ") + f"common words w{'abcdefghij'[i % 10]}") for i in range(60)] + [(63, "zorgle blib"), (62, "zorgle unseen")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(63, 1)], "doc_id long, toxic int")
    row = next(r for r in tox.scores(df, tox.fit(df, labels)).collect() if r.doc_id == 62)
    assert [e.doc_id for e in row.evidence] == [63]


def test_a_pickled_index_has_no_full_rows_and_finds_the_same():
    rng = np.random.default_rng(5)
    m = np.zeros((2000, 500))
    for r in m:  # each of the terms is common
        r[rng.choice(500, 50, False)] = 0.1 + rng.random(50)
    m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
    index = tox.BlockMaxIndex.build(m)
    want = [index.nearest(np.flatnonzero(r), r[r > 0], 15) for r in m[:20]]
    assert index.single.shape == (500, 2000)
    stored = pickle.dumps(index)
    assert len(stored) < 2 << 20  # 12 MB of full rows, 1.6 MB of weights
    back = pickle.loads(stored)
    for r, (ids, cos) in zip(m, want, strict=False):
        got = back.nearest(np.flatnonzero(r), r[r > 0], 15)
        assert got[0].tolist() == ids.tolist() and got[1].tolist() == cos.tolist()


def test_fit_holds_one_index_at_a_time(spark, monkeypatch):
    of, made, alive = tox.BlockMaxIndex.of, [], []

    def counted(rows, terms):
        gc.collect()
        alive.append(sum(x() is not None for x in made))
        made.append(weakref.ref(index := of(rows, terms)))
        return index

    monkeypatch.setattr(tox.BlockMaxIndex, "of", staticmethod(counted))
    docs = spark.createDataFrame([(i, f"{'awful nasty' if i % 2 else 'kind gentle'} words w{'abcdefghij'[i % 10]}") for i in range(60)], "doc_id long, text string")
    model = tox.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int"))
    assert len(alive) >= len(tox.FLOORS) and not any(alive)
    assert not {"full", "single"} & vars(model.index).keys()
    assert isinstance(model.terms, tox.Terms) and {"awful", "awfu-", "nasty", "wa"} <= model.terms.keys()


def test_terms_are_a_mapping():
    names = sorted(["a", "awfu-", "awful", "zé", "日本", "𝒳"])
    terms = tox.Terms(pa.array(names))
    assert dict(terms) == dict(terms.items()) == {w: i for i, w in enumerate(names)}
    assert list(terms.values()) == [terms[w] for w in names] and len(terms) == 6 and "b" not in terms and "𝒴" not in terms
    with pytest.raises(KeyError):
        terms["b"]
    assert pickle.loads(pickle.dumps(terms)) == terms and not len(tox.Terms(pa.array([], pa.string())))
