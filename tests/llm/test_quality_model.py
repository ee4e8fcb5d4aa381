"""The label model against planted labellers, the scorer against held-out quality labels."""
import numpy as np
import pyarrow as pa

from meterflow.llm import quality_model as q

SF = "/root/testdata/sf0.01"


def test_em_recovers_planted_labellers():
    rng = np.random.default_rng(2)
    good = rng.random(20000) < 0.85
    m = len(q.LABELLERS)
    says = np.array([s for s, _ in q.LABELLERS.values()])
    own, other = rng.uniform(0.3, 0.9, m), rng.uniform(0.0, 0.05, m)
    rate = np.where((says == 1) == good[:, None], own, other)
    vote = np.where(rng.random(rate.shape) < rate, says, q.ABSTAIN)
    codes, n = np.unique(q.pattern(vote), return_counts=True)
    model = q.fit_label_model(codes, n)
    assert abs(model.prior - good.mean()) < 0.02
    assert np.abs(np.where(says == 1, model.votes[1], model.votes[0]) - own).max() < 0.05
    assert ((model.posterior(vote) > 0.5) == good).mean() > 0.97


def test_votes_see_each_kind_of_junk():
    plain = "This is a plain sentence with many different words in it, as people write them. "
    junk = ["OF!! THE!! AND!! WITH!! THING!! HERE!! ", "heat*** of%%% thor$$$ en&&& and### ", "Same Same Same Same Same Same ", "inlyer | rethnd | enwhhe | other | "]
    _, vote = q.votes(pa.array([plain, *(j * 6 for j in junk), "", None]))
    assert (vote[0] != 0).all() and (vote[0] == 1).sum() == 3
    assert ((vote[1:5] == 0).sum(axis=1) >= 2).all()
    assert (vote[5:] == q.ABSTAIN).all()


def test_scores_follow_quality_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    model = q.fit(docs)
    rows = q.score(docs, model).collect()
    assert len(rows) == 1000
    seen = [(labels[r.doc_id], r.kept) for r in rows if r.doc_id in labels]
    assert sum(k for y, k in seen if y == 1) >= 0.99 * sum(y == 1 for y, _ in seen)
    assert sum(not k for y, k in seen if y == 0) >= 0.95 * sum(y == 0 for y, _ in seen)
    kept = q.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if r.kept}


def test_edges(spark):
    rows = [(1, "Some plain words in a row, and more of them."), (2, None), (3, ""), (4, " \n"), (None, "Some plain words."), (5, "word " * 30000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, score int")
    model = q.fit(df)
    got = {r.doc_id: r for r in q.score(df, model).collect()}
    assert len(got) == 6 and not got[2].kept and not got[3].kept and got[4].score == 0.0
    assert q.score(df.limit(0), q.fit(df.limit(0))).count() == 0
    assert q.keep_good(df, model).columns == df.columns
