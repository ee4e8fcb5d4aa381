"""Held-out accuracy, calibration and defined results for odd texts."""
import zlib

import numpy as np

from meterflow.llm import language_id as li

SF = "/root/testdata/sf0.01"


def test_subwords_are_ngrams_within_words():
    bucket, row = li.subwords(["ab c", "", "Ab  C!"])
    a, b = sorted(bucket[row == 0].tolist()), sorted(bucket[row == 2].tolist())
    assert a == b and len(a) == 9  # _a ab b_ _ab ab_ _ab_ _c c_ _c_
    assert not (row == 1).any()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = li.fit(docs)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = li.predict(docs, model).collect()
    assert len(rows) == len(truth) and set(model.languages) == set(truth.values())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97
    sure = [r for r in held if r.accepted]
    assert len(sure) >= 0.8 * len(held) and np.mean([r.lang_pred == truth[r.doc_id] for r in sure]) >= 0.98
    again = li.predict(docs, li.fit(docs.repartition(3))).collect()
    assert {r.doc_id: round(r.score, 9) for r in again} == {r.doc_id: round(r.score, 9) for r in rows}


def test_edges(spark):
    rows = [(1, "the cat and the dog", "en"), (3, "le chat et le chien", "fr"), (4, "the house and the garden", "en"), (5, "la maison et le jardin", "fr"),
            (6, None, "en"), (7, "", "fr"), (8, "123 !? 😀", "en"), (9, "the dog", None), (None, "le chien", "fr"), (1, "the cat and the dog", "en"), (12, "le " * 30000, "fr")]
    df = spark.createDataFrame([(i, t, g, 0.5) for i, t, g in rows], "doc_id long, text string, lang string, score double")
    got = li.predict(df, li.fit(df)).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, n): r for n, r in enumerate(got)}
    for (i, n), r in by.items():
        assert (r.lang_pred == "und") == (i in (6, 7, 8)) and (i not in (6, 7, 8) or r.score == 0.0)
    assert by[(1, 0)] == by[(1, 9)]
    assert li.predict(df.limit(0), li.fit(df.limit(0))).count() == 0
    unknown = df.withColumn("lang", df.lang.substr(5, 1).cast("string")).selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r.lang_pred for r in li.predict(unknown, li.fit(unknown)).collect()} == {"und"}


def test_what_was_not_learned_is_not_accepted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = li.fit(docs)
    assert 0.05 < model.temperature < 20 and model.threshold < 1
    odd = ["a", "12 x", "q", "日本語の文章はここにあります。読めますか。", "Это предложение на русском языке", "xq zvk wpf jjq kzx vvq pqx zzk", "αβγ δεζ"]
    df = spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")
    for r in li.predict(df, model).collect():
        assert not r.accepted and r.score < 0.99, (odd[r.doc_id], r)
    rows = li.predict(docs, model).filter("held_out").collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    sure = [r for r in rows if r.accepted]
    assert len(sure) > 0.7 * len(rows)
    gap = np.mean([r.score for r in rows]) - np.mean([r.lang_pred == truth[r.doc_id] for r in rows])
    assert abs(gap) < 0.1  # a mean score near the share that is right


def test_rejects_set_the_threshold():
    logits = np.array([[4.0, 0.0]] * 300 + [[0.0, 3.0]] * 300 + [[1.0, 0.0]] * 100)
    label = np.array([0] * 300 + [1] * 300 + [-1] * 100)
    t, shrink, threshold = li.calibrate(logits, np.full(700, 50.0), np.zeros(2), label)
    p = li.softmax(logits * (50 / (50 + shrink)) / t).max(axis=1)
    assert (p[:600] >= threshold).all() and (p[600:] < threshold).all()
