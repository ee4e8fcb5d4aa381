"""Each stage against brute force on its own input."""
import re
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

tokenizers = pytest.importorskip("tokenizers")

import corpus_pipeline as cp  # noqa: E402
from tests.llm.test_line_spread import brute as spread  # noqa: E402
from tests.llm.test_minhash import components  # noqa: E402
from tests.llm.test_mixing import water_fill  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(cp.saved(stage(spark, out[-1], SF), f"test-{name}"))
    return out


def test_columns(tables):
    assert all(t.columns == tables[0].columns and t.dtypes == tables[0].dtypes for t in tables[:-1])


def test_quality_keeps_good_labels(spark, tables):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in tables[1].collect()}
    every = {r.doc_id for r in tables[0].collect()}
    good, bad = ({i for i in every if labels.get(i) == y} for y in (1, 0))
    assert len(kept & good) >= 0.98 * len(good) and len(kept & bad) <= 0.1 * len(bad)


def test_lines(tables):
    before = [(r.doc_id, r.source, r.text) for r in tables[1].collect()]
    got = sorted(((r.doc_id, r.text) for r in tables[2].collect()), key=str)
    assert got == sorted(((x[0], x[1]) for x in spread(before, 5)), key=str)
    assert all(r.n_chars == len(r.text) for r in tables[2].collect())


def test_one_of_each_group_stays(tables):
    want = components(sorted((r.doc_id, r.text) for r in tables[2].collect()), 5, 80)
    assert sorted(r.doc_id for r in tables[3].collect()) == sorted(i for i, (_, _, kept) in want.items() if kept)


def test_mix_meets_targets(tables):
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    rows = tables[3].collect()
    sizes, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += size(r.text)
        largest[r.source] = max(largest[r.source], size(r.text))
    taken, copies = Counter(), Counter()
    by_id = {r.doc_id: r for r in rows}
    for r in tables[4].collect():
        assert r == by_id[r.doc_id]
        taken[r.source] += size(r.text)
        copies[r.doc_id] += 1
    assert max(copies.values()) <= 2
    for s, t in water_fill(sizes).items():
        assert abs(taken[s] - t) <= max(1, largest[s])


def test_tokens(tables):
    lib = tokenizers.Tokenizer.from_file(cp.TOKENIZER)
    texts = {r.doc_id: r.text for r in tables[4].collect()}
    rows = tables[5].collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in tables[4].collect())
    for r in rows:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == sha256(texts[r.doc_id].encode()).hexdigest()
