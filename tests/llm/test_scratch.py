"""Tables in the shared folder, and the scope that removes them."""
import glob

import pytest

from meterflow.llm import minhash, scratch
from meterflow.session import checkpoint_root


def folders(spark):
    return set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/llm/*"))


def test_a_scope_removes_what_was_made_within(spark):
    kept = scratch.saved(spark.range(3), "kept")
    before = folders(spark)
    docs = spark.createDataFrame([(i, "one two three four five six" if i < 4 else f"a{i} b{i} c{i} d{i}") for i in range(8)], "doc_id long, text string")
    with scratch.removed_after(spark):
        groups = minhash.near_duplicates(docs, k=3, percent=85, bands=25, rows=5)
        assert sorted(r.doc_id for r in groups.filter("kept").collect()) == [0, 4, 5, 6, 7]
        assert folders(spark) > before
        with scratch.removed_after(spark):
            inner = scratch.saved(spark.range(2), "inner")
            assert inner.count() == 2
        with pytest.raises(Exception, match="(?i)not.*exist|FILE_NOT_EXIST"):
            inner.count()
    assert folders(spark) == before and kept.count() == 3


def test_an_error_within_a_scope_removes_too(spark):
    before = folders(spark)
    with pytest.raises(KeyError), scratch.removed_after(spark):
        scratch.saved(spark.range(2), "gone")
        raise KeyError
    assert folders(spark) == before and not scratch._scopes
