"""Every registered query against its DuckDB oracle (or rows-only) on sf0.001."""
import sys

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from meterflow.plans.queries import QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)  # the training-data queries have their tests in tests/llm


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
        return
    r = compare(df, con, sql)
    assert r["names"], r
    assert not r["types"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["exact"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "vnd_cumulative" in df.columns


def test_entry_works_without_the_training_data_operators(monkeypatch):
    monkeypatch.setitem(sys.modules, "meterflow.llm", None)
    assert set(queries()) == set(QUERIES) and set(oracle_sql()) <= set(QUERIES)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(oracle_sql())
