"""Every registered query of the subpackage on the smallest tables: SQL where there is some, else rows."""
import pytest

from meterflow.llm.queries import ORACLE, QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"


def test_all_operators_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")] == list(range(1, 14)) and "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(QUERIES[name](spark, SF), duck(SF), ORACLE[name])
    assert r["names"] and not r["types"] and r["spark_rows"] == r["oracle_rows"] and r["exact"], r


@pytest.mark.parametrize("name", [n for n in QUERIES if n.startswith("op") and n not in ORACLE])
def test_query_returns_a_row_for_each_row(spark, name):
    table = "embeddings" if name.startswith("op1_") else "documents"
    assert QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
