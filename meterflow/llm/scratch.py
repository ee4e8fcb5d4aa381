"""Intermediate tables in the folder that the whole cluster shares.

A step that later steps read more than once is written there and read again:
the lineage ends, a lost executor loses nothing, and the file sizes tell the
planner how large the table is (which decides broadcast joins).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from meterflow.session import checkpoint_root


BATCH_ROWS = 1000
_scopes: list[list[str]] = []


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``; its session hands Python at most ``BATCH_ROWS`` rows at once from now on.

    Arrow batches are bounded by rows only (10,000 by default), and rows here are
    whole documents, so a batch of long ones would not fit a worker.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return df


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, known to the scopes of ``removed_after``."""
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    for made in _scopes:
        made.append(path)
    return path


@contextmanager
def removed_after(spark: SparkSession) -> Iterator[None]:
    """Deletes what operators called within have put into the shared folder, at the end of the ``with`` block.

    Results read these tables, so write or collect them within the block.
    Without a scope the tables stay. Scopes may be nested; they are the
    driver's and see the calls of all its threads.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes[:] = [s for s in _scopes if s is not made]
        for name in made:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new shared folder as Parquet and read back."""
    spark = bounded_batches(df).sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns, so that extra columns can't clash with computed ones."""
    return df.select(*names)
