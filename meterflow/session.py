"""Session helpers: building a session for tests/bench and locating the shared
checkpoint folder of the cluster."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "meterflow", extra: dict | None = None) -> SparkSession:
    """A session configured the way the operators expect: UTC, AQE on, UI off.

    On a cluster, ``master`` stays None (spark-submit decides) and the shuffle
    partition count should be sized to the input (~128-256 MB per partition).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a fresh temporary folder serves
    a local master (tests); on a cluster that is an error, as executors would
    not see each other's files.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="meterflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def checkpoint_path(spark: SparkSession, *parts: str) -> str:
    """A sub-path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return "/".join([root, *[p.strip("/") for p in parts]])


def ensure_utc(spark: SparkSession) -> None:
    """Event times are wall-clock UTC (points are written with a ``Z``)."""
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT", "+00:00"):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
