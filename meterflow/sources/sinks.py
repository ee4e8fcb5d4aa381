"""A7 (batch form), A8: point-table sinks.

Point tables are Parquet, partitioned by day so that the dashboard's time
range prunes whole folders; a write is idempotent per (run, batch) folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions import point_time


def write_points(df: DataFrame, path: str, time: str = "time", mode: str = "append") -> None:
    """Write point rows partitioned by ``day`` (derived from ``time``)."""
    (df.withColumn("day", F.to_date(time)).write.mode(mode).partitionBy("day").parquet(path))


def write_predictions(pred: DataFrame, path: str, keys=(), mode: str = "overwrite") -> None:
    """``power_predictions`` rows: time to the second, yhat and the band."""
    out = pred.select(*keys, point_time(F.col("time").cast("timestamp")).alias("time"),
                      "yhat", "yhat_lower", "yhat_upper")
    write_points(out, path, mode=mode)
