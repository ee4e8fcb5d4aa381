"""Reads that the stream job does on its own point tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions import cycle_key, tier_cost


def recover_totals(points: DataFrame, keys=("meter_id",), mode: str = "as_observed",
                   order=("time", "tie"), billing: DataFrame | None = None) -> DataFrame:
    """Running totals to resume from, read from stored points.

    ``as_observed``: per meter, the last point's time gives the 3-minute slot
    key; the state of that key is the maximum ``kwh_cumulative`` over the
    whole calendar month of that time (D8); its bill follows.
    ``per_cycle``: from ``monthly_billing``, the last kWh of every cycle key
    (feeds the initial state of the streaming operator).
    """
    keys, order = list(keys), list(order)
    if mode == "per_cycle":
        src = billing if billing is not None else points
        last = src.groupBy(*keys, "month_key").agg(
            F.max_by("kwh", F.struct(*order)).alias("kwh"))
        return last.withColumn("vnd", tier_cost("kwh"))
    if mode != "as_observed":
        raise ValueError(f"unknown mode {mode!r}")
    # per month its largest total and its last point; then the month of the last point of all
    seen = F.when(F.col("kwh_cumulative").isNotNull(), F.struct(*order))
    months = points.groupBy(*keys, F.date_trunc("month", "time").alias("_month")).agg(
        F.max("kwh_cumulative").alias("kwh"), F.max(seen).alias("_last"))
    top = months.filter("_last is not null").groupBy(*keys).agg(
        F.max_by(F.struct("kwh", F.col("_last")[order[0]].alias("last_time")), "_last").alias("_top"))
    peak = top.select(*keys, cycle_key("_top.last_time", "demo_slot").alias("month_key"),
                      F.col("_top.last_time").alias("last_time"), F.col("_top.kwh").alias("kwh"))
    return peak.withColumn("vnd", tier_cost("kwh"))


def batch_summary(points: DataFrame, batch_col: str = "batch_id", order=("time", "tie")):
    """D9+D10: per batch the number of points, CRITICAL points, last time,
    last kWh and last bill - one aggregate."""
    o = F.struct(*order)
    return points.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("points"),
        F.count_if(F.col("alert_level") == "CRITICAL").alias("critical"),
        F.max("time").alias("last_time"),
        F.max_by("kwh_cumulative", o).alias("last_kwh"),
        F.max_by("vnd_cumulative", o).alias("last_vnd"))
