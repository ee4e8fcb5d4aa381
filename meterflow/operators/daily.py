"""Daily energy series for the forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.operators.dashboard import fill_gaps, interpolate_linear
from meterflow.schemas import KWH_FACTOR_MINUTE, MIN_READINGS_PER_DAY


def daily_energy(readings: DataFrame, keys=("meter_id",), factor: float = KWH_FACTOR_MINUTE,
                 min_readings: int = MIN_READINGS_PER_DAY, time: str = "event_time",
                 kw: str = "kw") -> DataFrame:
    """D1+D2 (C1 folded in): y = sum(kW) * factor per day, kept when the day has
    at least ``min_readings`` readings. One partial+final aggregate (sum and
    count together), so a hot meter is combined map-side.

    kW is summed as DECIMAL(18,6) so the total does not depend on the order
    of additions; y is that total times ``factor`` as DOUBLE. NaN, infinite
    and impossible kW (1e12 and above) are no readings: neither summed nor counted.
    """
    agg = (readings.withColumn("_kw", F.col(kw).try_cast("decimal(18,6)"))
           .filter(F.col("_kw").isNotNull() & F.col(time).isNotNull())
           .groupBy(*keys, F.to_date(time).alias("ds"))
           .agg(F.sum("_kw").alias("_s"), F.count(F.lit(1)).alias("n")))
    return (agg.filter(F.col("n") >= F.lit(min_readings))
            .select(*keys, "ds", (F.col("_s").cast("double") * F.lit(float(factor))).alias("y"), "n"))


def densify_daily(daily: DataFrame, keys=("meter_id",), ds: str = "ds") -> DataFrame:
    """C2+E4: one row per calendar day from each series' first to last day;
    missing days have NULL values (see ``fill_gaps``: no spine, no join)."""
    values = [c for c in daily.columns if c not in (*keys, ds)]
    return fill_gaps(daily, keys, ds, values, F.expr("INTERVAL 1 DAY"))


def interpolate_time(df: DataFrame, keys=("meter_id",), time: str = "ds", value: str = "y"):
    """E5: time-linear interpolation of interior gaps."""
    return interpolate_linear(df, keys, time, value)


def daily_series(readings: DataFrame, keys=("meter_id",), factor: float = KWH_FACTOR_MINUTE,
                 min_readings: int = MIN_READINGS_PER_DAY) -> DataFrame:
    """The whole daily preparation: aggregate, drop thin days, re-create every
    day in the span and interpolate (thin days come back interpolated)."""
    d = daily_energy(readings, keys, factor, min_readings)
    return fill_gaps(d, keys, "ds", ["y"], F.expr("INTERVAL 1 DAY"), linear=True)


def series_profile(daily: DataFrame, keys=("meter_id",), exact: bool = False) -> DataFrame:
    """Days, first/last day, mean and max daily energy per series.

    ``exact``: the mean adds the (at most one per day) values in ascending
    order, so it does not depend on how partitions were combined.
    """
    mean = (F.aggregate(F.array_sort(F.collect_list("y")), F.lit(0.0), lambda a, x: a + x)
            / F.count("y")) if exact else F.avg("y")
    return daily.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("days"), F.min("ds").alias("first_day"),
        F.max("ds").alias("last_day"), mean.alias("mean_y"), F.max("y").alias("max_y"))
