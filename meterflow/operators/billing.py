"""Running energy per billing cycle, running bill,
cycle rollovers, final bills and the two point-table projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.functions import (alert_level, cycle_key, point_time, sub_share, suggestion,
                                 tier_cost)
from meterflow.operators.scan import previous_row, running_total, running_totals
from meterflow.schemas import CRIT_KW, TIERS, WARN_KW

ORDER = ("event_time", "tie")


def _is_decimal(df: DataFrame, col: str) -> bool:
    return df.schema[col].dataType.typeName() == "decimal"


def with_cycle(readings: DataFrame, cycle: str = "calendar_month", out: str = "month_key",
               time: str = "event_time") -> DataFrame:
    """Add the billing-cycle key of each reading."""
    return readings.withColumn(out, cycle_key(time, cycle))


def cumulative_kwh(df: DataFrame, keys=("meter_id", "month_key"), order=ORDER,
                   value: str = "kwh", out: str = "kwh_cumulative") -> DataFrame:
    """Running kWh per (meter, cycle) in event-time order (ties by ``tie``).

    Balanced whatever a key holds (see ``scan``). DOUBLE kWh: a NaN makes the
    rest of its cycle NaN. DECIMAL kWh can't hold NaN: where the reading has a
    ``kw`` that is NaN, infinite or too large, the running kWh is NULL
    (unknown) from there to the end of the cycle.
    """
    if not _is_decimal(df, value) or "kw" not in df.columns:
        return running_total(df, keys, order, value, out)
    lost = (F.col("kw").isNotNull() & F.col(value).isNull()).cast("int")
    both = running_totals(df.withColumn("_lost", lost), keys, order, {out: value, "_n_lost": "_lost"})
    return both.withColumn(out, F.when(F.col("_n_lost") == 0, F.col(out))).drop("_lost", "_n_lost")


def running_bill(df: DataFrame, kwh_col: str = "kwh_cumulative", out: str = "vnd_cumulative",
                 tiers=TIERS) -> DataFrame:
    """Bill of the running kWh of each reading."""
    return df.withColumn(out, tier_cost(kwh_col, tiers, exact=_is_decimal(df, kwh_col)))


def classify(df: DataFrame, warn: float = WARN_KW, crit: float = CRIT_KW) -> DataFrame:
    """Alert level, advice text and the three sub-load shares."""
    return df.withColumns({
        "alert_level": alert_level("kw", warn, crit),
        "suggestion": suggestion(alert_level("kw", warn, crit)),
        "sub1_pct": sub_share("sub1", "kw"),
        "sub2_pct": sub_share("sub2", "kw"),
        "sub3_pct": sub_share("sub3", "kw"),
    })


def bill_readings(readings: DataFrame, cycle: str = "calendar_month", keys=("meter_id",),
                  order=ORDER, tiers=TIERS, warn: float = WARN_KW,
                  crit: float = CRIT_KW) -> DataFrame:
    """Everything the stream job derives per reading, as one lazy plan:
    cycle key, running kWh, running bill, alert level, advice, shares."""
    df = with_cycle(readings, cycle)
    df = cumulative_kwh(df, keys=[*keys, "month_key"], order=order)
    df = running_bill(df, tiers=tiers)
    return classify(df, warn, crit)


def power_usage(billed: DataFrame, keys=("meter_id",), extra=("tie",)) -> DataFrame:
    """``power_usage`` record (time to the second, alert level as a column)."""
    return billed.select(
        *keys, *extra, point_time("event_time").alias("time"), "alert_level", "kw",
        "kwh_cumulative", "vnd_cumulative", "sub1_pct", "sub2_pct", "sub3_pct", "suggestion")


def monthly_billing(billed: DataFrame, keys=("meter_id",), extra=("tie",)) -> DataFrame:
    """``monthly_billing`` record."""
    return billed.select(
        *keys, *extra, point_time("event_time").alias("time"), "month_key",
        F.col("kwh_cumulative").alias("kwh"), F.col("vnd_cumulative").alias("vnd"))


def rollovers(billed: DataFrame, keys=("meter_id",), cycle: str = "month_key", order=ORDER,
              total: str = "kwh_cumulative", tiers=TIERS) -> DataFrame:
    """A rollover is the first reading ever seen of a cycle key that is not the
    meter's first reading. It reports the previous reading's key, that key's
    running total and bill at that moment, and the new key.
    """
    keys, order = list(keys), list(order)
    rows = billed.select(*keys, *order, cycle, total)
    prev = previous_row(rows, keys, order, [cycle, total], prefix="prev_")
    # the first reading of a cycle follows no reading, or one of another cycle
    opens = prev.filter(F.col(cycle).isNotNull()
                        & (F.col(f"prev_{cycle}").isNull() | (F.col(f"prev_{cycle}") != F.col(cycle))))
    firsts = opens.groupBy(*keys, cycle).agg(F.min_by(
        F.struct(*order, f"prev_{cycle}", f"prev_{total}"), F.struct(*order)).alias("_first"))
    hit = firsts.filter(F.col(f"_first.prev_{cycle}").isNotNull()).select(*keys, cycle, "_first.*")
    return hit.select(
        *keys, F.col(order[0]).alias("time"), *order[1:],
        F.col(f"prev_{cycle}").alias("prev_key"),
        F.col(f"prev_{total}").alias("prev_kwh"),
        tier_cost(F.col(f"prev_{total}"), tiers,
                  exact=_is_decimal(billed, total)).alias("prev_vnd"),
        F.col(cycle).alias("new_key"))


def final_bills(readings_with_cycle: DataFrame, keys=("meter_id",), cycle: str = "month_key",
                value: str = "kwh", tiers=TIERS) -> DataFrame:
    """Total kWh and bill per (meter, cycle) - one partial+final aggregate."""
    agg = readings_with_cycle.groupBy(*keys, cycle).agg(
        F.sum(value).alias("kwh"), F.count(F.lit(1)).alias("readings"),
        F.min("event_time").alias("first_time"), F.max("event_time").alias("last_time"))
    return agg.withColumn("vnd", tier_cost("kwh", tiers, exact=_is_decimal(readings_with_cycle, value)))
