"""Readings from the shared test tables (the ``readings`` view).

``events(event_id, ts, user_id, event_type, value, props)`` maps to a reading:
meter_id = user_id, event_time = ts, tie = event_id, kw = value / 25,
sub1 = k * 0.1, sub2 = k * 0.05, sub3 = (99 - k) * 0.1 with k = props.$.k.
With ``house=True`` all rows belong to one meter (the single-meter deployment,
the hot-key case).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions import kwh as kwh_expr
from meterflow.schemas import KWH_FACTOR_DEMO

KW_DIVISOR = 25.0
HOUSE = "house"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def readings_from_events(events: DataFrame, house: bool = False,
                         factor: float = KWH_FACTOR_DEMO, exact: bool = True,
                         extra=()) -> DataFrame:
    """Parsed readings (M4) from ``events``; ``kwh`` DECIMAL when ``exact``."""
    k = F.get_json_object("props", "$.k").cast("int")
    kw = F.col("value") / F.lit(KW_DIVISOR)
    meter = F.lit(HOUSE) if house else F.col("user_id")
    return events.select(
        meter.alias("meter_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("tie"),
        kw.alias("kw"),
        kwh_expr(kw, factor, exact=exact).alias("kwh"),
        (k * F.lit(0.1)).alias("sub1"),
        (k * F.lit(0.05)).alias("sub2"),
        ((F.lit(99) - k) * F.lit(0.1)).alias("sub3"),
        *extra,
    )


def readings(spark: SparkSession, sf_dir: str, house: bool = False,
             factor: float = KWH_FACTOR_DEMO, exact: bool = True) -> DataFrame:
    return readings_from_events(table(spark, sf_dir, "events"), house, factor, exact)


def lineitem_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A long single-meter series: one reading per lineitem, kW = l_quantity,
    stamped at the ship date (about 2,500 days)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.lit("lineitem").alias("meter_id"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("tie"),
        F.col("l_quantity").alias("kw"),
    )


def line_meters(spark: SparkSession, sf_dir: str, meter: str = "concat('m', l_linenumber)") -> DataFrame:
    """Years of readings from lineitem, of one meter for each value of ``meter``
    (default: seven, by line number): many months, few hot keys, and many
    readings that share an instant."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.expr(meter).alias("meter_id"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("tie"),
        F.col("l_quantity").alias("kw"), kwh_expr("l_quantity", KWH_FACTOR_DEMO, exact=True).alias("kwh"),
        *(F.lit(0.0).alias(c) for c in ("sub1", "sub2", "sub3")))


# Raw text views of ``events`` for the file and message operators. Every row
# is rendered; the event type decides the dialect and the defect, so both
# cleanings and every reject reason are exercised on the whole table:
#   view, purchase -> CSV dialect line; others -> TXT dialect line
#   error    -> power field '?'            (both cleanings drop it)
#   signup   -> Sub_metering_2 field '?'   (strict drops it, loose keeps it)
#   click    -> Sub_metering_3 field empty (both keep it; strict reads 0.0)
#   purchase -> Sub_metering_1 field 'x'   (strict drops it, loose keeps it)
def meter_lines_from_events(events: DataFrame, digits: tuple[int, int] = (4, 2)) -> DataFrame:
    """(tie, value); ``digits``: decimals of the power and of the sub-meters."""
    power, sub = (f"%.{d}f" for d in digits)
    k = F.get_json_object("props", "$.k").cast("int")
    et = F.col("event_type")
    fields = events.select(
        F.col("event_id").alias("tie"), et.isin("view", "purchase").alias("_csv"),
        F.date_format("ts", "d/M/yyyy").alias("_d"), F.date_format("ts", "HH:mm:ss").alias("_t"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("_dt"),
        F.when(et == "error", F.lit("?")).otherwise(
            F.format_string(power, F.col("value") / 25)).alias("_kw"),
        F.when(et == "purchase", F.lit("x")).otherwise(
            F.format_string(sub, k * F.lit(0.1))).alias("_s1"),
        F.when(et == "signup", F.lit("?")).otherwise(
            F.format_string(sub, k * F.lit(0.05))).alias("_s2"),
        F.when(et == "click", F.lit("")).otherwise(
            F.format_string(sub, (F.lit(99) - k) * F.lit(0.1))).alias("_s3"))
    csv = F.col("_csv")
    sep_line_txt = F.concat_ws(";", "_d", "_t", "_kw", F.lit("0.100"), F.lit("240.000"),
                               F.lit("1.000"), "_s1", "_s2", "_s3")
    sep_line_csv = F.concat_ws(",", "_dt", "_kw", F.lit("0.100"), F.lit("240.000"),
                               F.lit("1.000"), "_s1", "_s2", "_s3")
    return fields.select("tie", F.when(csv, sep_line_csv).otherwise(sep_line_txt).alias("value"))


#   error  -> text that is not JSON          (reject 'json')
#   signup -> event_time "bad"               (reject 'time')
#   click  -> kw "x"                         (reject 'kw')
def messages_from_events(events: DataFrame) -> DataFrame:
    from meterflow.sources.topic import encode_readings
    r = readings_from_events(events, exact=False, extra=("event_type",))
    enc = encode_readings(r, keys=("tie", "event_type"))
    txt = F.col("value").cast("string")
    et = F.col("event_type")
    bad = (F.when(et == "error", F.lit("{bad"))
           .when(et == "signup", F.regexp_replace(txt, '"event_time":"[^"]*"', '"event_time":"bad"'))
           .when(et == "click", F.regexp_replace(txt, '"kw":[^,}]*', '"kw":"x"'))
           .otherwise(txt))
    return enc.select("tie", bad.cast("binary").alias("value"))


def messages_clean(events: DataFrame, house: bool = True) -> DataFrame:
    """Well-formed reading messages of every event: (tie, event_time, value).

    ``tie`` plays the role of the topic offset (event ids grow with time)."""
    from meterflow.sources.topic import encode_readings
    r = readings_from_events(events, house=house, exact=False)
    return encode_readings(r, keys=("tie", "event_time"))
