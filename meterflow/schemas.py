"""Schemas and presets of the meter data model.

Every threshold, factor and table here is a default; the operators take them
as arguments.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the behaviour being reproduced) ---------------
# Progressive tariff, 5 tiers: (upper limit in kWh, price per kWh).
# The last tier has no upper limit.
TIERS: tuple[tuple[float, float], ...] = (
    (100, 1893),
    (200, 2271),
    (400, 2860),
    (700, 3407),
    (float("inf"), 3786),
)
# Alert cut points in kW, ">=" semantics: < WARN is INFO, [WARN, CRIT) WARNING.
WARN_KW = 3.0
CRIT_KW = 4.0
# Alert levels and the advice text shown for each.
LEVEL_INFO = "INFO"
LEVEL_WARNING = "WARNING"
LEVEL_CRITICAL = "CRITICAL"
SUGGESTIONS = {
    "INFO": "Hệ thống ổn định.",
    "WARNING": "Tiêu thụ cao, cân nhắc tắt bớt thiết bị.",
    "CRITICAL": "NGUY HIỂM! Quá tải hệ thống, hãy kiểm tra ngay!",
}
# Dashboard labels of the three sub-loads (kitchen, laundry, water heater).
SUB_LABELS = {"sub1_pct": "Bếp", "sub2_pct": "Giặt là", "sub3_pct": "Nước nóng"}
# kWh per reading: demo multiplier of the stream path, and 1-minute kW -> kWh.
KWH_FACTOR_DEMO = 1.5
KWH_FACTOR_MINUTE = 1.0 / 60.0
# Daily series: days with fewer readings are removed before the gap fill.
MIN_READINGS_PER_DAY = 600
# Forecast: weekly season, 7 steps, band z, demo scale of the forecast.
SEASON = 7
HORIZON = 7
BAND_Z = 1.96
DEMO_SCALE = 1.5
# Load gauge: scale 0..10 kW, red from 8 kW.
GAUGE_MIN = 0.0
GAUGE_MAX = 10.0
GAUGE_RED = 8.0
# Alert log length.
ALERT_LOG_LIMIT = 50
# Text formats.
EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TXT_DATETIME_FORMAT = "d/M/yyyy H:mm:ss"
POINT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
TXT_HEADER = (
    "Date;Time;Global_active_power;Global_reactive_power;Voltage;"
    "Global_intensity;Sub_metering_1;Sub_metering_2;Sub_metering_3"
)
CSV_HEADER = (
    "datetime,Global_active_power,Global_reactive_power,Voltage,"
    "Global_intensity,Sub_metering_1,Sub_metering_2,Sub_metering_3"
)
# ---------------------------------------------------------------------------

# Reading message on a topic (JSON text in a binary ``value`` column).
MESSAGE = T.StructType(
    [
        T.StructField("event_time", T.StringType(), True),
        T.StructField("kw", T.DoubleType(), True),
        T.StructField("sub1", T.DoubleType(), True),
        T.StructField("sub2", T.DoubleType(), True),
        T.StructField("sub3", T.DoubleType(), True),
    ]
)

# Parsed reading; ``meter_id`` and ``tie`` extend the single-meter message.
READING = T.StructType(
    [
        T.StructField("meter_id", T.StringType(), True),
        T.StructField("event_time", T.TimestampType(), True),
        T.StructField("tie", T.LongType(), True),
        T.StructField("kw", T.DoubleType(), True),
        T.StructField("kwh", T.DoubleType(), True),
        T.StructField("sub1", T.DoubleType(), True),
        T.StructField("sub2", T.DoubleType(), True),
        T.StructField("sub3", T.DoubleType(), True),
    ]
)

POWER_USAGE = T.StructType(
    [
        T.StructField("time", T.TimestampType(), True),
        T.StructField("alert_level", T.StringType(), True),
        T.StructField("kw", T.DoubleType(), True),
        T.StructField("kwh_cumulative", T.DoubleType(), True),
        T.StructField("vnd_cumulative", T.DoubleType(), True),
        T.StructField("sub1_pct", T.DoubleType(), True),
        T.StructField("sub2_pct", T.DoubleType(), True),
        T.StructField("sub3_pct", T.DoubleType(), True),
        T.StructField("suggestion", T.StringType(), True),
    ]
)

MONTHLY_BILLING = T.StructType(
    [
        T.StructField("time", T.TimestampType(), True),
        T.StructField("month_key", T.StringType(), True),
        T.StructField("kwh", T.DoubleType(), True),
        T.StructField("vnd", T.DoubleType(), True),
    ]
)

POWER_PREDICTIONS = T.StructType(
    [
        T.StructField("time", T.TimestampType(), True),
        T.StructField("yhat", T.DoubleType(), True),
        T.StructField("yhat_lower", T.DoubleType(), True),
        T.StructField("yhat_upper", T.DoubleType(), True),
    ]
)

DAILY = T.StructType(
    [
        T.StructField("meter_id", T.StringType(), True),
        T.StructField("ds", T.DateType(), True),
        T.StructField("y", T.DoubleType(), True),
        T.StructField("n", T.LongType(), True),
    ]
)

# Raw TXT dialect columns, all read as text.
TXT_COLUMNS = TXT_HEADER.split(";")
CSV_COLUMNS = CSV_HEADER.split(",")
