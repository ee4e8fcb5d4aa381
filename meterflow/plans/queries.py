"""The registered queries: each ``(spark, sf_dir) -> DataFrame`` over the whole
test tables, plus the DuckDB oracle text for each (where SQL can state it).

Money and energy are carried as DECIMAL inside the plans (exact, summation
order free) and returned as DOUBLE; times are returned as TIMESTAMP_NTZ like
the source tables.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.operators import billing, dashboard, daily, forecast as fc, points as pts
from meterflow.plans import sql as S
import uuid

from meterflow.functions import tier_cost
from meterflow.schemas import DEMO_SCALE
from meterflow.session import checkpoint_path, ensure_utc
from meterflow.sources import files, tables, topic
from meterflow.sources.store import PointStore

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


def dbl(c: str):
    return F.col(c).cast("double").alias(c)


def _billed(spark, sf_dir, house=False, cycle="calendar_month"):
    ensure_utc(spark)
    return billing.bill_readings(tables.readings(spark, sf_dir, house=house), cycle=cycle)


def _usage_out(billed: DataFrame) -> DataFrame:
    pu = billing.power_usage(billed, extra=("tie", "month_key"))
    return pu.select("meter_id", "tie", ntz("time"), "alert_level", "kw", dbl("kwh_cumulative"),
                     dbl("vnd_cumulative"), "sub1_pct", "sub2_pct", "sub3_pct", "suggestion",
                     "month_key")


# --- billing core: E1, E2, B8-B15 -----------------------------------------------------

@register("power_usage", S.power_usage_sql(False, "calendar_month"))
def q_power_usage(spark, sf_dir):
    """Per meter, calendar-month cycles: the flagship."""
    return _usage_out(_billed(spark, sf_dir))


@register("house_power_usage", S.power_usage_sql(True, "calendar_month"))
def q_house_power_usage(spark, sf_dir):
    """All readings one meter, one month: the hot-key case; reaches tier 5.
    The scan cuts the key at hours and seconds, as it does every key."""
    return _usage_out(_billed(spark, sf_dir, house=True))


@register("demo_slot_usage", S.power_usage_sql(True, "demo_slot"))
def q_demo_slot_usage(spark, sf_dir):
    """Single meter with 3-minute ``demo-{h}-{m//3}`` slots that resume each day."""
    return _usage_out(_billed(spark, sf_dir, house=True, cycle="demo_slot"))


# --- point tables, rollovers, final bills: B16, E3, D13 ------------------------------------

@register("monthly_billing", f"""
    WITH {S.billed_sql(False, 'calendar_month')}
    SELECT meter_id, tie, date_trunc('second', event_time) AS time, month_key,
           CAST(cum AS DOUBLE) AS kwh, CAST(vnd_dec AS DOUBLE) AS vnd
    FROM b""")
def q_monthly_billing(spark, sf_dir):
    mb = billing.monthly_billing(_billed(spark, sf_dir))
    return mb.select("meter_id", "tie", ntz("time"), "month_key", dbl("kwh"), dbl("vnd"))


def _rollover_sql(house: bool, cycle: str, source: str | None = None) -> str:
    return f"""
    WITH {S.billed_sql(house, cycle, source)},
    seq AS (
      SELECT *, lag(month_key) OVER (PARTITION BY meter_id ORDER BY event_time, tie) AS prev_key,
             lag(cum) OVER (PARTITION BY meter_id ORDER BY event_time, tie) AS prev_cum,
             row_number() OVER (PARTITION BY meter_id, month_key ORDER BY event_time, tie) AS k_rn
      FROM b)
    SELECT meter_id, event_time AS time, tie, prev_key, CAST(prev_cum AS DOUBLE) AS prev_kwh,
           CAST({S.tier_sql('prev_cum')} AS DOUBLE) AS prev_vnd, month_key AS new_key
    FROM seq WHERE k_rn = 1 AND prev_key IS NOT NULL"""


def _rollovers(spark, sf_dir, house, cycle):
    return _rollover_out(billing.rollovers(_billed(spark, sf_dir, house=house, cycle=cycle)))


def _rollover_out(r):
    return r.select("meter_id", ntz("time"), "tie", "prev_key", dbl("prev_kwh"), dbl("prev_vnd"),
                    "new_key")


@register("rollovers", _rollover_sql(False, "calendar_month", S.SUPPLY_METERS_SQL))
def q_rollovers(spark, sf_dir):
    """97 meters over some eighty months: calendar-month rollovers of each."""
    ensure_utc(spark)
    return _rollover_out(billing.rollovers(billing.bill_readings(tables.line_meters(spark, sf_dir, "concat('s', l_suppkey % 97)"))))


@register("line_meter_rollovers", _rollover_sql(False, "calendar_month", S.LINE_METERS_SQL))
def q_line_meter_rollovers(spark, sf_dir):
    """Seven meters over some eighty months: a rollover at every turn of a month."""
    ensure_utc(spark)
    return _rollover_out(billing.rollovers(billing.bill_readings(tables.line_meters(spark, sf_dir))))


@register("demo_slot_rollovers", _rollover_sql(True, "demo_slot"))
def q_demo_slot_rollovers(spark, sf_dir):
    """Single meter, 3-minute slots: the first sighting of each of the 480 slots."""
    return _rollovers(spark, sf_dir, True, "demo_slot")


@register("meter_slot_rollovers", _rollover_sql(False, "demo_slot"))
def q_meter_slot_rollovers(spark, sf_dir):
    """Per meter, 3-minute slots."""
    return _rollovers(spark, sf_dir, False, "demo_slot")


def _final_bills_sql(house: bool, cycle: str) -> str:
    return f"""
    WITH r AS (SELECT *, {S.cycle_sql(cycle)} AS month_key FROM ({S.readings_sql(house)}))
    SELECT meter_id, month_key, CAST(sum(kwh) AS DOUBLE) AS kwh, count(*) AS readings,
           min(event_time) AS first_time, max(event_time) AS last_time,
           CAST({S.tier_sql('sum(kwh)')} AS DOUBLE) AS vnd
    FROM r GROUP BY meter_id, month_key"""


def _final_bills(spark, sf_dir, house, cycle):
    ensure_utc(spark)
    r = billing.with_cycle(tables.readings(spark, sf_dir, house=house), cycle)
    fb = billing.final_bills(r)
    return fb.select("meter_id", "month_key", dbl("kwh"), "readings", ntz("first_time"),
                     ntz("last_time"), dbl("vnd"))


@register("final_bills", _final_bills_sql(False, "calendar_month"))
def q_final_bills(spark, sf_dir):
    return _final_bills(spark, sf_dir, False, "calendar_month")


@register("demo_slot_final_bills", _final_bills_sql(True, "demo_slot"))
def q_demo_slot_final_bills(spark, sf_dir):
    return _final_bills(spark, sf_dir, True, "demo_slot")


# --- dashboard reads over the single-meter point tables: B19-B22, D3-D7, D12, E6, E7, F2 -----
# The panel range ($timeFilter) covers the whole month of test data.
FROM_TS = "2024-01-01 00:00:00"
TO_TS = "2024-01-31 00:00:00"
RANGE_SQL = f"time >= TIMESTAMP '{FROM_TS}' AND time <= TIMESTAMP '{TO_TS}'"


def _house_usage(spark, sf_dir):
    return billing.power_usage(_billed(spark, sf_dir, house=True), extra=("tie", "month_key"))


def _last_sql(field: str, table: str = "pu", where: str = RANGE_SQL) -> str:
    return (f"(SELECT {field} FROM {table} WHERE {field} IS NOT NULL AND {where} "
            f"ORDER BY time DESC, tie DESC LIMIT 1)")


@register("billing_latest", f"""
    WITH {S.usage_cte(True)}
    SELECT CAST({_last_sql('vnd_cumulative')} AS DOUBLE) AS vnd,
           CAST({_last_sql('kwh_cumulative')} AS DOUBLE) AS kwh""")
def q_billing_latest(spark, sf_dir):
    """D3: LAST(vnd), LAST(kwh) of monthly_billing in the panel range."""
    mb = billing.monthly_billing(_billed(spark, sf_dir, house=True))
    out = dashboard.latest(mb, ["vnd", "kwh"], FROM_TS, TO_TS)
    return out.select(dbl("vnd"), dbl("kwh"))


@register("bill_peak", f"""
    WITH {S.usage_cte(False)}
    SELECT meter_id, CAST(max(vnd_cumulative) AS DOUBLE) AS max_vnd FROM pu GROUP BY meter_id""")
def q_bill_peak(spark, sf_dir):
    """All-time MAX(vnd) per meter (no time filter)."""
    mb = billing.monthly_billing(_billed(spark, sf_dir))
    return dashboard.peak(mb, "vnd", keys=["meter_id"], alias="max_vnd").select(
        "meter_id", dbl("max_vnd"))


@register("load_gauge", f"""
    WITH {S.usage_cte(True)}, l AS (SELECT {_last_sql('kw')} AS kw)
    SELECT kw, CASE WHEN kw IS NULL THEN NULL WHEN kw >= 8.0 THEN 'red' ELSE 'green' END AS band,
           least(greatest(kw, 0.0::DOUBLE), 10.0::DOUBLE) AS gauge_kw,
           (least(greatest(kw, 0.0::DOUBLE), 10.0::DOUBLE) - 0.0::DOUBLE) / 10.0::DOUBLE * 100.0::DOUBLE
             AS gauge_pct
    FROM l""")
def q_load_gauge(spark, sf_dir):
    """D3 + B19: LAST(kw) with its gauge band (green < 8 <= red) on the 0..10 scale."""
    return dashboard.load_gauge(dashboard.time_range(_house_usage(spark, sf_dir), FROM_TS, TO_TS))


@register("load_mix", f"""
    WITH {S.usage_cte(True)},
    l AS (SELECT {_last_sql('sub1_pct')} AS kitchen, {_last_sql('sub2_pct')} AS laundry,
                 {_last_sql('sub3_pct')} AS water_heater),
    t AS (SELECT *, 0.0::DOUBLE + coalesce(kitchen, 0.0::DOUBLE) + coalesce(laundry, 0.0::DOUBLE)
                    + coalesce(water_heater, 0.0::DOUBLE) AS tot FROM l)
    SELECT kitchen, laundry, water_heater,
      CASE WHEN tot > 0 THEN coalesce(kitchen, 0.0::DOUBLE) / tot * 100.0::DOUBLE ELSE 0.0::DOUBLE END AS kitchen_share,
      CASE WHEN tot > 0 THEN coalesce(laundry, 0.0::DOUBLE) / tot * 100.0::DOUBLE ELSE 0.0::DOUBLE END AS laundry_share,
      CASE WHEN tot > 0 THEN coalesce(water_heater, 0.0::DOUBLE) / tot * 100.0::DOUBLE ELSE 0.0::DOUBLE END AS water_heater_share
    FROM t""")
def q_load_mix(spark, sf_dir):
    """D4 + D12 + B20: last share of each sub-load and their split of the three."""
    return dashboard.load_mix(_house_usage(spark, sf_dir), FROM_TS, TO_TS)


@register("alert_log", f"""
    WITH {S.usage_cte(True)}
    SELECT time, kw, suggestion FROM pu WHERE kw >= 3 ORDER BY time DESC, tie DESC LIMIT 50""")
def q_alert_log(spark, sf_dir):
    """F2 + B22: kW >= 3, newest first, 50 rows (the top-k is the feature)."""
    return dashboard.alert_log(_house_usage(spark, sf_dir)).select(ntz("time"), "kw", "suggestion")


def _bucket_sql(interval: str, fill: str, keyed: bool) -> str:
    key = "meter_id, " if keyed else ""
    spine_base = "(SELECT DISTINCT meter_id FROM rng)" if keyed else "(SELECT 1 AS one)"
    q = f"""
    WITH {S.usage_cte(not keyed)},
    rng AS (SELECT * FROM pu WHERE {RANGE_SQL}),
    agg AS (SELECT {key}time_bucket(INTERVAL '{interval}', time) AS bucket,
                   CAST(sum(CAST(kw AS DECIMAL(28,6))) AS DOUBLE) / count(kw) AS mean_kw
            FROM rng GROUP BY ALL),
    spine AS (SELECT {key}unnest(generate_series(time_bucket(INTERVAL '{interval}', TIMESTAMP '{FROM_TS}'),
                                                 time_bucket(INTERVAL '{interval}', TIMESTAMP '{TO_TS}'),
                                                 INTERVAL '{interval}')) AS bucket FROM {spine_base}),
    filled AS (SELECT s.{'meter_id, s.' if keyed else ''}bucket, a.mean_kw
               FROM spine s LEFT JOIN agg a ON a.bucket = s.bucket {'AND a.meter_id = s.meter_id' if keyed else ''})"""
    if fill == "linear":
        return q + f"""
    SELECT {key}bucket, mean_kw FROM {S.interp_sql('filled', 'meter_id' if keyed else '', 'bucket', 'epoch(bucket)', 'mean_kw')}"""
    return q + f"""
    SELECT {key}bucket, mean_kw FROM filled"""


def _bucket(spark, sf_dir, interval, fill, keyed):
    pu = (billing.power_usage(_billed(spark, sf_dir), extra=("tie",)) if keyed
          else _house_usage(spark, sf_dir))
    out = dashboard.bucket_mean(pu, ["kw"], interval, FROM_TS, TO_TS,
                                keys=["meter_id"] if keyed else [], fill=fill, exact=True)
    return out.select(*(["meter_id"] if keyed else []), ntz("bucket"), "mean_kw")


@register("kw_bucket_mean", _bucket_sql("5 minutes", "null", False))
def q_kw_bucket_mean(spark, sf_dir):
    """D6 + E6: MEAN(kw) GROUP BY time(5m) over the range, empty buckets NULL."""
    return _bucket(spark, sf_dir, "5 minutes", "null", False)


@register("kw_bucket_linear", _bucket_sql("5 minutes", "linear", False))
def q_kw_bucket_linear(spark, sf_dir):
    """D7 + E7: as above with fill(linear) of interior empty buckets."""
    return _bucket(spark, sf_dir, "5 minutes", "linear", False)


@register("meter_hourly_mean", _bucket_sql("1 hour", "null", True))
def q_meter_hourly_mean(spark, sf_dir):
    """D6 + E6 per meter: hourly mean kW, every hour of the range for every meter."""
    return _bucket(spark, sf_dir, "1 hour", "null", True)


# --- point-store semantics and stream-job reads: A9, I5, D8, D9, D10 ----------------------

def _two_writes(spark, sf_dir):
    cols = ["meter_id", "time", "alert_level", "tie", "kw", "kwh_cumulative", "vnd_cumulative"]
    pu = billing.power_usage(_billed(spark, sf_dir)).select(*cols, F.lit(1).alias("batch"))
    again = pu.filter("tie % 3 = 0").select(
        "meter_id", "time", "alert_level", "tie", (F.col("kw") * 2).alias("kw"),
        (F.col("kwh_cumulative") * 2).alias("kwh_cumulative"), "vnd_cumulative", F.lit(2).alias("batch"))
    return pu, again


@register("upsert_points", f"""
    WITH {S.usage_cte(False)},
    writes AS (SELECT *, 1 AS batch FROM pu UNION ALL
               SELECT * REPLACE (kw * 2 AS kw, kwh_cumulative * 2 AS kwh_cumulative), 2 AS batch FROM pu WHERE tie % 3 = 0)
    SELECT meter_id, time, alert_level, batch, tie, kw, kwh_cumulative, vnd_cumulative
    FROM writes QUALIFY row_number() OVER (PARTITION BY meter_id, time, alert_level
                                           ORDER BY batch DESC, time DESC, tie DESC) = 1""")
def q_upsert_points(spark, sf_dir):
    """Points sharing (meter, second, alert level) replace each other; last write wins.
    A second write repeats every third point with other values."""
    pu, again = _two_writes(spark, sf_dir)
    up = dashboard.upsert_points(pu.union(again), ["meter_id", "time", "alert_level"], ["batch", "time", "tie"])
    return up.select("meter_id", ntz("time"), "alert_level", "batch", "tie", "kw", dbl("kwh_cumulative"),
                     dbl("vnd_cumulative"))


@register("recover_totals", f"""
    WITH {S.usage_cte(False)},
    last AS (SELECT meter_id, time AS last_time FROM pu WHERE kwh_cumulative IS NOT NULL
             QUALIFY row_number() OVER (PARTITION BY meter_id ORDER BY time DESC, tie DESC) = 1)
    SELECT l.meter_id, l.last_time, {S.cycle_sql('demo_slot', 'l.last_time')} AS month_key,
           max(p.kwh_cumulative) AS kwh, {S.tier_sql('max(p.kwh_cumulative)')} AS vnd
    FROM last l JOIN pu p ON p.meter_id = l.meter_id
     AND p.time >= date_trunc('month', l.last_time)
     AND p.time < date_trunc('month', l.last_time) + INTERVAL 1 MONTH
    GROUP BY ALL""")
def q_recover_totals(spark, sf_dir):
    """I5 + D8: last point -> its slot key -> MAX(kwh_cumulative) in that calendar month -> bill."""
    pu = billing.power_usage(_billed(spark, sf_dir))
    rec = pts.recover_totals(pu)
    return rec.select("meter_id", ntz("last_time"), "month_key", dbl("kwh"), "vnd")


@register("recover_cycles", f"""
    WITH {S.usage_cte(True, 'demo_slot')}
    SELECT meter_id, month_key, kwh_cumulative AS kwh, {S.tier_sql('kwh_cumulative')} AS vnd
    FROM pu QUALIFY row_number() OVER (PARTITION BY meter_id, month_key
                                       ORDER BY time DESC, tie DESC) = 1""")
def q_recover_cycles(spark, sf_dir):
    """I5 per_cycle: the last kWh of every slot key from monthly_billing (initial state)."""
    mb = billing.monthly_billing(_billed(spark, sf_dir, house=True, cycle="demo_slot"))
    rec = pts.recover_totals(None, mode="per_cycle", billing=mb.withColumn("kwh", dbl("kwh")))
    return rec.select("meter_id", "month_key", "kwh", "vnd")


@register("batch_summary", f"""
    WITH {S.usage_cte(True)},
    agg AS (SELECT date_trunc('hour', time) AS batch_id, count(*) AS points,
                   count(*) FILTER (WHERE alert_level = 'CRITICAL') AS critical,
                   max(time) AS last_time
            FROM pu GROUP BY 1),
    lastrow AS (SELECT date_trunc('hour', time) AS batch_id, kwh_cumulative AS last_kwh,
                       vnd_cumulative AS last_vnd
                FROM pu QUALIFY row_number() OVER (PARTITION BY date_trunc('hour', time)
                                                   ORDER BY time DESC, tie DESC) = 1)
    SELECT a.batch_id, a.points, a.critical, a.last_time, l.last_kwh, l.last_vnd
    FROM agg a JOIN lastrow l ON a.batch_id = l.batch_id""")
def q_batch_summary(spark, sf_dir):
    """D9 + D10 with hourly batches: points, CRITICAL count, last time, last kWh and bill."""
    pu = _house_usage(spark, sf_dir).select(
        "*", F.date_trunc("hour", "time").alias("batch_id"))
    pu = pu.withColumns({"kwh_cumulative": dbl("kwh_cumulative"),
                         "vnd_cumulative": dbl("vnd_cumulative")})
    return pts.batch_summary(pu).select(ntz("batch_id"), "points", "critical", ntz("last_time"),
                                        "last_kwh", "last_vnd")


# --- meter files and topic messages: A1-A4, A6, A10, B1-B7, I8 ----------------------------

@register("strict_readings", f"""
    WITH f AS ({S.fields_sql()})
    SELECT tie, event_time, round(TRY_CAST(kwt AS DOUBLE), 4) AS kw,
           round(CASE WHEN s1t IS NULL OR s1t = '' THEN 0.0::DOUBLE ELSE TRY_CAST(s1t AS DOUBLE) END, 2) AS sub1,
           round(CASE WHEN s2t IS NULL OR s2t = '' THEN 0.0::DOUBLE ELSE TRY_CAST(s2t AS DOUBLE) END, 2) AS sub2,
           round(CASE WHEN s3t IS NULL OR s3t = '' THEN 0.0::DOUBLE ELSE TRY_CAST(s3t AS DOUBLE) END, 2) AS sub3
    FROM f
    WHERE length(line) > 0 AND line NOT LIKE '%?%' AND dia IS NOT NULL
      AND np >= CASE WHEN dia = 'txt' THEN 3 ELSE 2 END AND NOT header
      AND TRY_CAST(kwt AS DOUBLE) IS NOT NULL
      AND (s1t IS NULL OR s1t = '' OR TRY_CAST(s1t AS DOUBLE) IS NOT NULL)
      AND (s2t IS NULL OR s2t = '' OR TRY_CAST(s2t AS DOUBLE) IS NOT NULL)
      AND (s3t IS NULL OR s3t = '' OR TRY_CAST(s3t AS DOUBLE) IS NOT NULL)""")
def q_strict_readings(spark, sf_dir):
    """A1-A3 + B1 + B3: mixed-dialect meter lines, replay cleaning."""
    ensure_utc(spark)
    lines = tables.meter_lines_from_events(tables.table(spark, sf_dir, "events"))
    out = files.strict_rows(lines, keep=("tie",))
    return out.select("tie", ntz("event_time"), "kw", "sub1", "sub2", "sub3")


FINE = (7, 5)  # decimals in the lines, more than are kept


@register("strict_rounding", f"""
    WITH f AS ({S.fields_sql(FINE)}), n AS (
    SELECT tie, TRY_CAST(kwt AS DOUBLE) AS kw, CASE WHEN s1t = '' THEN 0.0::DOUBLE ELSE TRY_CAST(s1t AS DOUBLE) END AS sub1,
           CASE WHEN s2t = '' THEN 0.0::DOUBLE ELSE TRY_CAST(s2t AS DOUBLE) END AS sub2,
           CASE WHEN s3t = '' THEN 0.0::DOUBLE ELSE TRY_CAST(s3t AS DOUBLE) END AS sub3
    FROM f WHERE line NOT LIKE '%?%')
    SELECT tie, {S.round_sql('kw', 4)} AS kw, {S.round_sql('sub1', 2)} AS sub1, {S.round_sql('sub2', 2)} AS sub2, {S.round_sql('sub3', 2)} AS sub3
    FROM n WHERE kw IS NOT NULL AND sub1 IS NOT NULL AND sub2 IS NOT NULL AND sub3 IS NOT NULL""")
def q_strict_rounding(spark, sf_dir):
    """Lines with more decimals than are kept; the exact value of each number is rounded, ties to even."""
    ensure_utc(spark)
    lines = tables.meter_lines_from_events(tables.table(spark, sf_dir, "events"), FINE)
    return files.strict_rows(lines, keep=("tie",)).select("tie", "kw", "sub1", "sub2", "sub3")


def _na_num(c: str) -> str:
    return f"TRY_CAST(CASE WHEN trim({c}) IN ('?', '') THEN NULL ELSE trim({c}) END AS DOUBLE)"


@register("loose_readings", f"""
    WITH f AS ({S.fields_sql()})
    SELECT tie, event_time, {_na_num('kwt')} AS kw, {_na_num('s1t')} AS sub1,
           {_na_num('s2t')} AS sub2, {_na_num('s3t')} AS sub3
    FROM f WHERE dia IS NOT NULL AND NOT header AND event_time IS NOT NULL
      AND {_na_num('kwt')} IS NOT NULL""")
def q_loose_readings(spark, sf_dir):
    """A4 + A10 + B2 + B6 + B7: the forecast cleaning (NA markers, coercion to NULL)."""
    ensure_utc(spark)
    lines = tables.meter_lines_from_events(tables.table(spark, sf_dir, "events"))
    out = files.loose_rows(lines, keep=("tie",))
    return out.select("tie", ntz("event_time"), "kw", "sub1", "sub2", "sub3")


@register("decoded_readings", """
    SELECT event_id AS tie, date_trunc('second', ts) AS event_time, value / 25 AS kw,
           value / 25 * 1.5::DOUBLE AS kwh,
           CAST(json_extract_string(props, '$.k') AS INTEGER) * 0.1::DOUBLE AS sub1,
           CAST(json_extract_string(props, '$.k') AS INTEGER) * 0.05::DOUBLE AS sub2,
           (99 - CAST(json_extract_string(props, '$.k') AS INTEGER)) * 0.1::DOUBLE AS sub3
    FROM events WHERE event_type NOT IN ('error', 'signup', 'click')""")
def q_decoded_readings(spark, sf_dir):
    """A6 + B4 + B5 + B8: encode readings as JSON messages, decode them back."""
    ensure_utc(spark)
    msgs = tables.messages_from_events(tables.table(spark, sf_dir, "events"))
    good, _ = topic.split_rejects(topic.decode_readings(msgs, keep=("tie",)))
    return good.select("tie", ntz("event_time"), "kw", "kwh", "sub1", "sub2", "sub3")


@register("rejected_messages", """
    SELECT event_id AS tie, CASE event_type WHEN 'error' THEN 'json' WHEN 'signup' THEN 'time'
                                 ELSE 'kw' END AS reject
    FROM events WHERE event_type IN ('error', 'signup', 'click')""")
def q_rejected_messages(spark, sf_dir):
    """I8: undecodable messages with the reason (json / time / kw), never a failure."""
    ensure_utc(spark)
    msgs = tables.messages_from_events(tables.table(spark, sf_dir, "events"))
    _, bad = topic.split_rejects(topic.decode_readings(msgs, keep=("tie",)))
    return bad.select("tie", "reject")


# --- daily series: D1, D2, D11, C1, C2, E4, E5 -----------------------------------------------

@register("daily_energy", S.daily_sql(True, 320))
def q_daily_energy(spark, sf_dir):
    """D1 + D2: single meter, kWh per day = sum(kW)/60, days with < 320 readings removed."""
    ensure_utc(spark)
    d = daily.daily_energy(tables.readings(spark, sf_dir, house=True), min_readings=320)
    return d.select("meter_id", "ds", "y", "n")


def _meter_daily(spark, sf_dir):
    ensure_utc(spark)
    return daily.daily_series(tables.readings(spark, sf_dir), min_readings=2)


@register("daily_series", S.daily_series_sql(False, 2))
def q_daily_series(spark, sf_dir):
    """C2 + E4 + E5: per meter, days with < 2 readings removed, every day of the
    span re-created and gaps interpolated linearly in time."""
    return _meter_daily(spark, sf_dir).select("meter_id", "ds", "y")


@register("series_profile", f"""
    SELECT meter_id, count(*) AS days, min(ds) AS first_day, max(ds) AS last_day,
           list_reduce(list_sort(list(y)), lambda a, x: a + x) / count(*) AS mean_y, max(y) AS max_y
    FROM ({S.daily_series_sql(False, 2)}) GROUP BY meter_id""")
def q_series_profile(spark, sf_dir):
    """Days, span, mean and max daily kWh per series."""
    return daily.series_profile(_meter_daily(spark, sf_dir), exact=True)


# --- forecast: H1-H5 ---------------------------------------------------------------------------

FIXED = (0.3, 0.1, 0.2)


@register("forecast_fixed", S.holt_winters_sql(S.daily_series_sql(False, 2), *FIXED))
def q_forecast_fixed(spark, sf_dir):
    """H1-H5 with fixed (alpha, beta, gamma): 7 daily steps, band, clip at 0."""
    fits = fc.fit_fixed(_meter_daily(spark, sf_dir), *FIXED)
    out = fc.map_horizon(fc.forecast_band(fc.forecast(fits)))
    return out.select("meter_id", F.col("step").cast("bigint").alias("step"), "time", "yhat",
                      "yhat_lower", "yhat_upper")


@register("prediction_points", f"""
    SELECT meter_id, date_trunc('second', CAST(time AS TIMESTAMP)) AS time, yhat, yhat_lower,
           yhat_upper, CAST(time AS DATE) AS day
    FROM ({S.holt_winters_sql(S.daily_series_sql(False, 2), *FIXED)})""")
def q_prediction_points(spark, sf_dir):
    """The forecast written to the prediction point table (partitioned by
    day, under the shared checkpoint folder) and read back."""
    from meterflow.sources.sinks import write_predictions
    ensure_utc(spark)
    path = checkpoint_path(spark, "meterflow", f"predictions-{uuid.uuid4().hex}")
    write_predictions(q_forecast_fixed(spark, sf_dir), path, keys=["meter_id"])
    back = spark.read.parquet(path)
    return back.select("meter_id", ntz("time"), "yhat", "yhat_lower", "yhat_upper", "day")


@register("forecast", S.holt_winters_sql(S.daily_series_sql(False, 2)))
def q_forecast(spark, sf_dir):
    """H1-H5: parameters searched on a grid and refined, per meter."""
    fits = fc.fit_seasonal(_meter_daily(spark, sf_dir))
    out = fc.map_horizon(fc.forecast_band(fc.forecast(fits)))
    return out.select("meter_id", F.col("step").cast("bigint").alias("step"), "time", "yhat", "yhat_lower", "yhat_upper")


DEMO_NOW = "2024-02-01 12:34:56"


@register("demo_forecast", S.holt_winters_sql(S.daily_series_sql(False, 2), *FIXED, scale=1.5, now=DEMO_NOW))
def q_demo_forecast(spark, sf_dir):
    """H5 as the demo does it: step h stands for minute h after now, values scaled by 1.5."""
    fits = fc.fit_fixed(_meter_daily(spark, sf_dir), *FIXED)
    band = fc.forecast_band(fc.forecast(fits), scale=DEMO_SCALE)
    out = fc.map_horizon(band, now=DEMO_NOW, step="1 minute")
    return out.select("meter_id", F.col("step").cast("bigint").alias("step"), ntz("time"), "yhat",
                      "yhat_lower", "yhat_upper")


@register("lineitem_forecast", S.holt_winters_sql(S.daily_series_sql(False, 1, S.LINEITEM_SQL)))
def q_lineitem_forecast(spark, sf_dir):
    """H1-H5 on the long single series from lineitem (~2,500 days)."""
    ensure_utc(spark)
    d = daily.daily_series(tables.lineitem_readings(spark, sf_dir), min_readings=1)
    fits = fc.fit_seasonal(d)
    out = fc.map_horizon(fc.forecast_band(fc.forecast(fits)))
    return out.select("meter_id", F.col("step").cast("bigint").alias("step"), "time", "yhat", "yhat_lower", "yhat_upper")


# --- the stream job itself: I1-I4, A5/A7, B4, B5, D9, D10 ------------------------------------

STREAM_RUNS = 3


FILES = 8  # of each part, and at most so many are taken by a micro-batch


@register("stream_billing", S.power_usage_sql(True, "demo_slot"))
def q_stream_billing(spark, sf_dir):
    """The streaming job on the messages of ``events`` (single meter, 3-minute
    slots): the messages arrive in three time-ordered parts, and after each
    part the same query is restarted from its checkpoint and drained
    (``availableNow``). Returns the committed ``power_usage`` points; totals
    carried from commit to commit must give the batch result. Files go to the
    shared folder named by ``spark.checkpoint.dir``."""
    ensure_utc(spark)
    msgs = tables.messages_clean(tables.table(spark, sf_dir, "events"))
    root = _job_runs(spark, msgs, "stream_billing", _time_parts(msgs))
    pu = PointStore(spark, f"{root}/out").read("power_usage")
    return pu.select("meter_id", "tie", ntz("time"), "alert_level", "kw", dbl("kwh_cumulative"),
                     dbl("vnd_cumulative"), "sub1_pct", "sub2_pct", "sub3_pct", "suggestion",
                     "month_key")


def _job_runs(spark, msgs, name, parts, keep=("tie",), **job):
    """The ledger job over ``msgs``: a restart from one checkpoint for each part. Returns its folder."""
    from meterflow.streaming.billing import run_stream
    from meterflow.streaming.ledger import ledger_sink
    root = checkpoint_path(spark, "meterflow", f"{name}-{uuid.uuid4().hex}")
    for i, cond in enumerate(parts):
        # by hash, as a round robin would sort the rows first
        msgs.filter(cond).select(*keep, "value").repartition(FILES, *keep, "value").write.parquet(f"{root}/in/part={i}")
        src = (spark.readStream.schema(msgs.select(*keep, "value").schema).option("maxFilesPerTrigger", FILES)
               .parquet(f"{root}/in/part=*"))
        decoded = topic.decode_readings(src, keep=keep)
        if "meter_id" not in keep:
            decoded = decoded.withColumn("meter_id", F.lit(tables.HOUSE))
        run_stream(decoded, ledger_sink(f"{root}/out", "r1", **job), f"{root}/ckpt", "availableNow").awaitTermination()
    return root


@register("stream_job", f"""
    WITH r AS (SELECT r.* FROM ({S.readings_sql(True)}) r JOIN events e ON e.event_id = r.tie
               WHERE e.event_type NOT IN ('error', 'signup', 'click')),
    b AS (SELECT tie, CAST(sum(kwh) OVER (PARTITION BY {S.cycle_sql('demo_slot')} ORDER BY event_time, tie
                                          ROWS UNBOUNDED PRECEDING) AS DECIMAL(28,6)) AS cum FROM r)
    SELECT event_id AS tie, CASE event_type WHEN 'error' THEN 'json' WHEN 'signup' THEN 'time' WHEN 'click' THEN 'kw' END AS reject,
           CAST(cum AS DOUBLE) AS kwh, CAST({S.tier_sql('cum')} AS DOUBLE) AS vnd
    FROM events LEFT JOIN b ON b.tie = event_id""")
def q_stream_job(spark, sf_dir):
    """A7 + I8: bills and rejects of one job on messages with defects, committed batch by batch:
    every message is either billed or rejected with its reason."""
    ensure_utc(spark)
    events = tables.table(spark, sf_dir, "events")
    times = events.select(F.col("event_id").alias("tie"), F.col("ts").cast("timestamp").alias("event_time"))
    msgs = tables.messages_from_events(events).join(times, "tie")
    store = PointStore(spark, _job_runs(spark, msgs, "stream_job", _time_parts(msgs)) + "/out")
    bills = store.read("monthly_billing").select("tie", F.lit(None).cast("string").alias("reject"), dbl("kwh"), dbl("vnd"))
    bad = store.read("rejects", schema="tie long, reject string, part string, day date")
    return bills.unionByName(bad.select("tie", "reject"), allowMissingColumns=True)


CLOSE_DAYS = 30


@register("stream_months", f"""
    WITH r AS (SELECT *, {S.cycle_sql('calendar_month')} AS month_key,
                      CAST(date_trunc('month', event_time) + INTERVAL 1 MONTH AS TIMESTAMP) AS month_end FROM ({S.LINE_METERS_SQL})),
    b AS (SELECT min(epoch_us(event_time)) AS lo, max(epoch_us(event_time)) AS hi, max(event_time) - INTERVAL {CLOSE_DAYS} DAY AS mark FROM r),
    p AS (SELECT r.*, 3 * (epoch_us(event_time) - lo) >= hi - lo AND 3 * (epoch_us(event_time) - lo) < 2 * (hi - lo) AS late, mark FROM r, b)
    SELECT CASE WHEN late THEN 'late' ELSE 'closed' END AS kind, meter_id, month_key, CAST(sum(kwh) AS DOUBLE) AS kwh,
           CAST({S.tier_sql('sum(kwh)')} AS DOUBLE) AS vnd, CASE WHEN late THEN count(*) END AS readings
    FROM p WHERE month_end <= mark GROUP BY late, meter_id, month_key""")
def q_stream_months(spark, sf_dir):
    """I1 with closing months: years of readings in three parts, the middle one last. Months that ended
    30 days before the latest reading are closed with their final bill; readings that come later are kept as late."""
    ensure_utc(spark)
    msgs = topic.encode_readings(tables.line_meters(spark, sf_dir), keys=("meter_id", "tie", "event_time"))
    first, middle, last = _time_parts(msgs)
    root = _job_runs(spark, msgs, "stream_months", (first, last, middle), keep=("meter_id", "tie"), cycle="calendar_month",
                     close_after=dt.timedelta(days=CLOSE_DAYS), unit="month")
    store = PointStore(spark, f"{root}/out", "month")
    closed = store.read("closed").select(F.lit("closed").alias("kind"), "meter_id", "month_key", dbl("kwh"), dbl("vnd"),
                                         F.lit(None).cast("long").alias("readings"))
    late = store.read("late").groupBy("meter_id", "month_key").agg(F.sum("kwh").alias("kwh"), F.count("*").alias("readings"))
    return closed.unionByName(late.select(F.lit("late").alias("kind"), "meter_id", "month_key", dbl("kwh"),
                                          tier_cost("kwh", exact=True).cast("double").alias("vnd"), "readings"))


@register("stream_alert_feed", f"""
    SELECT tie, date_trunc('second', event_time) AS time, {S.level_sql()} AS alert_level, kw
    FROM ({S.readings_sql(True)}) WHERE kw >= 3""")
def q_stream_alert_feed(spark, sf_dir):
    """I7 + D9 + I2: the alert feed as an append stream over three restarts, the last under a processing-time
    trigger that takes two micro-batches; counts of each batch are observed."""
    return _alert_feed(spark, sf_dir)[0]


def _alert_feed(spark, sf_dir):
    """(the feed, [(run, batch, alerts, CRITICAL)] as observed)."""
    from meterflow.streaming import billing as sb
    ensure_utc(spark)
    root = checkpoint_path(spark, "meterflow", f"alert_feed-{uuid.uuid4().hex}")
    msgs = tables.messages_clean(tables.table(spark, sf_dir, "events"))
    observed = []
    for i, cond in enumerate(_time_parts(msgs)):
        msgs.filter(cond).select("tie", "value").repartition(FILES).write.parquet(f"{root}/in/part={i}")
        last = i == STREAM_RUNS - 1
        src = (spark.readStream.schema("tie long, value binary").option("maxFilesPerTrigger", FILES // 2 if last else FILES)
               .parquet(f"{root}/in/part=*"))
        good, _ = topic.split_rejects(topic.decode_readings(src, keep=("tie",)))
        feed = sb.alert_feed(good).select("tie", F.date_trunc("second", "event_time").alias("time"), "alert_level", "kw")
        out = feed.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt")
        q = (out.trigger(processingTime="1 second") if last else out.trigger(availableNow=True)).start()
        if last:
            q.processAllAvailable()
            q.stop()
        else:
            q.awaitTermination()
        observed += [(i, *r) for r in sb.observed_alerts(q)]
    return spark.read.parquet(f"{root}/out").select("tie", ntz("time"), "alert_level", "kw"), observed


# --- panels and merges on stored points: A7, A9, B21, D3, D6, E6 ------------------------------


def _stored(spark, points, name, batches=4):
    """A store with ``points`` committed in several batches by hash, then compacted."""
    store = PointStore(spark, checkpoint_path(spark, "meterflow", f"{name}-{uuid.uuid4().hex}"))
    entries = []
    for i in range(batches):
        entries += store.stage(points.filter(F.pmod(F.xxhash64("tie"), F.lit(batches)) == i), "points", f"b{i}")
    store.commit("load", entries)
    store.compact("points")
    return store


@register("stored_billing_latest", ORACLE["billing_latest"])
def q_stored_billing_latest(spark, sf_dir):
    """D3 + B21 on stored points: only the folders of the range's days are opened."""
    mb = billing.monthly_billing(_billed(spark, sf_dir, house=True))
    store = _stored(spark, mb, "stored_latest")
    return dashboard.latest(store.read("points", FROM_TS, TO_TS), ["vnd", "kwh"]).select(dbl("vnd"), dbl("kwh"))


@register("stored_kw_bucket_mean", ORACLE["kw_bucket_mean"])
def q_stored_kw_bucket_mean(spark, sf_dir):
    """D6 + E6 + B21 on stored points."""
    store = _stored(spark, _house_usage(spark, sf_dir), "stored_buckets")
    out = dashboard.bucket_mean(store.read("points", FROM_TS, TO_TS), ["kw"], "5 minutes", FROM_TS, TO_TS, exact=True)
    return out.select(ntz("bucket"), "mean_kw")


@register("stored_upsert", ORACLE["upsert_points"])
def q_stored_upsert(spark, sf_dir):
    """A9 on the store: a second write replaces points by copying the days it touches."""
    keys = ["meter_id", "time", "alert_level"]
    pu, again = _two_writes(spark, sf_dir)
    store = PointStore(spark, checkpoint_path(spark, "meterflow", f"stored_upsert-{uuid.uuid4().hex}"))
    store.merge("points", pu, keys, ["batch", "time", "tie"])
    store.merge("points", again, keys, ["batch", "time", "tie"])
    return store.read("points").select("meter_id", ntz("time"), "alert_level", "batch", "tie", "kw", dbl("kwh_cumulative"), dbl("vnd_cumulative"))


@register("stream_resumed", S.power_usage_sql(True, "demo_slot"))
def q_stream_resumed(spark, sf_dir):
    """I1 + I3 + I5 with operator state: a stream takes two parts of the messages and is dropped; the totals are
    read from its state store and start a new stream, with a checkpoint of its own, that takes the third."""
    from meterflow.functions import kwh as kwh_expr
    from meterflow.streaming import billing as sb
    ensure_utc(spark)
    root = checkpoint_path(spark, "meterflow", f"stream_resumed-{uuid.uuid4().hex}")
    msgs = tables.messages_clean(tables.table(spark, sf_dir, "events"))
    first, second, third = _time_parts(msgs)
    initial = None
    with _state_partitions(spark):
        for name, cond in (("a", first | second), ("b", third)):
            msgs.filter(cond).select("tie", "value").repartition(FILES).write.parquet(f"{root}/in-{name}")
            src = spark.readStream.schema("tie long, value binary").option("maxFilesPerTrigger", FILES).parquet(f"{root}/in-{name}")
            good, _ = topic.split_rejects(topic.decode_readings(src, keep=("tie",)))
            good = good.select(F.lit(tables.HOUSE).alias("meter_id"), "event_time", "tie", "kw", kwh_expr("kw", exact=True).alias("kwh"),
                               "sub1", "sub2", "sub3")
            billed = sb.billing_stream(good, cycle="demo_slot", exact=True, initial=initial)
            sb.run_stream(billed, sb.point_sink(f"{root}/out", name), f"{root}/ckpt-{name}", "availableNow").awaitTermination()
            initial = sb.state_totals(spark, f"{root}/ckpt-{name}", exact=True)
    pu = spark.read.parquet(f"{root}/out/power_usage")
    return pu.select("meter_id", "tie", ntz("time"), "alert_level", "kw", dbl("kwh_cumulative"), dbl("vnd_cumulative"),
                     "sub1_pct", "sub2_pct", "sub3_pct", "suggestion", "month_key")


@contextlib.contextmanager
def _state_partitions(spark):
    """The state of a stream is partitioned once, at its first start, by
    spark.sql.shuffle.partitions: size it to the cluster, not to the
    session's batch default, and restore the setting afterwards."""
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)


def _time_parts(msgs):
    """STREAM_RUNS time-ordered, disjoint predicates over ``event_time`` (one
    bounded aggregate, two rows to the driver)."""
    lo, hi = msgs.agg(F.min("event_time"), F.max("event_time")).first()
    span = (hi - lo) / STREAM_RUNS
    bounds = [lo + span * i for i in range(1, STREAM_RUNS)]
    t = F.col("event_time")
    return [t < F.lit(bounds[0])] + [
        (t >= F.lit(a)) & (t < F.lit(b)) for a, b in zip(bounds, bounds[1:])] + [
        t >= F.lit(bounds[-1])]


LIVE_INTERVAL = "5 minutes"


@register("live_mean_stream", f"""
    SELECT meter_id, time_bucket(INTERVAL '{LIVE_INTERVAL}', event_time) AS bucket,
           CAST(sum(CAST(kw AS DECIMAL(28,6))) AS DOUBLE) / count(kw) AS mean_kw, count(*) AS points
    FROM ({S.readings_sql(True)}) GROUP BY ALL""")
def q_live_mean_stream(spark, sf_dir):
    """I6 in Structured Streaming: the messages of ``events`` arrive in three parts
    (the middle one last, so late); after each part the window aggregation is
    restarted from its checkpoint and drained. Every batch writes the windows
    it changed; the result is the last value of all windows, the open one too."""
    from meterflow.streaming import billing as sb
    ensure_utc(spark)
    root = checkpoint_path(spark, "meterflow", f"live_mean-{uuid.uuid4().hex}")
    msgs = tables.messages_clean(tables.table(spark, sf_dir, "events"))
    first, middle, last = _time_parts(msgs)
    for i, cond in enumerate((first, last, middle)):
        msgs.filter(cond).select("tie", "value").write.mode("overwrite").parquet(
            f"{root}/in/part={i}")
        src = spark.readStream.schema("tie long, value binary").parquet(f"{root}/in/part=*")
        good, _ = topic.split_rejects(topic.decode_readings(src))
        good = good.withColumn("meter_id", F.lit(tables.HOUSE))
        with _state_partitions(spark):
            q = (sb.live_mean(good, LIVE_INTERVAL, keys=("meter_id",), exact=True)
                 .writeStream.outputMode("update").foreachBatch(sb.window_sink(f"{root}/out"))
                 .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
            q.awaitTermination()
    out = sb.current_windows(spark, f"{root}/out", keys=["meter_id"])
    return out.select("meter_id", ntz("bucket"), "mean_kw", "points")


@register("stream_rejects", """
    SELECT event_id AS tie, CASE event_type WHEN 'error' THEN 'json' WHEN 'signup' THEN 'time'
                                 ELSE 'kw' END AS reject
    FROM events WHERE event_type IN ('error', 'signup', 'click')""")
def q_stream_rejects(spark, sf_dir):
    """I8 in the stream: the bad messages of ``events`` go to the rejects table, batch by batch."""
    from meterflow.streaming import billing as sb
    ensure_utc(spark)
    root = checkpoint_path(spark, "meterflow", f"rejects-{uuid.uuid4().hex}")
    tables.messages_from_events(tables.table(spark, sf_dir, "events")).write.parquet(f"{root}/in")
    src = spark.readStream.schema("tie long, value binary").option("maxFilesPerTrigger", 8).parquet(f"{root}/in")
    _, bad = topic.split_rejects(topic.decode_readings(src, keep=("tie",)))
    q = sb.run_stream(bad, sb.reject_sink(f"{root}/out", "r1"), f"{root}/ckpt", "availableNow")
    q.awaitTermination()
    return spark.read.parquet(f"{root}/out/rejects").select("tie", "reject")


@register("file_readings", f"""
    WITH f AS ({S.fields_sql()})
    SELECT 'house' AS meter_id, event_time, kw, kw * 1.5::DOUBLE AS kwh, sub1, sub2, sub3 FROM (
    SELECT event_time, round(TRY_CAST(kwt AS DOUBLE), 4) AS kw,
           round(CASE WHEN s1t IS NULL OR s1t = '' THEN 0.0::DOUBLE ELSE TRY_CAST(s1t AS DOUBLE) END, 2) AS sub1,
           round(CASE WHEN s2t IS NULL OR s2t = '' THEN 0.0::DOUBLE ELSE TRY_CAST(s2t AS DOUBLE) END, 2) AS sub2,
           round(CASE WHEN s3t IS NULL OR s3t = '' THEN 0.0::DOUBLE ELSE TRY_CAST(s3t AS DOUBLE) END, 2) AS sub3
    FROM f
    WHERE length(line) > 0 AND line NOT LIKE '%?%' AND dia IS NOT NULL
      AND np >= CASE WHEN dia = 'txt' THEN 3 ELSE 2 END AND NOT header
      AND TRY_CAST(kwt AS DOUBLE) IS NOT NULL
      AND (s1t IS NULL OR s1t = '' OR TRY_CAST(s1t AS DOUBLE) IS NOT NULL)
      AND (s2t IS NULL OR s2t = '' OR TRY_CAST(s2t AS DOUBLE) IS NOT NULL)
      AND (s3t IS NULL OR s3t = '' OR TRY_CAST(s3t AS DOUBLE) IS NOT NULL))""")
def q_file_readings(spark, sf_dir):
    """A1-A3 + A10: meter files of both dialects, with header lines, written and read back as readings."""
    from meterflow.schemas import CSV_HEADER, TXT_HEADER
    ensure_utc(spark)
    root = checkpoint_path(spark, "meterflow", f"files-{uuid.uuid4().hex}")
    lines = tables.meter_lines_from_events(tables.table(spark, sf_dir, "events")).select("value")
    for name, header, mine in (("txt", TXT_HEADER, F.contains("value", F.lit(";"))), ("csv", CSV_HEADER, ~F.contains("value", F.lit(";")))):
        # the header is the first line of every file: the only column is named so, with a separator and quote that no line has
        (lines.filter(mine).select(F.col("value").alias(header)).write.option("header", True).option("sep", "\x01")
         .option("quote", "\x00").csv(f"{root}/{name}"))
    out = files.load_readings(spark, f"{root}/*", dialect="header")
    return out.select("meter_id", ntz("event_time"), "kw", "kwh", "sub1", "sub2", "sub3")



@register("alert_feed", f"""
    SELECT tie, date_trunc('second', event_time) AS time, {S.level_sql()} AS alert_level, kw
    FROM ({S.readings_sql(True)}) WHERE kw >= 3""")
def q_alert_feed(spark, sf_dir):
    """I7 (batch twin): every WARNING and CRITICAL reading."""
    from meterflow.streaming.billing import alert_stream
    ensure_utc(spark)
    a = alert_stream(tables.readings(spark, sf_dir, house=True))
    return a.select("tie", F.date_trunc("second", "event_time").cast("timestamp_ntz")
                    .alias("time"), "alert_level", "kw")


FC_FROM, FC_TO = "2024-01-25 00:00:00", "2024-02-10 00:00:00"


@register("forecast_buckets", f"""
    WITH p AS ({S.holt_winters_sql(S.daily_series_sql(False, 2), *FIXED)}),
    pts AS (SELECT meter_id, CAST(time AS TIMESTAMP) AS time, yhat, yhat_lower, yhat_upper FROM p
            WHERE CAST(time AS TIMESTAMP) >= TIMESTAMP '{FC_FROM}' AND CAST(time AS TIMESTAMP) <= TIMESTAMP '{FC_TO}'),
    agg AS (SELECT meter_id, time_bucket(INTERVAL '12 hours', time) AS bucket, avg(yhat) AS mean_yhat,
                   avg(yhat_lower) AS mean_yhat_lower, avg(yhat_upper) AS mean_yhat_upper
            FROM pts GROUP BY ALL),
    spine AS (SELECT meter_id, unnest(generate_series(TIMESTAMP '{FC_FROM}', TIMESTAMP '{FC_TO}',
                                                      INTERVAL '12 hours')) AS bucket
              FROM (SELECT DISTINCT meter_id FROM pts)),
    f0 AS (SELECT s.meter_id, s.bucket, a.mean_yhat, a.mean_yhat_lower, a.mean_yhat_upper
           FROM spine s LEFT JOIN agg a ON a.meter_id = s.meter_id AND a.bucket = s.bucket),
    f1 AS {S.interp_sql('f0', 'meter_id', 'bucket', 'epoch(bucket)', 'mean_yhat')},
    f2 AS {S.interp_sql('f1', 'meter_id', 'bucket', 'epoch(bucket)', 'mean_yhat_lower')},
    f3 AS {S.interp_sql('f2', 'meter_id', 'bucket', 'epoch(bucket)', 'mean_yhat_upper')}
    SELECT meter_id, bucket, mean_yhat, mean_yhat_lower, mean_yhat_upper FROM f3""")
def q_forecast_buckets(spark, sf_dir):
    """D7 + E7: mean of forecast, lower and upper per 12-hour bucket, fill(linear)."""
    fits = fc.fit_fixed(_meter_daily(spark, sf_dir), *FIXED)
    pred = fc.map_horizon(fc.forecast_band(fc.forecast(fits))).withColumn(
        "time", F.col("time").cast("timestamp"))
    out = dashboard.bucket_mean(pred, ["yhat", "yhat_lower", "yhat_upper"], "12 hours", FC_FROM,
                                FC_TO, keys=["meter_id"], fill="linear")
    return out.select("meter_id", ntz("bucket"), "mean_yhat", "mean_yhat_lower",
                      "mean_yhat_upper")
