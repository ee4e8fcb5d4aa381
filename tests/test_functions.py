"""Column functions: tariff goldens, alert and share edges, cycle keys."""
import math

import pytest
from pyspark.sql import functions as F

from meterflow.functions import (alert_level, cycle_key, kwh, load_band, month_bounds, sub_share,
                                 suggestion, tier_cost)
from meterflow.functions.tariff import register_tier_cost
from meterflow.schemas import SUGGESTIONS, TIERS

# Hand-computed goldens (half-even rounding of the currency amount).
GOLDEN = [(-1, 0), (0, 0), (0.5, 946), (1.5, 2840), (100, 189300), (200, 416400),
          (400, 988400), (700, 2010500), (800, 2389100)]


def py_cost(k):
    if k <= 0:
        return 0.0
    total, lo = 0.0, 0
    for hi, price in TIERS:
        part = min(k, hi) - lo
        if part <= 0:
            break
        total += part * price
        lo = hi
    return float(round(total, 0))


def test_tier_cost_goldens_double(spark):
    df = spark.createDataFrame([(float(k),) for k, _ in GOLDEN], "kwh double")
    got = [r[0] for r in df.select(tier_cost("kwh")).collect()]
    assert got == [float(c) for _, c in GOLDEN]


def test_tier_cost_goldens_decimal(spark):
    df = spark.createDataFrame([(str(k),) for k, _ in GOLDEN], "s string").select(
        F.col("s").cast("decimal(20,6)").alias("kwh"))
    got = [int(r[0]) for r in df.select(tier_cost("kwh", exact=True)).collect()]
    assert got == [c for _, c in GOLDEN]


def test_tier_cost_nan_null_and_python_twin(spark):
    vals = [None, float("nan")] + [i * 7.3 for i in range(150)]
    df = spark.createDataFrame([(v,) for v in vals], "kwh double")
    got = [r[0] for r in df.select(tier_cost("kwh")).collect()]
    assert got[0] is None and math.isnan(got[1])
    assert got[2:] == [py_cost(v) for v in vals[2:]]


def test_tier_cost_monotone_and_continuous(spark):
    edges = [lim for lim, _ in TIERS if not math.isinf(lim)]
    pts = sorted({x for e in edges for x in (e - 1e-6, e, e + 1e-6)} | {i * 3.0 for i in range(300)})
    df = spark.createDataFrame([(float(p),) for p in pts], "kwh double")
    got = [r[0] for r in df.select(tier_cost("kwh")).collect()]
    assert all(a <= b for a, b in zip(got, got[1:]))
    for e in edges:
        i = pts.index(e)
        assert abs(got[i + 1] - got[i - 1]) <= 1


def test_sql_function_equals_column(spark):
    register_tier_cost(spark)
    df = spark.createDataFrame([(float(k),) for k, _ in GOLDEN], "kwh double")
    df.createOrReplaceTempView("k")
    got = [r[0] for r in spark.sql("SELECT tier_cost(kwh) FROM k").collect()]
    assert got == [float(c) for _, c in GOLDEN]


def test_alert_edges(spark):
    rows = [(2.999,), (3.0,), (3.999,), (4.0,), (float("nan"),), (None,)]
    df = spark.createDataFrame(rows, "kw double")
    got = [(r[0], r[1]) for r in df.select(alert_level("kw"), suggestion(alert_level("kw"))).collect()]
    assert [g[0] for g in got] == ["INFO", "WARNING", "WARNING", "CRITICAL", "CRITICAL", None]
    assert got[0][1] == SUGGESTIONS["INFO"] and got[3][1] == SUGGESTIONS["CRITICAL"]


def test_share_edges(spark):
    rows = [(0.0, 5.0), (0.6, 5.0), (0.6, 20.0), (0.6, None), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "kw double, sub double")
    got = [r[0] for r in df.select(sub_share("sub", "kw")).collect()]
    assert got[0] == 0.0
    assert got[1] == pytest.approx(50.0)
    assert got[2] == pytest.approx(200.0)  # not capped
    assert got[3] == 0.0
    assert got[4] == 0.0  # reference: NaN > 0 is false -> 0


def test_cycle_keys_and_month_bounds(spark):
    rows = [("2024-01-01 00:02:59",), ("2024-01-01 00:03:00",), ("2024-12-15 23:59:00",)]
    df = spark.createDataFrame(rows, "s string").select(F.col("s").cast("timestamp").alias("t"))
    lo, hi = month_bounds("t")
    got = df.select(cycle_key("t", "demo_slot"), cycle_key("t", "calendar_month"),
                    lo.cast("string"), hi.cast("string")).collect()
    assert [r[0] for r in got] == ["demo-0-0", "demo-0-1", "demo-23-19"]
    assert [r[1] for r in got] == ["2024-01", "2024-01", "2024-12"]
    assert got[2][2] == "2024-12-01 00:00:00" and got[2][3] == "2025-01-01 00:00:00"


def test_kwh_and_gauge(spark):
    df = spark.createDataFrame([(2.0,), (9.0,), (12.0,), (-1.0,)], "kw double")
    got = df.select(kwh("kw"), kwh("kw", exact=True).cast("double"), load_band("kw")).collect()
    assert got[0][0] == 3.0 and got[0][1] == 3.0
    assert [r[2]["band"] for r in got] == ["green", "red", "red", "green"]
    assert [r[2]["gauge_pct"] for r in got] == [20.0, 90.0, 100.0, 0.0]
