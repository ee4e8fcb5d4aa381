"""Daily series and forecast: FIXTURES X6 edges and a numpy brute force."""
import datetime as dt
import itertools

import numpy as np
import pytest
from meterflow.operators import daily
from meterflow.operators import forecast as fc

D0 = dt.date(2024, 1, 1)


def _readings(spark, per_day: dict):
    rows = []
    for day, n in per_day.items():
        for i in range(n):
            rows.append(("m", dt.datetime.combine(D0 + dt.timedelta(days=day), dt.time()) +
                         dt.timedelta(minutes=i), 0.6))
    return spark.createDataFrame(rows, "meter_id string, event_time timestamp, kw double")


def test_min_readings_filter(spark):
    d = daily.daily_energy(_readings(spark, {0: 599, 1: 600}), min_readings=600).collect()
    assert [(r["ds"], r["n"]) for r in d] == [(D0 + dt.timedelta(days=1), 600)]
    assert d[0]["y"] == pytest.approx(600 * 0.6 / 60)


def test_densify_and_interpolate(spark):
    rows = [("m", D0 + dt.timedelta(days=0), 10.0), ("m", D0 + dt.timedelta(days=3), 16.0)]
    df = spark.createDataFrame(rows, "meter_id string, ds date, y double")
    out = daily.interpolate_time(daily.densify_daily(df)).orderBy("ds").collect()
    assert [r["y"] for r in out] == [10.0, 12.0, 14.0, 16.0]


def test_thin_day_removed_then_interpolated(spark):
    per_day = {0: 5, 1: 1, 2: 5}
    out = daily.daily_series(_readings(spark, per_day), min_readings=2).orderBy("ds").collect()
    ys = [r["y"] for r in out]
    assert len(ys) == 3 and ys[1] == pytest.approx((ys[0] + ys[2]) / 2)


def np_fit(y, a, b, g, m=7):
    y = np.asarray(y, dtype=float)
    l = sum(y[:m]) / m
    t = (sum(y[m:2 * m]) / m - l) / m
    s = list(y[:m] - l)
    sse, e_all = 0.0, []
    for x in y:
        e = x - (l + t + s[0])
        l1 = a * (x - s[0]) + (1 - a) * (l + t)
        t1 = b * (l1 - l) + (1 - b) * t
        s1 = g * (x - l - t) + (1 - g) * s[0]
        s = s[1:] + [s1]
        l, t = l1, t1
        sse += e * e
        e_all.append(e)
    return l, t, s, sse, float(np.std(e_all, ddof=1))


def _series(spark, ys, meter="m"):
    rows = [(meter, D0 + dt.timedelta(days=i), float(v)) for i, v in enumerate(ys)]
    return spark.createDataFrame(rows, "meter_id string, ds date, y double")


def test_fixed_fit_matches_numpy(spark):
    rng = np.random.default_rng(7)
    ys = 20 + 5 * np.sin(np.arange(60) * 2 * np.pi / 7) + rng.normal(0, 1, 60)
    fit = fc.fit_fixed(_series(spark, ys), 0.3, 0.1, 0.2).collect()[0]
    l, t, s, sse, sd = np_fit(ys, 0.3, 0.1, 0.2)
    assert fit["level"] == pytest.approx(l, rel=1e-12)
    assert fit["trend"] == pytest.approx(t, rel=1e-9, abs=1e-12)
    assert fit["sse"] == pytest.approx(sse, rel=1e-12)
    assert fit["sigma"] == pytest.approx(sd, rel=1e-9)
    assert fit["season"] == pytest.approx(s, rel=1e-9)


def test_grid_picks_least_sse(spark):
    rng = np.random.default_rng(3)
    ys = 50 + np.arange(40) * 0.5 + 4 * np.cos(np.arange(40) * 2 * np.pi / 7) + rng.normal(0, 2, 40)
    vals = (0.1, 0.5, 0.9)
    grid = list(itertools.product(vals, vals, vals))
    fit = fc.fit_seasonal(_series(spark, ys), grid=grid, refine=False).collect()[0]
    best = min(grid, key=lambda p: np_fit(ys, *p)[3])
    assert (fit["alpha"], fit["beta"], fit["gamma"]) == best


def test_short_series_has_no_forecast(spark):
    fits = fc.fit_seasonal(_series(spark, range(13)), grid=[(0.3, 0.1, 0.2)], refine=False)
    r = fits.collect()[0]
    assert r["reason"] == "too_short"
    assert fc.forecast(fits).count() == 0


def test_weekly_pattern_repeats(spark):
    week = [5, 7, 9, 11, 9, 7, 5]
    fits = fc.fit_fixed(_series(spark, week * 6), 0.3, 0.1, 0.2)
    out = fc.forecast_band(fc.forecast(fits), scale=1.0).orderBy("step").collect()
    assert [r["yhat"] for r in out] == pytest.approx(week, abs=1e-9)
    assert out[0]["yhat_upper"] - out[0]["yhat"] == pytest.approx(0.0, abs=1e-9)


def test_falling_trend_clipped(spark):
    ys = [100 - 8 * i for i in range(21)]
    fits = fc.fit_fixed(_series(spark, ys), 0.5, 0.5, 0.1)
    out = fc.map_horizon(fc.forecast_band(fc.forecast(fits))).orderBy("step").collect()
    assert all(r["yhat"] >= 0 and r["yhat_lower"] >= 0 for r in out)
    assert out[-1]["yhat"] == 0.0 and out[-1]["yhat_upper"] < 0  # upper is not clipped
    assert out[0]["time"] == D0 + dt.timedelta(days=21)


def test_horizon_minutes(spark):
    fits = fc.fit_fixed(_series(spark, [1.0] * 14), 0.3, 0.1, 0.2)
    out = fc.map_horizon(fc.forecast(fits), now="2024-05-01 10:20:37", step="1 minute")
    times = sorted(r["time"] for r in out.collect())
    assert times[0] == dt.datetime(2024, 5, 1, 10, 21) and times[-1] == dt.datetime(2024, 5, 1, 10, 27)


def test_write_predictions(spark, scratch):
    from meterflow.sources.sinks import write_predictions
    fits = fc.fit_fixed(_series(spark, [float(i % 7) for i in range(21)]), 0.3, 0.1, 0.2)
    pred = fc.map_horizon(fc.forecast_band(fc.forecast(fits)), now="2024-05-01 10:20:37",
                          step="1 minute")
    write_predictions(pred, scratch + "/pred", keys=["meter_id"])
    back = spark.read.parquet(scratch + "/pred")
    assert back.count() == 7
    assert set(back.columns) == {"meter_id", "time", "yhat", "yhat_lower", "yhat_upper", "day"}


def test_search_folds_all_points_in_the_row_of_a_series(spark):
    daily = _series(spark, [float((i * 7919) % 23) for i in range(40)])
    fit = fc.fit_seasonal(daily).first()
    fixed = {p: fc.fit_fixed(daily, *p).first().sse for p in [(fit.alpha, fit.beta, fit.gamma), (0.1, 0.1, 0.1), (0.5, 0.3, 0.7)]}
    assert fixed[fit.alpha, fit.beta, fit.gamma] == fit.sse == min(fixed.values())
    plan = fc.fit_seasonal(daily)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "explode" not in plan


def test_short_series_beside_long_ones(spark):
    rows = [("a", dt.date(2024, 1, 1) + dt.timedelta(days=i), float(i % 7)) for i in range(20)] + [("b", dt.date(2024, 1, 1), 1.0)]
    fits = {r.meter_id: r for r in fc.fit_seasonal(spark.createDataFrame(rows, "meter_id string, ds date, y double")).collect()}
    assert fits["a"].reason is None and len(fits["a"].season) == 7
    assert fits["b"].reason == "too_short" and fits["b"].alpha is None and fits["b"].season is None and fits["b"].n == 1
