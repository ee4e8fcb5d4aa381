"""Property checks with random inputs."""
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.functions import tier_cost
from meterflow.operators import daily
from meterflow.operators import forecast as fc
from tests.test_functions import py_cost

D0 = dt.date(2024, 1, 1)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.floats(min_value=-10, max_value=2000, allow_nan=False), min_size=1,
                max_size=200))
def test_tier_cost_equals_python_fold(spark, vals):
    df = spark.createDataFrame([(float(v),) for v in vals], "kwh double")
    got = [r[0] for r in df.select(tier_cost("kwh")).collect()]
    assert got == [py_cost(v) for v in vals]


@settings(max_examples=4, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(min_value=0, max_value=100)), min_size=3,
                max_size=40))
def test_interpolation_keeps_known_points(spark, ys):
    rows = [("m", D0 + dt.timedelta(days=i), None if y is None else float(y))
            for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "meter_id string, ds date, y double")
    out = {r["ds"]: r["y"] for r in daily.interpolate_time(df).collect()}
    known = [(d, y) for (_, d, y) in rows if y is not None]
    assert all(out[d] == y for d, y in known)
    if known:  # interior gaps are filled, and stay between their neighbours
        lo, hi = known[0][0], known[-1][0]
        for (_, d, y) in rows:
            if lo < d < hi:
                assert out[d] is not None
                assert min(v for _, v in known) - 1e-9 <= out[d] <= max(v for _, v in known) + 1e-9


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(min_value=0, max_value=50), min_size=14, max_size=40),
       st.sampled_from([(0.3, 0.1, 0.2), (0.9, 0.5, 0.1), (0.1, 0.9, 0.9)]))
def test_band_ordering(spark, ys, params):
    rows = [("m", D0 + dt.timedelta(days=i), float(y)) for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "meter_id string, ds date, y double")
    out = fc.forecast_band(fc.forecast(fc.fit_fixed(df, *params))).collect()
    assert len(out) == 7
    for r in out:
        assert r["yhat_lower"] <= r["yhat"] <= max(r["yhat_upper"], 0.0) + 1e-9
        assert r["yhat"] >= 0 and r["yhat_lower"] >= 0
