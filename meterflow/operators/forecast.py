"""Additive trend + additive seasonal exponential smoothing per
series, h-step forecast, residual band, horizon mapping.

Each series (one row per day after the gap fill) becomes one array row:
its size is bounded by the days in its span, not by the raw data volume.
The recurrence runs as a Spark higher-order ``aggregate`` over that array,
with no Python involved, and the search folds all parameter sets at once. Parameters are chosen by least squared one-step
error: every point of a coarse grid, then ever closer neighbours of the best
one, down to a step of 0.00625 and including 0 and 1. Fits with given and
with searched parameters come from the same expression.

Recurrence (period m, s0 = season of the current step, rotated each step):
    yhat = l + b + s0;  e = y - yhat
    l' = a (y - s0) + (1 - a)(l + b)
    b' = c (l' - l) + (1 - c) b                (c = beta)
    s' = g (y - l - b) + (1 - g) s0            (g = gamma)
Start state: l = mean of the first m points, b = (mean of the next m - l)/m,
s_i = y_i - l. The residual spread (sample std, n - 1) is kept with
Welford's update in the same fold.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions import clip0
from meterflow.schemas import BAND_Z, HORIZON, SEASON

GRID_VALUES = (0.1, 0.3, 0.5, 0.7, 0.9)
REFINE_STEPS = (0.1, 0.05, 0.025, 0.0125, 0.00625)


def default_grid(values=GRID_VALUES):
    return [(a, b, g) for a, b, g in itertools.product(values, values, values)]


def to_series(daily: DataFrame, keys=("meter_id",), ds: str = "ds", y: str = "y") -> DataFrame:
    """one row per series: days in order (``array_sort`` of (ds, y) pairs)."""
    keys = list(keys)
    pts = F.array_sort(F.collect_list(F.struct(F.col(ds).alias("ds"), F.col(y).alias("y"))))
    return (daily.groupBy(*keys).agg(pts.alias("_pts"))
            .select(*keys, F.transform("_pts", lambda p: p["y"]).alias("y"),
                    F.element_at("_pts", -1)["ds"].alias("last_ds"),
                    F.size("_pts").alias("n")))


def _start_sql(y: str, m: int) -> str:
    """The start state (fields l, b, s0 ..) as a SQL struct."""
    def total(lo: int, hi: int) -> str:
        return f"aggregate(slice({y}, {lo}, {hi - lo + 1}), 0.0D, (acc, v) -> acc + v)"

    l0 = f"({total(1, m)} / {float(m)}D)"
    b0 = f"(({total(m + 1, 2 * m)} / {float(m)}D - {l0}) / {float(m)}D)"
    return f"named_struct('l', {l0}, 'b', {b0}, " + ", ".join(f"'s{i}', element_at({y}, {i + 1}) - {l0}" for i in range(m)) + ")"


def _step_sql(a: str, c: str, g: str, m: int, *more: str) -> str:
    """The state ``st`` after the value ``x``, with ``more`` fields. The season is
    kept as m scalar fields rotated by name, so a step allocates no array."""
    l1 = f"({a} * (x - st.s0) + (1.0D - {a}) * (st.l + st.b))"
    b1 = f"({c} * ({l1} - st.l) + (1.0D - {c}) * st.b)"
    s_new = f"({g} * (x - st.l - st.b) + (1.0D - {g}) * st.s0)"
    rot = [f"'s{i}', st.s{i + 1}" for i in range(m - 1)] + [f"'s{m - 1}', {s_new}"]
    return f"named_struct({', '.join([*more[:1], f"'l', {l1}", f"'b', {b1}", *rot, *more[1:]])})"


ERROR = "(x - (st.l + st.b + st.s0))"


def _fold(y: str, a: str, c: str, g: str, m: int) -> Column:
    """The smoothing recurrence over the whole series; returns the final state.

    Written as SQL text so the plan is built in one call (a Column tree of
    this size costs thousands of driver round trips to assemble).
    """
    fields = ", ".join(f"'{f}', z.{f}" for f in ["l", "b", *(f"s{i}" for i in range(m))])
    init = (f"element_at(transform(array({_start_sql(y, m)}), z -> named_struct('sse', 0.0D, {fields}, "
            "'k', 0L, 'mean', 0.0D, 'm2', 0.0D)), 1)")
    d = f"({ERROR} - st.mean)"
    mean1 = f"(st.mean + {d} / (st.k + 1))"
    step = _step_sql(a, c, g, m, f"'sse', st.sse + {ERROR} * {ERROR}", "'k', st.k + 1", f"'mean', {mean1}", f"'m2', st.m2 + {d} * ({ERROR} - {mean1})")
    return F.expr(f"aggregate({y}, {init}, (st, x) -> {step})")


def _season(st: str, m: int) -> Column:
    return F.array(*[F.col(f"{st}.s{i}") for i in range(m)])


def _neighbours(axis: str, step: float) -> str:
    """SQL for the values of one parameter around ``p.axis`` that stay within [0, 1]."""
    return (f"filter(array(round(p.{axis} - {step}D, 6), p.{axis}, round(p.{axis} + {step}D, 6)), "
            "v -> v >= 0 and v <= 1)")


def searched(y: str, m: int, grid, refine: bool) -> Column:
    """(sse, alpha, beta, gamma) of least one-step squared error; ties go to the smaller.

    One fold carries the states of all parameter sets, so the series is read
    once for the grid and once for each of REFINE_STEPS, all within its row:
    nothing is copied, joined or shuffled.
    """
    fields = ", ".join(f"'{f}', z.{f}" for f in ["l", "b", *(f"s{i}" for i in range(m))])
    step = _step_sql("st.alpha", "st.beta", "st.gamma", m, f"'sse', st.sse + {ERROR} * {ERROR}, 'alpha', st.alpha, 'beta', st.beta, 'gamma', st.gamma")

    def best(cube: str) -> str:
        init = f"transform({cube}, q -> named_struct('sse', 0.0D, 'alpha', q.alpha, 'beta', q.beta, 'gamma', q.gamma, {fields}))"
        least = "array_min(transform(states, s -> named_struct('sse', s.sse, 'alpha', s.alpha, 'beta', s.beta, 'gamma', s.gamma)))"
        return f"aggregate({y}, {init}, (states, x) -> transform(states, st -> {step}), states -> {least})"

    points = ", ".join("named_struct('alpha', {}D, 'beta', {}D, 'gamma', {}D)".format(*map(float, p)) for p in grid)
    found = best(f"array({points})")
    for size in REFINE_STEPS if refine else ():
        axes = {x: _neighbours(x, size) for x in ("alpha", "beta", "gamma")}
        cube = (f"flatten(flatten(transform({axes['alpha']}, a -> transform({axes['beta']}, b -> transform({axes['gamma']}, "
                "g -> named_struct('alpha', a, 'beta', b, 'gamma', g))))))")
        found = f"element_at(transform(array({found}), p -> {best(cube)}), 1)"
    return F.expr(f"element_at(transform(array({_start_sql(y, m)}), z -> {found}), 1)")


def fit_seasonal(daily: DataFrame, keys=("meter_id",), period: int = SEASON, grid=None,
                 refine: bool = True, ds: str = "ds", y: str = "y") -> DataFrame:
    """H1 + H3: fitted parameters, final state and residual sigma per series.

    Series shorter than two seasons get no fit (``reason`` = 'too_short').
    Output: keys, alpha, beta, gamma, sse, level, trend, season, sigma, n, last_ds, reason.
    """
    keys = list(keys)
    series = to_series(daily, keys, ds, y)
    enough = F.col("n") >= 2 * period
    grid = grid or default_grid()
    if len(grid) == 1 and not refine:
        params = F.struct(*(F.lit(float(v)).alias(c) for v, c in zip(grid[0], ("alpha", "beta", "gamma"), strict=True)))
    else:
        params = searched("y", period, grid, refine)
        # Few bytes but much work: AQE would merge the series into one task. Each moves once, to a stated
        # number of partitions (by a hash of the keys, as a plain one would be dropped as redundant).
        parts = int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        series = series.repartition(parts, F.xxhash64(*keys) if keys else F.lit(0))
    chosen = series.select(*keys, "y", "last_ds", "n", F.when(enough, params).alias("p"))
    fits = chosen.select(*keys, "last_ds", "n", "p", F.when(enough, _fold("y", "p.alpha", "p.beta", "p.gamma", period)).alias("st"))
    return fits.select(
        *keys, "p.alpha", "p.beta", "p.gamma", F.col("st.sse").alias("sse"), F.col("st.l").alias("level"), F.col("st.b").alias("trend"),
        F.when(enough, _season("st", period)).alias("season"), F.sqrt(F.col("st.m2") / (F.col("st.k") - F.lit(1))).alias("sigma"),
        "n", "last_ds", F.when(~enough, F.lit("too_short")).alias("reason"))


def fit_fixed(daily: DataFrame, alpha: float, beta: float, gamma: float, keys=("meter_id",),
              period: int = SEASON, ds: str = "ds", y: str = "y") -> DataFrame:
    """H1 with given parameters (no search)."""
    return fit_seasonal(daily, keys, period, grid=[(alpha, beta, gamma)], refine=False, ds=ds, y=y)


def forecast(fits: DataFrame, keys=("meter_id",), horizon: int = HORIZON,
             period: int = SEASON) -> DataFrame:
    """H2: yhat_h = level + h * trend + season[(h - 1) mod period], h = 1..horizon."""
    keys = list(keys)
    steps = F.sequence(F.lit(1), F.lit(horizon))
    vals = F.transform(steps, lambda h: F.struct(
        h.alias("step"),
        (F.col("level") + h.cast("double") * F.col("trend")
         + F.element_at("season", F.pmod(h - 1, F.lit(period)) + 1)).alias("yhat")))
    return (fits.filter(F.col("reason").isNull())
            .select(*keys, "sigma", "last_ds", F.explode(vals).alias("f"))
            .select(*keys, "f.step", "f.yhat", "sigma", "last_ds"))


def forecast_band(fc: DataFrame, z: float = BAND_Z, scale: float = 1.0) -> DataFrame:
    """H4 + B18: scale (DEMO_SCALE goes with the minute mapping, 1 with the daily one), band yhat +- z * sigma; clip yhat and lower at 0 (upper is not clipped)."""
    ys = F.col("yhat") * F.lit(float(scale))
    ss = F.col("sigma") * F.lit(float(scale))
    return fc.withColumns({
        "yhat_lower": clip0(ys - F.lit(float(z)) * ss),
        "yhat_upper": ys + F.lit(float(z)) * ss,
        "yhat": clip0(ys),
    })


def map_horizon(fc: DataFrame, now=None, step: str = "1 day") -> DataFrame:
    """H5: step h to a time. ``now`` given: truncate to the minute and add h
    steps (the demo maps a day to a minute); else the series' last day + h days."""
    if now is not None:
        base = F.date_trunc("minute", F.lit(now).cast("timestamp"))
        return fc.withColumn("time", base + F.make_interval(
            mins=F.col("step") if step.endswith(("minute", "minutes")) else F.lit(0),
            days=F.col("step") if step.endswith(("day", "days")) else F.lit(0)))
    return fc.withColumn("time", F.date_add("last_ds", F.col("step")))
