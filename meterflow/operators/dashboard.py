"""Dashboard reads over the point tables: B19-B22, D3-D8, D12, E6, E7, F2, A9.

Every read is ``(points, from_ts, to_ts, ...) -> DataFrame``; the time range
is inclusive at both ends and is a plain filter, so it reaches the Parquet
scan (and partition pruning when the table is partitioned by date).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions import is_alert, load_band
from meterflow.schemas import ALERT_LOG_LIMIT, WARN_KW


def time_range(df: DataFrame, from_ts=None, to_ts=None, time: str = "time") -> DataFrame:
    """``from_ts <= time <= to_ts`` (either bound optional).

    A table with a ``day`` column (as the point store's) is also bounded by
    day, so that the scan opens the folders of these days only.
    """
    by_day = time == "time" and "day" in df.columns
    for bound, within in ((from_ts, lambda c, x: c >= x), (to_ts, lambda c, x: c <= x)):
        if bound is not None:
            value = F.lit(bound).cast(df.schema[time].dataType)
            df = df.filter(within(F.col(time), value))
            if by_day:
                df = df.filter(within(F.col("day"), F.to_date(value)))
    return df


def _order(order) -> Column:
    return F.struct(*[F.col(c) for c in order])


def latest(df: DataFrame, fields, from_ts=None, to_ts=None, keys=(), order=("time", "tie"),
           names: dict | None = None) -> DataFrame:
    """Last non-null value of each field in the range, each on its own.

    ``max_by`` with a NULL ordering for NULL values, so a NULL field is skipped
    like a missing field. One partial+final aggregate, no sort.
    """
    names = names or {}
    df = time_range(df, from_ts, to_ts)
    aggs = [F.max_by(F.col(f), F.when(F.col(f).isNotNull(), _order(order))).alias(names.get(f, f))
            for f in fields]
    return df.groupBy(*keys).agg(*aggs)


def peak(df: DataFrame, field: str, from_ts=None, to_ts=None, keys=(), alias: str | None = None):
    """Maximum of a field (all time when no range is given)."""
    df = time_range(df, from_ts, to_ts)
    return df.groupBy(*keys).agg(F.max(field).alias(alias or f"max_{field}"))


def rename_regex(df: DataFrame, pattern: str, repl: str) -> DataFrame:
    """Rename columns by a regular expression (e.g. strip a series prefix)."""
    rx = re.compile(pattern)
    mapping = {c: rx.sub(repl, c) for c in df.columns if rx.fullmatch(c)}
    return df.withColumnsRenamed(mapping) if mapping else df


def load_mix(points: DataFrame, from_ts=None, to_ts=None, keys=(), labels: dict | None = None,
             prefix: str = "power_usage.") -> DataFrame:
    """D12 (+B20): last share of each sub-load and its part of the three together."""
    labels = labels or {"sub1_pct": "kitchen", "sub2_pct": "laundry", "sub3_pct": "water_heater"}
    last = latest(points, list(labels), from_ts, to_ts, keys,
                  names={k: prefix + v for k, v in labels.items()})
    last = rename_regex(last, re.escape(prefix) + r"(.*)", r"\1")
    total = sum((F.coalesce(F.col(v), F.lit(0.0)) for v in labels.values()), F.lit(0.0))
    return last.withColumns({
        f"{v}_share": F.when(total > 0, F.coalesce(F.col(v), F.lit(0.0)) / total * F.lit(100.0))
        .otherwise(F.lit(0.0)) for v in labels.values()})


def load_gauge(points: DataFrame, from_ts=None, to_ts=None, keys=(), red: float = 8.0,
               lo: float = 0.0, hi: float = 10.0) -> DataFrame:
    """Last kW with its gauge band and position on the 0..10 kW scale."""
    last = latest(points, ["kw"], from_ts, to_ts, keys)
    return last.select(*keys, "kw", load_band("kw", red, lo, hi).alias("g")).select(
        *keys, "kw", "g.band", "g.gauge_kw", "g.gauge_pct")


def alert_log(points: DataFrame, warn: float = WARN_KW, limit: int = ALERT_LOG_LIMIT,
              order=("time", "tie"), cols=("time", "kw", "suggestion")) -> DataFrame:
    """F2 (+B22): the newest ``limit`` points with ``kw >= warn`` (a top-k, not a sort)."""
    return (points.filter(is_alert("kw", warn))
            .orderBy(*[F.col(c).desc() for c in order]).limit(limit).select(*cols))


_UNIT_US = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def interval_micros(interval: str) -> int:
    """'5 minutes' -> 300000000 (fixed-length units only)."""
    n, unit = interval.split()
    return int(n) * _UNIT_US[unit.lower().rstrip("s")]


def _floor_to(us: Column, interval: str) -> Column:
    w = F.lit(interval_micros(interval))
    return F.timestamp_micros(us - F.pmod(us, w))


def _bucket_start(time: str, interval: str) -> Column:
    """Epoch-aligned bucket start (like GROUP BY time(interval))."""
    return _floor_to(F.unix_micros(F.col(time).cast("timestamp")), interval)


def bucket_mean(df: DataFrame, fields, interval: str, from_ts=None, to_ts=None, keys=(),
                fill: str = "null", time: str = "time", exact: bool = False) -> DataFrame:
    """Mean per epoch-aligned time bucket.

    fill='none': only buckets with points; 'null': every bucket from the one
    holding ``from_ts`` to the one holding ``to_ts``, empty ones NULL; 'linear':
    as 'null', interior empty buckets filled linearly in time.
    ``exact``: sum as DECIMAL(28,6) so the mean does not depend on the order
    of additions across partitions.
    """
    keys = list(keys)
    df = time_range(df, from_ts, to_ts, time)
    agg = (df.groupBy(*keys, _bucket_start(time, interval).alias("bucket"))
           .agg(*[mean_of(f, exact).alias(f"mean_{f}") for f in fields]))
    if fill == "none":
        return agg
    if from_ts is None or to_ts is None:
        raise ValueError("fill needs both range bounds")
    if fill not in ("null", "linear"):
        raise ValueError(f"unknown fill {fill!r}")
    lo, hi = _bucket_start_lit(from_ts, interval), _bucket_start_lit(to_ts, interval)
    means = [f"mean_{f}" for f in fields]
    if not keys:  # a series without points still has its empty buckets
        empty = df.sparkSession.range(1).select(lo.alias("bucket"), *(F.lit(None).cast(agg.schema[m].dataType).alias(m) for m in means))
        agg = agg.unionByName(empty).groupBy("bucket").agg(*(F.max(m).alias(m) for m in means))
    return fill_gaps(agg, keys, "bucket", means, F.expr(f"INTERVAL {interval}"), lo, hi, fill == "linear")


def fill_gaps(df: DataFrame, keys, time: str, values, step: Column, lo: Column | None = None, hi: Column | None = None,
              linear: bool = False) -> DataFrame:
    """keys, ``time``, ``values`` with a row for every ``step`` from ``lo`` to ``hi`` (default: a key's first and last row).

    Every row makes the missing steps up to its neighbour (a run), so there is
    no spine and no join: one window exchange by key over rows that exist.
    Rows are one per key and step, and lie on the steps. New rows hold NULLs
    or, with ``linear``, what lies between the known neighbours: slope * (t -
    t0) + y0 with slope = (y1 - y0) / (t1 - t0); NULLs of existing rows are
    filled alike, ends stay NULL. Without keys the window is one task of at
    most as many rows as there are steps in the range.
    """
    keys, values = list(keys), list(values)
    up, down = (Window.partitionBy(*keys).orderBy(o) for o in (F.col(time).asc(), F.col(time).desc()))
    t_num = _t_num(df, time)
    cols = {"_next": F.lead(time).over(up), "_first": F.lag(time).over(up).isNull()}
    known = lambda v: F.when(F.col(v).isNotNull(), F.struct(t_num.alias("t"), F.col(v).alias("v")))
    if linear:
        cols |= {f"_p{i}": F.last(known(v), ignorenulls=True).over(up.rowsBetween(Window.unboundedPreceding, 0)) for i, v in enumerate(values)}
        cols |= {f"_n{i}": F.last(known(v), ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, -1)) for i, v in enumerate(values)}
    rows = df.select(*keys, time, *values).withColumns(cols)
    run = F.sequence(F.col(time), F.coalesce(F.col("_next") - step, F.col(time) if hi is None else hi), step)
    if lo is not None:
        head = F.when(F.col("_first") & (F.col(time) > lo), F.sequence(lo, F.col(time) - step, step))
        run = F.concat(F.coalesce(head, F.array().cast(rows.select(run.alias("r")).schema["r"].dataType)), run)
    out = rows.withColumn("_at", F.explode(run))
    here = F.col("_at") == F.col(time)
    filled = []
    for i, v in enumerate(values):
        value = F.when(here, F.col(v))
        if linear:
            p, n, t = F.col(f"_p{i}"), F.col(f"_n{i}"), _t_num_of(F.col("_at"), df.schema[time].dataType.typeName())
            between = (n["v"] - p["v"]) / (n["t"] - p["t"]) * (t - p["t"]) + p["v"]
            value = F.when(here & F.col(v).isNotNull(), F.col(v)).when(t > p["t"], between)
        filled.append(value.alias(v))
    return out.select(*keys, F.col("_at").alias(time), *filled)


def mean_of(f: str, exact: bool) -> Column:
    if not exact:
        return F.avg(f)
    return F.sum(F.col(f).cast("decimal(28,6)")).cast("double") / F.count(f)


def _bucket_start_lit(ts, interval: str) -> Column:
    return _floor_to(F.unix_micros(F.lit(ts).cast("timestamp")), interval)


def interpolate_linear(df: DataFrame, keys, time: str, value) -> DataFrame:
    """Fill NULLs between two known points linearly in ``time``; ends stay NULL.

    slope = (y1 - y0) / (t1 - t0); y = slope * (t - t0) + y0 (numpy's order).
    ``value`` may be one column or several; all use the same two windows (one
    sort each way). The windows run per key over a series of one row per
    bucket/day, so a partition is bounded by the span, not the data volume.
    """
    keys = list(keys)
    values = [value] if isinstance(value, str) else list(value)
    t_num = _t_num(df, time)
    # Both neighbours as running frames (linear); a frame reaching to
    # "unbounded following" would be re-evaluated for every row.
    prev_w = Window.partitionBy(*keys).orderBy(F.col(time).asc()).rowsBetween(
        Window.unboundedPreceding, 0)
    next_w = Window.partitionBy(*keys).orderBy(F.col(time).desc()).rowsBetween(
        Window.unboundedPreceding, 0)

    def known(v):
        return F.when(F.col(v).isNotNull(), F.struct(t_num.alias("t"), F.col(v).alias("v")))

    out = df.withColumns({f"_p{i}": F.last(known(v), ignorenulls=True).over(prev_w)
                          for i, v in enumerate(values)})
    out = out.withColumns({f"_n{i}": F.last(known(v), ignorenulls=True).over(next_w)
                           for i, v in enumerate(values)})
    filled = {}
    for i, v in enumerate(values):
        p, n = F.col(f"_p{i}"), F.col(f"_n{i}")
        slope = (n["v"] - p["v"]) / (n["t"] - p["t"])
        filled[v] = F.when(F.col(v).isNotNull(), F.col(v)).otherwise(
            slope * (t_num - p["t"]) + p["v"])
    return out.withColumns(filled).drop(*[f"_{x}{i}" for x in "pn" for i in range(len(values))])


def _t_num(df: DataFrame, time: str) -> Column:
    return _t_num_of(F.col(time), df.schema[time].dataType.typeName())


def _t_num_of(t: Column, kind: str) -> Column:
    if kind == "date":
        return F.unix_date(t).cast("double")
    return F.unix_seconds(t.cast("timestamp")).cast("double")


def upsert_points(df: DataFrame, keys, order) -> DataFrame:
    """Last write wins per key (measurement tag set + second).

    ``max_by(struct(row), struct(order))`` per key: a partial+final aggregate,
    so a key with many writes is combined map-side, never sorted in one task.
    """
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    win = F.max_by(F.struct(*[F.col(c) for c in rest]), F.struct(*[F.col(c) for c in order]))
    return df.groupBy(*keys).agg(win.alias("_w")).select(*keys, *[F.col("_w")[c].alias(c) for c in rest])
