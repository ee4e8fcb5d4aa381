"""Energy, shares, billing-cycle keys, time keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.schemas import KWH_FACTOR_DEMO, POINT_TIME_FORMAT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def kwh(kw, factor: float = KWH_FACTOR_DEMO, exact: bool = False) -> Column:
    """Energy of one reading: ``kw * factor``.

    ``exact=True`` carries kW as DECIMAL(18,6) so running sums are exact and
    independent of summation order (kW has at most 6 decimals in practice).
    NaN, infinite and too large kW (1e12 and above) have no such form: NULL.
    """
    kw = _c(kw)
    if exact:
        return (kw.try_cast("decimal(18,6)") * F.lit(factor).cast("decimal(18,6)")).cast("decimal(20,6)")
    return kw * F.lit(float(factor))


def sub_share(sub, kw) -> Column:
    """Share of one sub-meter (Wh in the minute) in the reading's total, in %.

    total_Wh = kW * 1000 / 60; 0 when the total is not positive (or NaN).
    Missing sub-meter counts as 0. Not capped at 100.
    """
    kw = _c(kw)
    total = kw * F.lit(1000) / F.lit(60)
    return (
        F.when(kw.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(total) | (total <= F.lit(0)), F.lit(0.0))
        .otherwise(F.coalesce(_c(sub), F.lit(0.0)) / total * F.lit(100))
    )


def cycle_key(ts, cycle: str = "demo_slot") -> Column:
    """Billing-cycle key.

    ``demo_slot``: ``demo-{hour}-{minute // 3}`` -- a 3-minute slot without the
    date, so a slot resumes its sum on the next day.
    ``calendar_month``: ``yyyy-MM``.
    """
    ts = _c(ts)
    if cycle == "demo_slot":
        return F.concat(
            F.lit("demo-"), F.hour(ts).cast("string"), F.lit("-"),
            F.floor(F.minute(ts) / F.lit(3)).cast("string"),
        )
    if cycle == "calendar_month":
        return F.date_format(ts, "yyyy-MM")
    raise ValueError(f"unknown cycle {cycle!r}")


def month_bounds(ts) -> tuple[Column, Column]:
    """[first instant of the month, first instant of the next month)."""
    start = F.date_trunc("month", _c(ts))
    return start, F.add_months(F.to_date(start), 1).cast("timestamp")


def point_time(ts) -> Column:
    """Point key: event time truncated to the second."""
    return F.date_trunc("second", _c(ts))


def point_time_text(ts) -> Column:
    """ISO text with a literal Z, as written to the point store."""
    return F.date_format(_c(ts), POINT_TIME_FORMAT)


def clip0(c) -> Column:
    """Clip at zero (NULL stays NULL)."""
    c = _c(c)
    return F.when(c.isNull(), c).when(c < F.lit(0), F.lit(0.0)).otherwise(c)
