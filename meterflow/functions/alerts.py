"""Alert level, advice text, gauge band, alert predicate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.schemas import (CRIT_KW, GAUGE_MAX, GAUGE_MIN, GAUGE_RED, LEVEL_CRITICAL,
                               LEVEL_INFO, LEVEL_WARNING, SUGGESTIONS, WARN_KW)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def alert_level(kw, warn: float = WARN_KW, crit: float = CRIT_KW) -> Column:
    """< warn INFO, [warn, crit) WARNING, otherwise CRITICAL.

    NaN is CRITICAL (it is not below any cut point); NULL stays NULL.
    """
    kw = _c(kw)
    return (
        F.when(kw.isNull(), F.lit(None).cast("string"))
        .when(kw < warn, F.lit(LEVEL_INFO))
        .when(kw < crit, F.lit(LEVEL_WARNING))
        .otherwise(F.lit(LEVEL_CRITICAL))
    )


def suggestion(level, texts: dict | None = None) -> Column:
    """Advice text for an alert level (literal lookup, codegen'd)."""
    texts = texts or SUGGESTIONS
    level = _c(level)
    out = None
    for lv, txt in texts.items():
        out = F.when(level == lv, F.lit(txt)) if out is None else out.when(level == lv, F.lit(txt))
    return out


def is_alert(kw, warn: float = WARN_KW) -> Column:
    """Alert-log predicate ``kw >= warn``."""
    return _c(kw) >= F.lit(warn)


def load_band(kw, red: float = GAUGE_RED, lo: float = GAUGE_MIN, hi: float = GAUGE_MAX) -> Column:
    """Gauge state: struct(band green/red, value clamped to [lo, hi], percent of scale)."""
    kw = _c(kw)
    clamped = F.least(F.greatest(kw, F.lit(lo)), F.lit(hi))
    return F.struct(
        F.when(kw.isNull(), F.lit(None).cast("string"))
        .when(kw >= red, F.lit("red")).otherwise(F.lit("green")).alias("band"),
        clamped.alias("gauge_kw"),
        ((clamped - F.lit(lo)) / F.lit(hi - lo) * F.lit(100.0)).alias("gauge_pct"),
    )
