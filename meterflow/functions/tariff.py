"""Progressive-tier cost as one Column expression (no UDF).

cost = round_half_even( sum_i price_i * clamp(kwh - lo_i, 0, hi_i - lo_i) )
with cost = 0 for kwh <= 0. Float inputs keep the float meaning of the
original (NaN stays NaN); decimal inputs (``exact=True``) stay decimal so the
result is exact and engine independent.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.schemas import TIERS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tier_amount(kwh, tiers=TIERS) -> Column:
    """Unrounded sum over the tiers of the kWh falling in each tier times its price."""
    kwh = _c(kwh)
    total = None
    lo = 0
    for hi, price in tiers:
        part = kwh - F.lit(lo)
        if not math.isinf(hi):
            part = F.least(part, F.lit(hi - lo))
        term = F.greatest(part, F.lit(0)) * F.lit(price)
        total = term if total is None else total + term
        lo = hi
    return total


def tier_cost(kwh, tiers=TIERS, exact: bool = False) -> Column:
    """Bill for a cumulative ``kwh``; half-even rounding to whole currency units.

    ``exact=True`` for DECIMAL input: the result stays DECIMAL.
    """
    kwh = _c(kwh)
    cost = F.bround(tier_amount(kwh, tiers), 0)
    if exact:
        return F.when(kwh.isNull(), F.lit(None)).when(kwh <= 0, F.lit(0)).otherwise(cost)
    kwh_d = kwh.cast("double")
    return (
        F.when(kwh_d.isNull(), F.lit(None).cast("double"))
        .when(F.isnan(kwh_d), F.lit(float("nan")))
        .when(kwh_d <= 0, F.lit(0.0))
        .otherwise(F.bround(tier_amount(kwh_d, tiers), 0))
    )


def tier_cost_sql(arg: str = "kwh", tiers=TIERS) -> str:
    """The same expression as SQL text, for ``CREATE TEMPORARY FUNCTION``."""
    terms = []
    lo = 0
    for hi, price in tiers:
        part = f"({arg} - {lo})"
        if not math.isinf(hi):
            part = f"least({part}, {hi - lo})"
        terms.append(f"greatest({part}, 0) * {price}")
        lo = hi
    amount = " + ".join(terms)
    return f"CASE WHEN {arg} <= 0 THEN 0 ELSE bround({amount}, 0) END"


def register_tier_cost(spark, name: str = "tier_cost", tiers=TIERS) -> None:
    """Register ``tier_cost(kwh)`` as a SQL function; it is inlined into plans."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(kwh DOUBLE) RETURNS DOUBLE "
        f"RETURN {tier_cost_sql('kwh', tiers)}"
    )
