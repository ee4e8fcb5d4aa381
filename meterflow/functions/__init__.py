"""Column -> Column building blocks (all JVM-side, codegen'd)."""

from meterflow.functions.alerts import alert_level, is_alert, load_band, suggestion
from meterflow.functions.energy import (clip0, cycle_key, kwh, month_bounds, point_time,
                                        point_time_text, sub_share)
from meterflow.functions.parse import na, parse_day_first, parse_event_time, to_number
from meterflow.functions.tariff import register_tier_cost, tier_amount, tier_cost, tier_cost_sql

__all__ = [
    "alert_level", "is_alert", "load_band", "suggestion", "clip0", "cycle_key", "kwh",
    "month_bounds", "point_time", "point_time_text", "sub_share", "na", "parse_day_first",
    "parse_event_time", "to_number", "register_tier_cost", "tier_amount", "tier_cost",
    "tier_cost_sql",
]
