from farmledger.functions.calendar import (
    age_days,
    age_week_decimal,
    cycle_label,
    day_number,
    from_year_start,
    in_month,
    month_start,
    previous_month,
    rolling_months,
    week_of_life,
)
from farmledger.functions.ratios import (
    adjusted_conversion,
    efficiency_index,
    fixed,
    per_thousand,
    safe_pct,
    safe_ratio,
    wavg,
    wavg_date,
    wavg_nonzero,
)
from farmledger.functions.text import entity_code, like_label, parent_key, string_list, zero_blank

__all__ = [
    "adjusted_conversion",
    "age_days",
    "age_week_decimal",
    "cycle_label",
    "day_number",
    "efficiency_index",
    "entity_code",
    "fixed",
    "from_year_start",
    "in_month",
    "like_label",
    "month_start",
    "parent_key",
    "per_thousand",
    "previous_month",
    "rolling_months",
    "safe_pct",
    "safe_ratio",
    "string_list",
    "wavg",
    "wavg_date",
    "wavg_nonzero",
    "week_of_life",
    "zero_blank",
]
