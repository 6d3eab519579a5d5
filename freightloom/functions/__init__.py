"""Column functions; all compile to built-in Catalyst expressions."""

from .dates import (
    batch_tag,
    month_calendar,
    now_utc,
    parse_order_ts,
    whole_days_between,
)
from .scalar import (
    age_bucket,
    message_key,
    percent_of,
    safe_cast,
    safe_divide,
    value_label,
)
from .sums import (
    AMOUNT,
    decimal_sum,
    decimal_sum_product,
    exact_avg,
    exact_sum,
    exact_sum_product,
    rounded_ratio,
    sum_of_parts,
)

__all__ = [
    "AMOUNT",
    "age_bucket",
    "batch_tag",
    "decimal_sum",
    "decimal_sum_product",
    "exact_avg",
    "exact_sum",
    "exact_sum_product",
    "message_key",
    "month_calendar",
    "now_utc",
    "parse_order_ts",
    "percent_of",
    "rounded_ratio",
    "safe_cast",
    "safe_divide",
    "sum_of_parts",
    "value_label",
    "whole_days_between",
]
