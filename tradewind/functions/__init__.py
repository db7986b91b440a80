"""Column expressions shared by the operators."""

from tradewind.functions.dates import elapsed_days, month_end, month_start, week_end, year_month
from tradewind.functions.numbers import exact_mean, exact_parts, exact_sum, exact_total, null_if_nan, percent
from tradewind.functions.text import normalized

__all__ = [
    "elapsed_days", "exact_mean", "exact_parts", "exact_sum", "exact_total", "month_end",
    "month_start", "normalized", "null_if_nan", "percent", "week_end", "year_month",
]
