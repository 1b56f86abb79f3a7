"""Column expressions: month keys, dates as text, lenient numbers."""

from panelkit.functions.dates import coarser, month_key, period_key, reformat_date, with_period
from panelkit.functions.numbers import to_int

__all__ = ["coarser", "month_key", "period_key", "reformat_date", "to_int", "with_period"]
