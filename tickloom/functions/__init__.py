"""Column expressions shared by the operators."""

from tickloom.functions.numbers import exact_mean, percent_of, two_decimals
from tickloom.functions.times import as_instant, clock_time, iso_text, lookback, utc_naive

__all__ = [
    "as_instant",
    "clock_time",
    "exact_mean",
    "iso_text",
    "lookback",
    "percent_of",
    "two_decimals",
    "utc_naive",
]
