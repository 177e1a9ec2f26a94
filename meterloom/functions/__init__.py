"""Column expressions shared by the operators. All of them stay in the JVM."""

from meterloom.functions.conditions import bucketize, holds, is_critical, unless_critical
from meterloom.functions.numbers import exact_mean, exact_sum, parse_double, ratio, round_half_even
from meterloom.functions.text import strip, title_case
from meterloom.functions.times import parse_timestamp

__all__ = [
    "bucketize",
    "exact_mean",
    "exact_sum",
    "holds",
    "is_critical",
    "parse_double",
    "parse_timestamp",
    "ratio",
    "round_half_even",
    "strip",
    "title_case",
    "unless_critical",
]
