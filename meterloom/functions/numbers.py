"""Number parsing, rounding, and sums that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Plain decimal or exponent notation. Spark's own cast would also take Java
# literals such as `1d` or `0x1p3`.
NUMBER = r"(?i)^\s*[+-]?(inf|infinity|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?)\s*$"


def parse_double(name: str, kind: T.DataType) -> Column:
    """To double; what cannot be read, and NaN, becomes null."""
    column = F.col(name)
    if isinstance(kind, T.StringType):
        column = F.when(column.rlike(NUMBER), F.trim(column).try_cast("double"))
        return column
    column = column.cast("double")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        column = F.nanvl(column, F.lit(None).cast("double"))
    return column


def round_half_even(value: Column, digits: int) -> Column:
    """Scale, round to the even integer at ties, scale back."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as double; null where it is infinite or undefined."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.when(F.abs(quotient) < float("inf"), quotient)


def exact_sum(value: Column, digits: int = 6) -> Column:
    """Sum of a double to ``digits`` decimals, the same in any row order.

    A plain double sum depends on the order in which shuffle blocks arrive, so a
    retried task may change its last bits, and with them a rounded report. Sums
    of whole numbers held in doubles are exact up to 2^53, need no decimal
    buffer, and cannot overflow on a garbage reading.
    """
    scale = F.lit(float(10**digits))
    return F.sum(F.rint(value * scale)) / scale


def exact_mean(value: Column, digits: int = 6) -> Column:
    return F.try_divide(exact_sum(value, digits), F.count(value))
