"""Predicates and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

FLAG = "data_quality_flag"


def holds(condition: Column) -> Column:
    """The condition with "unknown" read as false."""
    return F.coalesce(condition, F.lit(False))


def is_critical() -> Column:
    return F.col(FLAG).eqNullSafe("critical")


def unless_critical(value: Column) -> Column:
    """Null on critical rows: the reading behind the value cannot be trusted."""
    return F.when(~is_critical(), value)


def bucketize(value: Column, bounds: Sequence[float], labels: Sequence[str]) -> Column:
    """Label by the first bound the value lies under; null stays null."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("one more label than bounds is needed")
    if list(bounds) != sorted(bounds):
        raise ValueError("bounds must ascend")
    chain = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, label in zip(bounds, labels):
        chain = chain.when(value < bound, label)
    return chain.otherwise(labels[-1])
