"""Distinct counts by sketches that merge.

A sketch of 2^LOG_SLOTS slots is a few kilobytes whatever it counts. Sketches of days merge
into those of months, and those of buildings into that of the site, without the rows;
an exact distinct count has to see every value again. The relative standard error is about
1.04 / sqrt(slots); small sets are counted exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 4,096 slots: a standard error of 1.6 percent.
LOG_SLOTS = 12
#: Relative error that an estimate stays under but for three cases in a thousand.
BOUND = 3 * 1.04 / 2 ** (LOG_SLOTS / 2)


def sketch(value: Column) -> Column:
    """Aggregate: the sketch of a column's values; missing ones do not count."""
    return F.hll_sketch_agg(value, LOG_SLOTS)


def union(sketched: Column) -> Column:
    """Aggregate: the sketch of all values behind these sketches."""
    return F.hll_union_agg(sketched, F.lit(False))


def estimate(sketched: Column) -> Column:
    return F.coalesce(F.hll_sketch_estimate(sketched), F.lit(0)).cast("long")


def distinct_sketches(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys and ``sketch`` of ``value``; a missing key names no group."""
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(sketch(F.col(value)).alias("sketch"))


def merged_sketches(sketched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches by fewer keys (or by none) from those by more."""
    return sketched.groupBy(*keys).agg(union(F.col("sketch")).alias("sketch"))
