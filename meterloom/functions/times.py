"""Timestamps without a time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SECOND_GRAIN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"


def parse_timestamp(name: str, kind: T.DataType, shape: str = SECOND_GRAIN) -> Column:
    """To a naive timestamp; text of another shape, or no real date, becomes null.

    The cast never passes through a zoned timestamp, so the session's time zone
    has no say.
    """
    column = F.col(name)
    if isinstance(kind, T.StringType):
        return F.when(column.rlike(shape), column.try_cast("timestamp_ntz"))
    return column.try_cast("timestamp_ntz")
