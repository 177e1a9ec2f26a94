"""Business figures of single readings; null where the reading is critical."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom import presets as P
from meterloom.functions import (
    bucketize,
    holds,
    is_critical,
    ratio,
    round_half_even,
    unless_critical,
)


def operating_mode() -> Column:
    supply, back = F.col("supply_air_temp"), F.col("return_air_temp")
    return F.when(supply < back, "Cooling").when(supply >= back, "Heating")


def time_of_use(timestamp: str = "timestamp") -> Column:
    hour = F.hour(timestamp)
    return (
        F.when(hour.isin(*P.PEAK_HOURS), "Peak")
        .when(hour.isin(*P.SHOULDER_HOURS), "Shoulder")
        .otherwise("Off-Peak")
    )


def hvac_kpis(df: DataFrame) -> DataFrame:
    filter_health = bucketize(F.col("filter_pressure_drop"), P.FILTER_BOUNDS, P.FILTER_LABELS)
    return df.withColumns(
        {
            "temp_differential": unless_critical(F.col("return_air_temp") - F.col("supply_air_temp")),
            "operating_mode": unless_critical(operating_mode()),
            "filter_health_status": unless_critical(filter_health),
        }
    )


def utility_kpis(df: DataFrame) -> DataFrame:
    actual, expected = F.col("actual_consumption_kwh"), F.col("expected_consumption_kwh")
    variance = ratio(actual - expected, expected) * 100
    cost = actual * F.col("cost_rate")
    load = ratio(actual, F.col("peak_demand_kw"))
    return df.withColumns(
        {
            "consumption_variance_pct": unless_critical(round_half_even(variance, 1)),
            "is_over_consuming": unless_critical(holds(actual > expected)),
            "estimated_cost": unless_critical(round_half_even(cost, 2)),
            "load_factor": unless_critical(round_half_even(load, 3)),
            "time_of_use_period": unless_critical(time_of_use()),
        }
    )


def enriched_count(df: DataFrame) -> DataFrame:
    """One row: all rows, and those whose figures could be computed."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(~is_critical()).alias("enriched")
    )
