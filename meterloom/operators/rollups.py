"""Daily summaries and the alarm log.

Counts run over all rows of a group, measures over its reliable (not critical)
rows only. Both come from one aggregate over one scan: measures are conditional,
and a group without a reliable row has null measures. The ``*_by_join`` forms
state the same result as two aggregates and a left join; tests and the bench
hold the two against each other.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom import presets as P
from meterloom.functions import exact_mean, exact_sum, holds, is_critical, ratio, round_half_even
from meterloom.functions.conditions import FLAG
from meterloom.operators.faults import status_is

BUILDING_DAY = ("building_id", "dt")
BUILDING_DAY_TYPE = ("building_id", "dt", "utility_type")
BUILDING_UNIT_DAY = ("building_id", "equipment_id", "dt")


def _named(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that belong to a group: a missing key names none."""
    return df.dropna(subset=list(keys))


def _flag_counts() -> list[Column]:
    return [
        F.count_if(F.col(FLAG) == level).alias(f"{level}_readings")
        for level in ("clean", "warning", "critical")
    ]


def _reliable(value: Column) -> Column:
    return F.when(~is_critical(), value)


def _known(value: str | Column) -> Column:
    """The measure, where the group has a reliable row at all."""
    return F.when(F.col("_reliable_rows") > 0, value if isinstance(value, Column) else F.col(value))


def _uptime() -> Column:
    share = ratio(F.col("_operational"), F.col("total_readings")) * 100
    return round_half_even(share, 1)


def hvac_daily_summary(df: DataFrame, keys: Sequence[str] = BUILDING_DAY) -> DataFrame:
    grouped = _named(df, keys).groupBy(*keys).agg(
        F.count_distinct("equipment_id").alias("equipment_count"),
        F.count("equipment_id").alias("total_readings"),
        *_flag_counts(),
        F.count_if(F.col("overheating_flag")).alias("overheating_events"),
        F.count_if(F.col("coolant_leak_flag")).alias("coolant_leak_events"),
        F.count_if(F.col("operational_fault_flag")).alias("operational_fault_events"),
        exact_mean(_reliable(F.col("temp_differential"))).alias("_mean_differential"),
        F.count_if(~is_critical() & status_is("operational")).alias("_operational"),
        F.count_if(
            ~is_critical() & holds(F.col("filter_health_status") == P.FILTER_LABELS[-1])
        ).alias("_replace_now"),
        F.count_if(~is_critical()).alias("_reliable_rows"),
    )
    return grouped.select(
        *keys,
        "equipment_count",
        "total_readings",
        "clean_readings",
        "warning_readings",
        "critical_readings",
        "overheating_events",
        "coolant_leak_events",
        "operational_fault_events",
        round_half_even(F.col("_mean_differential"), 1).alias("avg_temp_differential"),
        _known("_replace_now").alias("filter_replace_now_count"),
        _known(_uptime()).alias("uptime_pct"),
    )


def utility_daily_summary(df: DataFrame, keys: Sequence[str] = BUILDING_DAY_TYPE) -> DataFrame:
    grouped = _named(df, keys).groupBy(*keys).agg(
        F.count("meter_id").alias("total_readings"),
        *_flag_counts(),
        exact_sum(_reliable(F.col("actual_consumption_kwh"))).alias("_consumption"),
        exact_sum(_reliable(F.col("estimated_cost")), 2).alias("_cost"),
        exact_mean(_reliable(F.col("consumption_variance_pct")), 1).alias("_mean_variance"),
        F.count_if(~is_critical() & F.col("is_over_consuming")).alias("_over"),
        F.count_if(~is_critical()).alias("_reliable_rows"),
    )
    return grouped.select(
        *keys,
        "total_readings",
        "clean_readings",
        "warning_readings",
        "critical_readings",
        _known(round_half_even(F.coalesce("_consumption", F.lit(0.0)), 1)).alias(
            "total_actual_consumption_kwh"
        ),
        _known(round_half_even(F.coalesce("_cost", F.lit(0.0)), 2)).alias("total_estimated_cost"),
        round_half_even(F.col("_mean_variance"), 1).alias("avg_variance_pct"),
        _known("_over").alias("over_consuming_count"),
    )


def equipment_daily(df: DataFrame, keys: Sequence[str] = BUILDING_UNIT_DAY) -> DataFrame:
    grouped = _named(df, keys).groupBy(*keys).agg(
        F.count("equipment_id").alias("total_readings"),
        *_flag_counts(),
        F.count_if(F.col("overheating_flag")).alias("overheating_count"),
        F.count_if(F.col("coolant_leak_flag")).alias("coolant_leak_count"),
        F.count_if(F.col("operational_fault_flag")).alias("operational_fault_count"),
        exact_mean(_reliable(F.col("filter_pressure_drop"))).alias("_mean_drop"),
        F.count_if(~is_critical() & status_is("operational")).alias("_operational"),
        F.count_if(~is_critical()).alias("_reliable_rows"),
    )
    return grouped.select(
        *keys,
        "total_readings",
        "clean_readings",
        "warning_readings",
        "critical_readings",
        "overheating_count",
        "coolant_leak_count",
        "operational_fault_count",
        round_half_even(F.col("_mean_drop"), 2).alias("avg_filter_pressure_drop"),
        _known(_uptime()).alias("uptime_pct"),
    )


def hvac_daily_summary_by_join(df: DataFrame, keys: Sequence[str] = BUILDING_DAY) -> DataFrame:
    rows = _named(df, keys)
    counts = rows.groupBy(*keys).agg(
        F.count_distinct("equipment_id").alias("equipment_count"),
        F.count("equipment_id").alias("total_readings"),
        *_flag_counts(),
        F.count_if(F.col("overheating_flag")).alias("overheating_events"),
        F.count_if(F.col("coolant_leak_flag")).alias("coolant_leak_events"),
        F.count_if(F.col("operational_fault_flag")).alias("operational_fault_events"),
    )
    measures = rows.where(~is_critical()).groupBy(*keys).agg(
        round_half_even(exact_mean(F.col("temp_differential")), 1).alias("avg_temp_differential"),
        F.count_if(holds(F.col("filter_health_status") == P.FILTER_LABELS[-1])).alias(
            "filter_replace_now_count"
        ),
        F.count_if(status_is("operational")).alias("_operational"),
    )
    joined = counts.join(measures, list(keys), "left")
    return joined.withColumn("uptime_pct", _uptime()).drop("_operational")


def utility_daily_summary_by_join(
    df: DataFrame, keys: Sequence[str] = BUILDING_DAY_TYPE
) -> DataFrame:
    rows = _named(df, keys)
    counts = rows.groupBy(*keys).agg(F.count("meter_id").alias("total_readings"), *_flag_counts())

    def total(name: str, digits: int) -> Column:
        return F.coalesce(exact_sum(F.col(name), digits), F.lit(0.0))

    measures = rows.where(~is_critical()).groupBy(*keys).agg(
        round_half_even(total("actual_consumption_kwh", 6), 1).alias("total_actual_consumption_kwh"),
        round_half_even(total("estimated_cost", 2), 2).alias("total_estimated_cost"),
        round_half_even(exact_mean(F.col("consumption_variance_pct"), 1), 1).alias(
            "avg_variance_pct"
        ),
        F.count_if(F.col("is_over_consuming")).alias("over_consuming_count"),
    )
    return counts.join(measures, list(keys), "left")


def equipment_daily_by_join(df: DataFrame, keys: Sequence[str] = BUILDING_UNIT_DAY) -> DataFrame:
    rows = _named(df, keys)
    counts = rows.groupBy(*keys).agg(
        F.count("equipment_id").alias("total_readings"),
        *_flag_counts(),
        F.count_if(F.col("overheating_flag")).alias("overheating_count"),
        F.count_if(F.col("coolant_leak_flag")).alias("coolant_leak_count"),
        F.count_if(F.col("operational_fault_flag")).alias("operational_fault_count"),
    )
    measures = rows.where(~is_critical()).groupBy(*keys).agg(
        round_half_even(exact_mean(F.col("filter_pressure_drop")), 2).alias(
            "avg_filter_pressure_drop"
        ),
        F.count_if(status_is("operational")).alias("_operational"),
    )
    joined = counts.join(measures, list(keys), "left")
    return joined.withColumn("uptime_pct", _uptime()).drop("_operational")


ALARM_COLUMNS = ("timestamp", "building_id", "equipment_id", "dt", "status_flag", "fault_code")


def alarm_log(
    df: DataFrame,
    flags: Mapping[str, str] = P.ALARM_FLAGS,
    columns: Sequence[str] = ALARM_COLUMNS,
) -> DataFrame:
    """One row per reading and alarm that fired, from one scan.

    Readings without an alarm leave before the flags are turned into rows.
    """
    any_flag = reduce(Column.__or__, [holds(F.col(flag)) for flag in flags.values()])
    pairs = [cell for alarm, flag in flags.items() for cell in (F.lit(alarm), F.col(flag))]
    long = df.where(any_flag).select(
        *columns, F.stack(F.lit(len(flags)), *pairs).alias("alarm_type", "_fired")
    )
    return long.where("_fired").drop("_fired")
