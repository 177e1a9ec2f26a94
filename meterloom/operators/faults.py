"""Fault signals of single readings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterloom import presets as P
from meterloom.functions import holds, unless_critical


def overheating(supply: float = P.SUPPLY_TOO_HOT, coil: float = P.HEATING_COIL_TOO_HOT) -> Column:
    return holds(F.col("supply_air_temp") > supply) | holds(F.col("heating_coil_temp") > coil)


def coolant_leak(fan: float = P.FAN_RUNNING, coil: float = P.COOLING_COIL_TOO_WARM) -> Column:
    """The fan runs, yet the cooling coil stays warm."""
    return holds(F.col("fan_speed_pct") > fan) & holds(F.col("cooling_coil_temp") > coil)


def status_is(status: str) -> Column:
    return holds(F.lower("status_flag") == status)


def detect_faults(graded: DataFrame) -> DataFrame:
    """Signals from measured values are unknown on critical rows. The status the
    unit reports about itself is trusted on every row."""
    return graded.withColumns(
        {
            "overheating_flag": unless_critical(overheating()),
            "coolant_leak_flag": unless_critical(coolant_leak()),
            "operational_fault_flag": status_is("fault"),
        }
    )


def fault_counts(faulty: DataFrame) -> DataFrame:
    """One row: rows seen and signals fired."""
    return faulty.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("overheating_flag")).alias("overheating"),
        F.count_if(F.col("coolant_leak_flag")).alias("coolant_leak"),
        F.count_if(F.col("operational_fault_flag")).alias("operational_fault"),
    )
