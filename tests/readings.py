"""Hand-written readings: a good one, changed where a case needs it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

HVAC = {
    "timestamp": "2026-01-05 10:00:00",
    "equipment_id": "AHU-B1-01",
    "building_id": "B1",
    "supply_air_temp": 60.0,
    "return_air_temp": 74.0,
    "fan_speed_pct": 50.0,
    "duct_pressure": 1.5,
    "filter_pressure_drop": 0.2,
    "cooling_coil_temp": 46.0,
    "heating_coil_temp": 110.0,
    "outdoor_air_temp": 68.0,
    "fault_code": None,
    "status_flag": "Operational",
    "dt": "2026-01-05",
}
UTILITY = {
    "timestamp": "2026-01-05 10:00:00",
    "meter_id": "MTR-B1-ELEC",
    "building_id": "B1",
    "utility_type": "Electricity",
    "actual_consumption_kwh": 100.0,
    "expected_consumption_kwh": 80.0,
    "peak_demand_kw": 125.0,
    "cost_rate": 0.2,
    "dt": "2026-01-05",
}


def frame(spark: SparkSession, base: dict, *changes: dict, clean: bool = True) -> DataFrame:
    """One row per change; ``clean`` rows have a real timestamp."""
    names = list(base) + sorted({name for c in changes for name in c if name not in base})
    rows = []
    for change in changes or ({},):
        row = {**dict.fromkeys(names), **base, **change}
        if clean and isinstance(row["timestamp"], str):
            row["timestamp"] = datetime.fromisoformat(row["timestamp"])
        rows.append(tuple(row[name] for name in names))

    def kind(name: str) -> str:
        if name == "timestamp":
            return "timestamp_ntz" if clean else "string"
        values = [change[name] for change in changes if change.get(name) is not None]
        sample = values[0] if values else base.get(name)
        if isinstance(sample, bool):
            return "boolean"
        if isinstance(sample, int):
            return "bigint"
        return "double" if isinstance(sample, float) else "string"

    return spark.createDataFrame(rows, ", ".join(f"`{name}` {kind(name)}" for name in names))


def column(df: DataFrame, name: str) -> list:
    return [row[name] for row in df.select(name).collect()]
